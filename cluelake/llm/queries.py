"""The queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cluelake.llm import bpe, common, countfast, decontam, linededup, merkle, quality, scoring, setjoin, simhash, suffixdedup, tokenfile, trie, warc

END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return common.session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, END_ID)


def op2_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.audited(table(spark, sf_dir, "pages"), F.col("page_id") % 101 == 7)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.groups(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return countfast.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digest(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefixes(table(spark, sf_dir, "conversations"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_output, op2_warc_audit, op3_ngram_jaccard, op4_byte_bpe, op5_decontaminate, op6_token_counts, op7_quality_rules, op8_suffix_dedup, op9_lm_scoring, op10_line_dedup, op11_prefix_trie, op12_fingerprints, op13_merkle_manifest)}
ORACLE_SQL = {"op3_ngram_jaccard": setjoin.SQL, "op8_suffix_dedup": suffixdedup.SQL, "op2_warc_audit": warc.SQL, "op5_decontaminate": decontam.SQL, "op7_quality_rules": quality.SQL, "op11_prefix_trie": trie.SQL, "op13_merkle_manifest": merkle.SQL}
