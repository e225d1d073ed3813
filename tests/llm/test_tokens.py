"""Operators 1, 4 and 6 against their libraries."""

import base64
import hashlib
import io
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cluelake.llm import bpe, countfast, tokenfile

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "a", "It's we'll  two\n\n three \t x y  z", " lead", "trail ", "<|endoftext|> in <|endoftext|>", "x" * 700 + " " + "ab" * 500,
    "Éçeau aianre. \U0001f600\U0001f600 12345 !!! ??", "tab\tx\r\ny \x1c z\x1d", "same words same words same words", "same words same words same words", "word. " * 3000,
]


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def docs(spark, texts=TEXTS):
    rows = [(i, t, "en", i) for i, t in enumerate(texts)] + [(None, "no id", None, None), (3, "a", "again", 1)]
    return spark.createDataFrame(rows if texts is not None else [], "doc_id long, text string, ids string, n_tokens long")


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab 'st\n\té1!., 　Zz|́"), max_size=60))
def test_memo_equals_library(text):
    _, memo = bpe.loaded(RANKS, P.PATTERN)
    assert np.frombuffer(memo.values([text])[0], "<u4").tolist() == reference().encode_ordinary(text)


def test_bpe_encode_decode(spark):
    enc, df = reference(), docs(spark)
    got = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        assert r.ids == enc.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    for r in bpe.digest(df, RANKS, P.PATTERN).collect():
        if r.doc_id is not None and r.doc_id < len(TEXTS) and r.doc_id != 3:
            ids = enc.encode_ordinary(TEXTS[r.doc_id] or "")
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest())
    assert bpe.digest(docs(spark).filter("false"), RANKS, P.PATTERN).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts(spark, name):
    path = P.path(name)
    if name.endswith(".json"):
        tok = Tokenizer.from_file(path)
        n = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lambda t: len(sp.encode(t))
    got = countfast.token_counts(docs(spark), path, P.PATTERN, 1000).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        if r.doc_id is not None and r.doc_id != 3:
            t = TEXTS[r.doc_id] or ""
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n(t), n(t) > 1000)


def test_whole_tokens_are_proved():
    ranks, added = countfast.ranks_of_json(JSON)
    tok, one = Tokenizer.from_file(JSON), countfast.whole(*(ranks, P.PATTERN))
    some = sorted(one)[::37]
    assert added == ["<|endoftext|>"] and len(one) > 40_000
    assert all(len(e.ids) == 1 for e in tok.encode_batch(some, add_special_tokens=False))


def test_token_files_round_trip(spark, tmp_path):
    tok, df = Tokenizer.from_file(JSON), docs(spark)
    folder = f"file://{tmp_path}/out"
    manifest = tokenfile.write(df, folder, JSON, P.PATTERN, 2, 3)
    got = sorted(tokenfile.digest(manifest, folder).collect(), key=lambda r: (r.start, r.doc_id or -1))
    start = 0
    assert [r.doc_id for r in got] == sorted([*range(len(TEXTS)), 3, -1]) or got[0].doc_id is None
    for r in got:
        t = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokenfile.digest(tokenfile.write(df.filter("false"), folder + "0", JSON, P.PATTERN, 2, 1), folder + "0").count() == 0
    f = manifest.orderBy("file_no").first()
    raw = open(f.file, "rb").read()
    r = tokenfile.Reader(io.BytesIO(raw), len(raw))
    assert zstandard.ZstdDecompressor().decompressobj().decompress(raw) == r.ids(0)  # any reader can
    broken = bytearray(raw)
    broken[int(r.table[1]["offset"]) + int(r.table[1]["stored"]) - 1] ^= 1
    r = tokenfile.Reader(io.BytesIO(bytes(broken)), len(raw))
    r.ids(0)
    with pytest.raises(tokenfile.Corrupt):
        r.ids(1)
