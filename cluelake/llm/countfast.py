"""Operator 6: token counts by the whole-token shortcut.

Offline, once for a vocabulary: a vocabulary string is *whole* if the pattern
leaves it in one piece and merging its bytes ends in one token. Every
vocabulary string is run through both steps, which is the proof. A pre-token
that is whole counts as one without merging; only the rest is merged.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cluelake.llm import common
from cluelake.llm.bpe import Ranks
from cluelake.llm.pretokens import Memo


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of_json(path: str) -> tuple[Ranks, list[str]]:
    """Ranks of a byte-level tokenizers file whose ids follow its merges, and its added tokens.

    Raises ValueError where the file is of another kind; those are counted by their library.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or pre.get("add_prefix_space") or model.get("ignore_merges") or model.get("byte_fallback"):
        raise ValueError("not a plain byte-level BPE")
    letter = byte_letters()
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ids = {bytes(letter[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    order = [a.replace(" ", "") if isinstance(a, str) else "".join(a) for a in model["merges"]]
    if sorted(order, key=model["vocab"].__getitem__) != order or len(set(order)) != len(order):
        raise ValueError("ids don't follow the merges")
    return Ranks(ids), sorted(added)


def whole(ranks: Ranks, pattern: str) -> frozenset[str]:
    """The vocabulary strings that encode alone as one token."""
    find, strings = regex.compile(pattern).findall, []
    for t in ranks.ranks:
        try:
            s = t.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if find(s) == [s]:
            strings.append(s)
    return frozenset(s for s, ids in zip(strings, ranks.encode([s.encode() for s in strings])) if len(ids) == 4)


class Counter:
    """n tokens of texts, by the shortcut where the vocabulary allows it, else by its library."""

    def __init__(self, path: str, pattern: str):
        self.memo = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        self.library = lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]
        try:
            ranks, self.added = ranks_of_json(path)
        except ValueError:
            return
        one = whole(ranks, pattern)

        def count(new: list[str]) -> list[bytes]:  # a count is as many bytes, so that counts add up by joining
            rest = [t for t in new if t not in one]
            n = dict(zip(rest, ranks.encode([t.encode("utf-8", "surrogatepass") for t in rest])))
            return [b"1" if t in one else b"1" * (len(n[t]) // 4) for t in new]

        self.memo = Memo(pattern, count)

    def counts(self, texts: list[str]) -> list[int]:
        if self.memo is None:
            return self.library(texts)
        out = [len(v) for v in self.memo.values(texts)]
        for i, t in enumerate(texts):  # strings of added tokens inside texts
            if any(a in t for a in self.added):
                out[i] = self.library([t])[0]
        return out


_loaded: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of each row of docs.

    A null text counts as empty (0 bytes, 0 tokens); repeated rows and null ids
    stay; other columns are not read. No prefix or cap: whole texts are counted.
    """
    common.session(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = Counter(path, pattern)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            n = np.array([v for i, j in common.chunks(texts) for v in _loaded[path].counts(texts[i:j])], np.int64)
            size = pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
