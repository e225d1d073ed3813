"""Repair of truncated JSON against a plain walk over characters, at every place of a cut."""

import json
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cluelake.functions import recover


def plain(text):
    body = text.rstrip()
    if body.endswith("}"):
        return text

    def walk(t):
        quoted = skip = False
        whole, stack = 0, []
        for i, c in enumerate(t):
            if skip:
                skip = False
            elif c == "\\":
                skip = True
            elif c == '"':
                quoted = not quoted
            elif not quoted and c in "{[":
                stack.append(c)
            elif not quoted and c in "}]":
                whole = i + 1
                if stack and stack[-1] + c in ("{}", "[]"):
                    stack.pop()
        return quoted, whole, stack

    quoted, whole, _ = walk(body)
    x = body[:whole] if whole else body + '"' * quoted
    x = re.sub(r",\s*$", "", re.sub(r',\s*"[^"]*"\s*:\s*$', "", x))
    return x + "".join("}" if c == "{" else "]" for c in reversed(walk(x)[2]))


def repaired(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.t for r in df.select("i", recover.repaired_json(F.col("t")).alias("t")).orderBy("i").collect()]


WHOLE = json.dumps({"a": "x{", "clues": [{"t": 'he said "[hello]" \\ and left', "n": [1, [2, {}], []]}, {"t": "é\u2028🎉,", "u": {"v": None}}], "last": "y"}, ensure_ascii=False)


def test_every_cut(spark):
    cuts = [WHOLE[:k] for k in range(len(WHOLE) + 1)]
    got = repaired(spark, cuts)
    assert got == [plain(t) for t in cuts]
    first = WHOLE.index("{}]") + 3  # from the first whole element on
    for t, x in zip(cuts[first:], got[first:]):
        if not t.rstrip().endswith("}"):  # what ends in } is taken as whole
            json.loads(x)


def test_cases(spark):
    cases = {
        '{"clues": [{"text": "hello"}]}': '{"clues": [{"text": "hello"}]}',
        '{"clues": [{"text": "hello"}, {"text": "world"': '{"clues": [{"text": "hello"}]}',
        '{"clues": [{"text": "a long clue about hist': '{"clues": [{"text": "a long clue about hist"}]}',
        '{"text": "array [1, 2, 3] and object {a: b}", "other": "val': '{"text": "array [1, 2, 3] and object {a: b}", "other": "val"}',
        '{"clues": [{"text": "hello", "category": ': '{"clues": [{"text": "hello"}]}',
        '{"clues": [{"text": "hello"},': '{"clues": [{"text": "hello"}]}',
        "": "",
        ' {"a": 1} \n': ' {"a": 1} \n',
        '{"a": {"b": {"c": [{"d": "val': '{"a": {"b": {"c": [{"d": "val"}]}}}',
        None: None,
    }
    assert repaired(spark, list(cases)) == list(cases.values())


def test_long_texts_with_many_escapes(spark):
    texts = ['{"a": ["' + '\\"{[' * 100_000 + '", ' + "[" * 500, '{"a": "' + "x" * 2_000_000, "\\" * 99_999]
    assert repaired(spark, texts) == [plain(t) for t in texts]


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text('{}[]",: \\ab\n\u00a0\x1c\u0085🎉', max_size=30), min_size=1, max_size=40))
def test_any_text(spark, texts):
    assert repaired(spark, texts) == [plain(t) for t in texts]


def test_no_python_worker(spark):
    df = spark.range(1).select(recover.repaired_json(F.col("id").cast("string")))
    assert "Python" not in df._jdf.queryExecution().toString()
