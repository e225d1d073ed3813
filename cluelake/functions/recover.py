"""Lenient readers of model output: truncated JSON as a fold in the JVM; speaker maps as Arrow-batched Python, as their shapes are those of a Python reader."""

from __future__ import annotations

import ast
import json
import re
from collections import Counter
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cluelake.functions.text import NO_NAMES


#: White space as Python's strip() has it.
_SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
#: An escaped character, a mark of structure, or a run of others.
_TOKEN = r'(?s)\\.|["{}\[\]]|[^"\\{}\[\]]++|\\'


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def _walk(text: Column) -> Column:
    """quoted, whole, open of a text: whether it ends within a string, where its last } or ] outside of strings ends (0 without one), and the brackets that are open, outermost first."""
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("quoted"), F.lit(0).alias("whole"), F.lit("").alias("open"))

    def step(a: Column, t: Column) -> Column:
        at, free = a["at"] + F.length(t), ~a["quoted"]
        inner = F.right(a["open"], F.lit(1))
        pops = ((t == "}") & (inner == "{")) | ((t == "]") & (inner == "["))
        opened = F.when(t.isin("{", "["), F.concat(a["open"], t)).when(pops, F.left(a["open"], F.length(a["open"]) - 1)).otherwise(a["open"])
        return F.struct(
            at.alias("at"), F.when(t == '"', free).otherwise(a["quoted"]).alias("quoted"),
            F.when(free & t.isin("}", "]"), at).otherwise(a["whole"]).alias("whole"), F.when(free, opened).otherwise(a["open"]).alias("open"),
        )

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), start, step)


def repaired_json(text: Column) -> Column:
    """Truncated JSON cut after its last whole element and closed; text that ends in } stays as it is.

    Without a whole element, an open string is ended and a key without a value
    dropped. A fold over tokens with the open brackets as its stack, in the JVM;
    null stays null, and a text of any length is one array of its tokens.
    """

    def close(body: Column) -> Column:
        def cut(w: Column) -> Column:
            x = F.when(w["whole"] > 0, F.left(body, w["whole"])).otherwise(F.concat(body, F.when(w["quoted"], '"').otherwise("")))
            x = F.regexp_replace(x, f',{_SPACE}*"[^"]*"{_SPACE}*:{_SPACE}*\\z', "")
            return F.regexp_replace(x, f",{_SPACE}*\\z", "")

        return _let(_let(_walk(body), cut), lambda x: F.concat(x, F.translate(F.reverse(_walk(x)["open"]), "{[", "}]")))

    body = F.regexp_replace(text, f"{_SPACE}+\\z", "")
    return F.when(body.endswith("}"), text).otherwise(_let(body, close))


_IS_ID = re.compile(r"speaker_", re.I)
# Fixed pattern: an id, an arrow, colon, dash or equals sign, and a name.
_PAIR = re.compile(r"""["']?(SPEAKER_\d+)["']?\s*[:\-=→>]+\s*["']?([A-Z][a-zA-Z\s'.]+?)(?:["',}\]\n]|$)""", re.M)


def _flat(x: dict) -> dict[str, str]:
    return {str(k): v.strip() for k, v in x.items() if isinstance(v, str) and v.strip()} if any(_IS_ID.match(str(k)) for k in x) else {}


def inferred(segments: list, hosts: Sequence[str]) -> dict[str, str]:
    """Speakers and names from diarised segments: who speaks most often hosts, under the first of the known hosts' names that is heard; the names that the host says most go to the others, by their numbers."""
    said: dict[str, list[str]] = {}
    for r in segments:
        if isinstance(r, dict) and r.get("speaker"):
            said.setdefault(r["speaker"], []).append(str(r.get("text", "")))
    if not said:
        return {}
    host = max(said, key=lambda s: len(said[s]))
    heard = " ".join(said[host])
    count = Counter(w for w in re.findall(r"\b([A-Z][a-z]{2,})\b", heard) if w not in NO_NAMES)
    names = iter([w for w, _ in count.most_common(3)])
    others = sorted((s for s in said if s != host), key=lambda s: int(s[8:]) if re.fullmatch(r"SPEAKER_\d+", s) else 999)
    known = next((h for h in hosts if any(part in heard for part in (h.split()[0], h.split()[-1]))), "Host")
    return {host: known} | {s: next(names, f"Contestant ({s})") for s in others}


def speaker_map(text: str, hosts: Sequence[str] = ()) -> dict[str, str]:
    """Speaker ids and names from JSON, a Python literal, a list of records, or prose."""
    for read in (json.loads, ast.literal_eval):
        try:
            x = read(text)
        except (ValueError, SyntaxError):
            continue
        if isinstance(x, dict):
            found = next((m for m in map(_flat, [x, *(v for v in x.values() if isinstance(v, dict))]) if m), {})
            if found:
                return found
        elif isinstance(x, list):
            out = {}
            for r in (r for r in x if isinstance(r, dict)):
                ids = [k for k in r if str(k).lower() in ("speaker", "speaker_id", "id")]
                names = [k for k in r if str(k).lower() in ("name", "contestant", "person")]
                if ids and names:
                    out[str(r[ids[-1]])] = str(r[names[-1]]).strip()
            if out:
                return out
            if any(isinstance(r, dict) and "text" in r and "speaker" in r for r in x):
                found = inferred(x, hosts)
                if found:
                    return found
    return {k: n for k, v in _PAIR.findall(text) if (n := v.strip().rstrip(".,;:'\""))}


def parsed_speaker_map(text: Column, hosts: Sequence[str] = ()) -> Column:
    """speaker_map() of a column, with the names of known hosts."""
    known = tuple(hosts)

    @F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: speaker_map(t, known), na_action="ignore")

    return read(text)
