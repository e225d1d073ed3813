"""Pieces of text that a byte-level BPE encodes on their own, remembered within a Python worker.

The pattern of byte-level BPE vocabularies never joins a non-space character
with a space after it, and takes one single space together with the letters,
digits or signs after it. So a text can be cut before every single space that
stands between two non-space characters, and each piece encodes on its own.
Pieces repeat (words), so each is encoded once and remembered; what is not
remembered is cut by the pattern into pre-tokens, which are remembered too.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable
from itertools import compress
from operator import not_

import regex

#: White space other than the space and the line feed.
_OTHER = re.compile("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")
#: Signs that, after letters, are a pre-token of their own. Not the apostrophe.
_SIGNS = frozenset(".,;:!?|)")


def pieces(text: str) -> list[str]:
    """The text's pieces; all but the first lack the space that they begin with."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _OTHER.search(text):
        return _SAFE.split(text)
    return text.split(" ")


#: Longer pieces and pre-tokens are forgotten at once.
LONG = 100


class Memo:
    """Bytes (packed ids, or a count) of each piece, and of each pre-token of the pieces not seen before.

    encode gets new pre-tokens and returns a value for each. Values of pieces
    are concatenated from those of their pre-tokens. Both tables are emptied
    when they hold `most` entries (100 MB each), so memory is bounded; results don't depend on it.
    """

    def __init__(self, pattern: str, encode: Callable[[list[str]], list[bytes]], most: int = 600_000):
        gc.set_threshold(200_000, 20, 100)  # lists of pieces come and go by the million, without cycles
        self.find, self.encode, self.most = regex.compile(pattern).findall, encode, most
        self.letters = r"| ?\p{L}+|" in pattern
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}
        self.fresh: list[str] = []

    def _learn(self, new: list[str], known: dict[str, bytes], spaced: bool = True) -> None:
        if spaced and self.letters:  # most pieces are a space and letters, perhaps with one sign at the end
            cut = [[x] if x[1:].isalpha() else [x[:-1], x[-1]] if x[-1] in _SIGNS and x[1:-1].isalpha() else self.find(x) for x in new]
        else:
            cut = [self.find(x) for x in new]
        unseen = list({t for c in cut for t in c if t not in self.tokens})
        self.tokens.update(zip(unseen, self.encode(unseen) if unseen else []))
        self.fresh += unseen
        get = self.tokens.__getitem__
        known.update((x, b"".join(map(get, c))) for x, c in zip(new, cut))

    def values(self, texts: list[str]) -> list[bytes]:
        """The concatenated values of each text's pieces."""
        if len(self.rest) + len(self.first) > self.most:
            self.first.clear()
            self.rest.clear()
        if len(self.tokens) > self.most:
            self.tokens.clear()
        cut = [pieces(t) for t in texts]
        tails = [c[1:] for c in cut]
        got = [list(map(self.rest.get, c)) for c in tails]
        missed = [list(compress(c, map(not_, g))) for c, g in zip(tails, got)]
        some = list(set().union(*missed))
        rest: dict[str, bytes] = {}
        self._learn([" " + x for x in some], rest)
        self.rest.update(zip(some, rest.values()))
        heads = list({c[0] for c in cut if c[0] not in self.first})
        self._learn(heads, self.first, False)
        out = []
        for c, g, m in zip(cut, got, missed):
            fill = map(self.rest.__getitem__, m)
            out.append(self.first[c[0]] + b"".join([v or next(fill) for v in g] if m else g))
        for known, keys in ((self.rest, some), (self.first, heads)):  # long ones hardly repeat and take memory
            for x in keys:
                if len(x) > LONG:
                    del known[x]
        for x in [x for x in self.fresh if len(x) > LONG]:
            del self.tokens[x]
        self.fresh = []
        return out
