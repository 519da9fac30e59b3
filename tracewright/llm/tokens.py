"""Encoding texts with the ``tokenizers`` library, each different unit of a chunk once.

A tokenizer splits a text before it merges, so ids of a text are the ids of its units one after another if
units are cut where the split always cuts. Two ways of cutting are known here:

``byte``  the byte-level pattern that keeps a space with the word after it: before a space or line feed that
          follows a visible ASCII character, and before a space that a visible ASCII character or a letter outside
          ASCII follows (lead bytes of the blocks with Unicode spaces are left out).
``word``  white space is dropped: at every run of ``[\\x20\\x09-\\x0D]``.
``None``  texts are encoded whole.

Units are told apart by 64-bit hashes, and a Python worker remembers the ids of those it has seen.

With ``special`` a special token's string in a text is that token, as by the library's default; without, it is ordinary
text. A special token ends the stretch before it: no cut that looks ahead is made at the space before one. Special strings must hold
no space or line feed and take none beside them (true of both tokenizers here); otherwise texts are encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from tracewright.llm.common import span_hashes, word_spans

ENCODE_BYTES = 1 << 22   # bytes of text whose units are told apart together
KNOWN_UNITS = 1_000_000  # whose ids a Python worker remembers
_loaded: dict = {}

_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
_OPENS = _VISIBLE.copy()
_OPENS[0xC3:0xE0] = True
_OPENS[0xE4:0xF5] = True
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 0x0A]] = True


def tokenizer(path: str, special: bool = False):
    """The tokenizer at ``path``, loaded once per Python worker and way of reading special strings."""
    if (path, special) not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = not special
        _loaded[path, special] = t
    return _loaded[path, special]


def special_strings(path: str) -> list[bytes] | None:
    """The strings of the special tokens; None if one of them could span a cut."""
    tokens = [t for t in tokenizer(path, True).get_added_tokens_decoder().values() if t.special]
    if any(t.lstrip or t.rstrip or t.single_word or any(c.isspace() for c in t.content) for t in tokens):
        return None
    return [t.content.encode() for t in tokens]


def vocabulary_size(path: str) -> int:
    return tokenizer(path).get_vocab_size(with_added_tokens=True)


def units_of(buf: np.ndarray, start: np.ndarray, end: np.ndarray, cuts: str | None, special: list[bytes] = []) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of the texts in ``buf``, in order; ``special`` has strings that are tokens of their own."""
    if cuts == "word":
        return word_spans(buf, start, end)
    full = end > start
    mark = np.zeros(len(buf) + 1, dtype=bool)
    if cuts == "byte" and len(buf) > 1:
        mark[1:-1] = _GAP[buf[1:]] & _VISIBLE[buf[:-1]]
        ahead = (buf[:-1] == 0x20) & _OPENS[buf[1:]]
        if special:
            found = re.finditer(b"|".join(map(re.escape, special)), buf.tobytes())
            ahead[np.array([m.start() - 1 for m in found if m.start()], dtype=np.int64)] = False
        mark[:-2] |= ahead
    mark[start[full]] = True
    at = np.flatnonzero(mark[:-1])
    return at, np.append(at[1:], len(buf)) if len(at) else at


def encode(buf: np.ndarray, start: np.ndarray, end: np.ndarray, path: str, cuts: str | None, special: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, index of each text's first id and one more at the end)."""
    import pandas as pd

    strings = special_strings(path) if special else []
    if strings is None:
        cuts, strings = None, []
    us, ue = units_of(buf, start, end, cuts, strings)
    first_unit = np.append(np.searchsorted(us, start, side="left"), len(us))
    if not len(us):
        return np.zeros(0, dtype=np.uint32), first_unit
    h = span_hashes(buf, us, ue)
    code, _ = pd.factorize(h)
    lead = np.flatnonzero(code > np.concatenate(([-1], np.maximum.accumulate(code)[:-1])))
    raw = buf.tobytes()
    flat, off, size = _known.setdefault((path, cuts, True) if special else (path, cuts), Units()).ids_of(
        h[lead], lambda i: raw[us[lead[i]]:ue[lead[i]]].decode(), tokenizer(path, special))
    each = size[code]
    upto = np.concatenate(([0], np.cumsum(each)))
    at = np.repeat(off[code] - upto[:-1], each) + np.arange(int(upto[-1]))
    return flat[at], upto[first_unit]


class Units:
    """Ids of units seen by this Python worker, by hash: the first ``KNOWN_UNITS`` (some 35 bytes each)."""

    def __init__(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.off = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def ids_of(self, keys: np.ndarray, text, tokenizer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first index, number) for different ``keys``; ``text(i)`` is the unit of keys[i]."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        seen = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        off, size = np.empty(len(keys), dtype=np.int64), np.empty(len(keys), dtype=np.int64)
        off[seen], size[seen] = self.off[at[seen]], self.size[at[seen]]
        new = np.flatnonzero(~seen)
        got: list[int] = []
        sizes: list[int] = []
        for a in range(0, len(new), 5_000):
            for e in tokenizer.encode_batch_fast([text(i) for i in new[a:a + 5_000].tolist()], add_special_tokens=False):
                ids = e.ids
                sizes.append(len(ids))
                got.extend(ids)
        size[new] = sizes
        off[new] = len(self.flat) + np.cumsum(size[new]) - size[new]
        flat = np.concatenate((self.flat, np.array(got, dtype=np.uint32)))
        add = new[:max(0, KNOWN_UNITS - len(self.keys))]
        if len(add):
            self.flat = flat[:off[add[-1]] + size[add[-1]]]
            add = add[np.argsort(keys[add])]
            place = np.searchsorted(self.keys, keys[add])
            self.keys = np.insert(self.keys, place, keys[add])
            self.off = np.insert(self.off, place, off[add])
            self.size = np.insert(self.size, place, size[add])
        return flat, off, size


_known: dict[tuple, Units] = {}
