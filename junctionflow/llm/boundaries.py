"""Certain cuts of a text for a byte-level vocabulary, and what is known of the fragments between them.

A pair of bytes that stands inside no token of a vocabulary can never be joined by merges, so a token always ends
between the two. Where the split before the merges cannot reach over such a place either, the fragments on both sides
have the ids that they have in the whole text, and equal fragments need be encoded once only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256)
_LETTER = np.isin(_BYTES, [*range(65, 91), *range(97, 123)])
_PLAIN = _LETTER | np.isin(_BYTES, range(48, 58))
_PRINTED = (_BYTES > 32) & (_BYTES < 127)
#: Endings that the split takes off after an apostrophe (fixed values), by their inner pairs of letters.
_ENDINGS = (b"re", b"ve", b"ll")
#: Bytes that end a white-space character of several bytes, and the bytes before them in such characters.
_WIDE_SPACE_BEFORE = np.isin(_BYTES, [0x80, 0x81, 0x9A, 0xC2])


def absent_pairs(tokens: Iterable[bytes]) -> np.ndarray:
    """256 x 256: whether a pair of bytes stands inside none of the tokens."""
    absent = np.ones(65536, bool)
    for token in tokens:
        t = np.frombuffer(token, np.uint8).astype(np.uint16)
        absent[t[:-1] * 256 + t[1:]] = False
    return absent.reshape(256, 256)


def certain_pairs(absent: np.ndarray) -> np.ndarray:
    """Of the absent pairs those where the split into words, numbers, marks and white space ends too, or would go on
    alike: never after white space (a last blank belongs to what follows), never where an apostrophe and letters may be
    an ending, and never inside a character. Before a blank any first byte is taken; see ``cuts`` for wide spaces."""
    first, second = np.meshgrid(_BYTES, _BYTES, indexing="ij")
    starts = (second < 0x80) | (second >= 0xC2)
    apostrophe = ((first == 39) & _LETTER[second]) | ((second == 39) & ~_PLAIN[first])
    ok = absent & _PRINTED[first] & starts & ~apostrophe | absent & (first >= 0x80) & (second == 32)
    for pair in _ENDINGS:
        ok[pair[0], pair[1]] = False
    return ok


def cuts(data: np.ndarray, certain: np.ndarray) -> np.ndarray:
    """Whether a fragment starts at each byte of ``data`` (the first one excepted)."""
    out = np.zeros(len(data), bool)
    if len(data) > 1:
        out[1:] = certain.reshape(-1)[data[:-1].astype(np.uint16) * np.uint16(256) + data[1:]]
        wide = np.flatnonzero(out[2:] & (data[1:-1] >= 0x80)) + 2
        out[wide[_WIDE_SPACE_BEFORE[data[wide - 2]]]] = False  # perhaps a white-space character before the blank
    return out


def joined(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts one after another, and where each starts and the last one ends."""
    return b"".join(texts), np.cumsum([0, *map(len, texts)])


def fragments(data: bytes, ends: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct fragments, the number of each fragment in turn, and the first fragment of each text (and of the end).
    ``starts``: whether a fragment starts at a byte."""
    starts[ends[:-1][ends[:-1] < len(data)]] = True
    at = np.flatnonzero(starts)
    found = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(), np.searchsorted(at, ends)


def parts(text: bytes, certain: np.ndarray, size: int, apart: int = 256) -> Iterator[bytes]:
    """A long text in parts that end at certain cuts, of about ``size`` bytes; the last cut of a part lies ``apart``
    bytes before what has been looked at, so that no special string runs over it."""
    at = 0
    while len(text) - at > size:
        take = size
        while True:
            window = np.frombuffer(text, np.uint8, min(take, len(text) - at), at)
            found = np.flatnonzero(cuts(window, certain)[: -2 * apart])
            found = found[found > apart]
            if len(found) or take >= len(text) - at:
                break
            take *= 2
        if not len(found):
            break
        yield text[at : at + int(found[-1])]
        at += int(found[-1])
    yield text[at:]


def open_ended(fragment: bytes, certain: np.ndarray) -> bool:
    """Whether a fragment begins with a blank and a certain cut would follow it if a blank came next, so that such
    fragments, one after another, are the fragments of the text that they make up."""
    last = fragment[-1]
    return fragment[0] == 32 and bool(certain[last, 32]) and (last < 0x80 or not (len(fragment) > 1 and _WIDE_SPACE_BEFORE[fragment[-2]]))


def runs(fragments: list[bytes], certain: np.ndarray, most: int = 1000) -> Iterator[list[int]]:
    """Places of the fragments, each once: those that can be encoded as one text together, any other alone."""
    some = []
    for i, f in enumerate(fragments):
        if not open_ended(f, certain):
            yield [i]
        else:
            some.append(i)
    for k in range(0, len(some), most):
        yield some[k : k + most]


def divided(ids: list[int], lengths: np.ndarray, fragments: list[bytes]) -> list[int] | None:
    """Where each fragment's ids start and the last one's end; None if a token does not end where a fragment does."""
    ends, bounds = np.cumsum(lengths[ids]), np.cumsum([len(f) for f in fragments])
    at = np.searchsorted(ends, bounds)
    if len(ends) and at[-1] == len(ends) - 1 and (ends[at] == bounds).all():
        return [0, *(at + 1).tolist()]
    return None


class Memory:
    """What ``learn`` says of fragments, remembered by a Python worker up to a number of bytes and then begun afresh."""

    def __init__(self, learn: Callable[[list[bytes]], list[tuple]], most: int):
        self.learn, self.most, self.size = learn, most, 0
        self.known: dict[bytes, tuple] = {}

    def of(self, distinct: pa.Array) -> list[tuple]:
        every = distinct.to_pylist()
        if new := [x for x in every if x not in self.known]:
            if self.size > self.most:
                self.known, self.size, new = {}, 0, every
            self.known.update(zip(new, self.learn(new), strict=True))
            self.size += sum(4 * len(x) + 400 for x in new)  # values and Python objects
        return [self.known[x] for x in every]


def special_starts(data: bytes, ends: np.ndarray, starts: np.ndarray, special: list[bytes]) -> None:
    """Fragments start before and after each special string that lies in one text, and none starts inside it."""
    if special and any(s in data for s in special):
        for m in re.finditer(b"|".join(map(re.escape, sorted(special, key=len, reverse=True))), data):
            a, b = m.span()
            if np.searchsorted(ends, a, side="right") == np.searchsorted(ends, b - 1, side="right"):
                starts[a + 1 : b] = False
                starts[a] = True
                if b < len(data):
                    starts[b] = True
