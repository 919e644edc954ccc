"""Texts as arrays: code points, words and word hashes of many texts at once.

The Arrow-batched operators work on *blocks*: the code points of consecutive
texts in one array plus the texts' offsets. A block holds about
``BLOCK_CHARS`` code points (a longer text is a block of its own), so memory in
a task is bounded by the longest text, not by the batch. Nulls are empty texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

BLOCK_CHARS = 1 << 20

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)


@dataclass
class Block:
    """Texts ``first .. first + len(offsets) - 2`` of a batch."""

    first: int
    codes: np.ndarray    # uint32, the code points of all texts of the block
    offsets: np.ndarray  # int64, n + 1 starts within codes

    @property
    def count(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.slice(int(self.offsets[i]), int(self.offsets[i + 1]))

    def slice(self, start: int, end: int) -> str:
        return self.codes[start:end].tobytes().decode("utf-32-le")


@functools.lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point by Unicode property: letter, number, white space, other."""
    lut = np.zeros(0x110000, dtype=np.uint8)
    for lo, hi in ((0, 0xD800), (0xE000, 0x110000)):  # without the surrogates
        chars = "".join(map(chr, range(lo, hi)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, chars):
                lut[lo + m.start():lo + m.end()] = kind
    return lut


def as_strings(column: pa.Array) -> pa.Array:
    """A string column with nulls read as empty texts."""
    if pa.types.is_null(column.type):
        return pa.array([""] * len(column), pa.string())
    return column.fill_null("") if column.null_count else column


def blocks(column: pa.Array, lower: bool = False, limit: int = BLOCK_CHARS) -> Iterator[Block]:
    column = as_strings(column)
    if lower:
        column = pc.utf8_lower(column)
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    wide = pa.types.is_large_string(column.type)
    _, raw_offsets, data = column.buffers()
    data = memoryview(data) if data is not None else memoryview(b"")
    at = np.frombuffer(raw_offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    first = 0
    while first < len(column):
        base = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
        text = bytes(data[int(at[first]):int(at[last])]).decode("utf-8")
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        offsets = np.concatenate([[0], ends[first:last] - base]).astype(np.int64)
        yield Block(first, codes, offsets)
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (in place on a fresh array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse mod 2^64, at least ``n``."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_CHARS + 1)
        inverse = np.uint64(pow(int(_MULT), -1, 1 << 64))
        tables = []
        for base in (_MULT, inverse):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers[0], _powers[1]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``codes[start:end]``; equal spans hash alike wherever they stand."""
    power, inverse = _power_tables(len(codes) + 1)
    sums = np.empty(len(codes) + 1, dtype=np.uint64)
    sums[0] = 0
    terms = codes.astype(np.uint64)
    terms += np.uint64(1)
    terms *= power[:len(codes)]
    np.cumsum(terms, out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def doc_starts(block: Block) -> np.ndarray:
    """Mask over the code points (one more than there are): a text starts here."""
    mask = np.zeros(len(block.codes) + 1, dtype=bool)
    mask[block.offsets] = True
    return mask


def word_spans(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of every word: a maximal run of letters and numbers in one text."""
    kind = char_classes()[block.codes]
    inside = (kind == LETTER) | (kind == NUMBER)
    if not len(inside):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    new = doc_starts(block)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | new[:-1]))
    ends = np.flatnonzero(inside & (~after | new[1:])) + 1
    return starts, ends, np.searchsorted(block.offsets, starts, side="right") - 1


def group_starts(owner: np.ndarray, n: int) -> np.ndarray:
    """Offsets (n + 1) of the runs of the sorted ``owner`` values 0 .. n - 1."""
    return np.searchsorted(owner, np.arange(n + 1))
