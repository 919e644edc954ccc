"""Best-fit packing by minimum bin slack (operator 10).

Documents become pieces of at most ``capacity`` tokens, and pieces are packed
into sequences. Minimum bin slack fills one bin at a time: the longest piece
left is placed, a bitset subset-sum over the lengths still available finds the
fullest combination that fits beside it, and that combination is removed. Only
lengths matter to it, so it runs on the histogram of piece lengths (at most
``capacity`` rows, whatever the corpus); a combination is emitted as often as
the counts allow, which is what filling bin after bin would do. The pieces are
then numbered within their length and look up their place by that number.

Cases: a null text is empty (one piece, the end id alone); equal rows are
separate pieces; a null ``doc_id`` is kept; an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.numbering import number_salted
from quillstream.llm.textarrays import (
    LETTER,
    NUMBER,
    OTHER,
    SPACE,
    Block,
    as_strings,
    blocks,
    char_classes,
    doc_starts,
    span_hashes,
)

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k"
MAX_KNOWN = 3_000_000  # word forms kept per Python worker; dropped and refilled beyond

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- tokens -------------------------------------------------------------------

def pretoken_starts(block: Block) -> np.ndarray:
    """Starts of the pre-tokens of the byte-level BPE, over all texts of a block.

    The split rule of the vocabulary: contractions; runs of letters, numbers or
    other signs with one blank before them; white space, whose last character
    stays apart if something follows it.
    """
    codes = block.codes
    n = len(codes)
    kind = char_classes()[codes]
    new = doc_starts(block)[:n]
    prev = np.empty_like(kind)
    prev[0] = 255
    prev[1:] = kind[:-1]
    prev[new] = 255  # nothing before the first character of a text
    solid = kind != SPACE
    run = kind != prev                      # a run of one class starts
    blank = codes == 32
    after_blank = np.zeros(n, dtype=bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~new
    start = new | (run & ~(solid & after_blank))
    # the last white space of a run, if a solid character of the same text follows
    last = np.zeros(n, dtype=bool)
    last[:-1] = (kind[:-1] == SPACE) & solid[1:] & ~new[1:]
    start |= last
    # contractions: an apostrophe alone that starts its own pre-token, then s, t, m, d, re, ve, ll
    quote = np.flatnonzero((codes == 39) & start)
    if len(quote):
        doc_end = block.offsets[np.searchsorted(block.offsets, quote, side="right")]
        c1 = np.where(quote + 1 < doc_end, codes[np.minimum(quote + 1, n - 1)], 0)
        c2 = np.where(quote + 2 < doc_end, codes[np.minimum(quote + 2, n - 1)], 0)
        one = np.isin(c1, [ord(c) for c in "stmd"])
        two = ((c1 == ord("r")) | (c1 == ord("v"))) & (c2 == ord("e"))
        two |= (c1 == ord("l")) & (c2 == ord("l"))
        size = np.where(one, 2, np.where(two, 3, 0))
        q, size, end = quote[size > 0], size[size > 0], doc_end[size > 0]
        start[q + 1] = False
        after = q + size
        after = after[after < end]
        # what follows a contraction starts anew, unless it is the solid run after a blank, which has its start already
        start[after] = True
    return np.flatnonzero(start)


@functools.lru_cache(maxsize=2)
def _encoders(vocabulary: str):
    import public_tokenizers as public
    import tiktoken
    from tokenizers import Tokenizer

    with open(public.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    words = tiktoken.Encoding(vocabulary, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return words, Tokenizer.from_file(public.path(f"{vocabulary}.json"))


class TokenIds:
    """Token ids of whole blocks; the ids of each distinct pre-token are computed once."""

    SPECIAL = "<|endoftext|>"

    def __init__(self, vocabulary: str = VOCABULARY):
        self.words, self.full = _encoders(vocabulary)
        self.reset()

    def reset(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)   # sorted hashes of pre-tokens
        self.entry = np.zeros(0, dtype=np.int64)    # their entries
        self.at = np.zeros(1, dtype=np.int64)       # entry -> start of its ids
        self.ids = np.zeros(0, dtype=np.uint32)

    def _entries(self, block: Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inverse, distinct = pd.factorize(span_hashes(block.codes, starts, ends))
        if len(self.known) > MAX_KNOWN:
            self.reset()
        order = np.argsort(distinct)
        distinct, rank = distinct[order], np.empty_like(order)
        rank[order] = np.arange(len(order))
        where = np.searchsorted(self.known, distinct)
        found = np.zeros(len(distinct), dtype=bool)
        if len(self.known):
            found = self.known[np.minimum(where, len(self.known) - 1)] == distinct
        missing = np.flatnonzero(~found)
        if len(missing):
            some = np.empty(len(distinct), dtype=np.int64)  # a place of each distinct pre-token
            some[rank[inverse]] = np.arange(len(inverse))
            text, encode = block.slice(0, len(block.codes)), self.words.encode_ordinary
            new = [encode(text[s:e]) for s, e in zip(starts[some[missing]].tolist(), ends[some[missing]].tolist())]
            entries = len(self.at) - 1 + np.arange(len(new))
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum([len(x) for x in new])])
            self.ids = np.concatenate([self.ids, np.array(list(chain.from_iterable(new)), dtype=np.uint32)])
            self.entry = np.insert(self.entry, where[missing], entries)
            self.known = np.insert(self.known, where[missing], distinct[missing])
            where = np.searchsorted(self.known, distinct)
        return self.entry[where][rank][inverse]

    def __call__(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the texts' offsets among them."""
        starts = pretoken_starts(block) if len(block.codes) else np.zeros(0, dtype=np.int64)
        ends = np.append(starts[1:], len(block.codes))
        entry = self._entries(block, starts, ends) if len(starts) else np.zeros(0, dtype=np.int64)
        size = self.at[entry + 1] - self.at[entry]
        owner = np.searchsorted(block.offsets, starts, side="right") - 1
        counts = np.bincount(owner, weights=size, minlength=block.count).astype(np.int64)
        total = int(size.sum())
        source = np.repeat(self.at[entry] - (np.cumsum(size) - size), size) + np.arange(total)
        out = np.full(total + block.count, END_ID, dtype=np.uint32)
        out[np.arange(total) + np.repeat(np.arange(block.count), counts)] = self.ids[source]
        offsets = np.concatenate([[0], np.cumsum(counts + 1)])
        return self._with_specials(block, out, offsets)

    def _with_specials(self, block: Block, ids: np.ndarray, offsets: np.ndarray):
        """Texts that spell a special token are encoded by the tokenizer as a whole."""
        bars = np.flatnonzero((block.codes[:-1] == 60) & (block.codes[1:] == 124)) if len(block.codes) > 1 else ()
        odd = [i for i in np.unique(np.searchsorted(block.offsets, bars, side="right") - 1).tolist() if self.SPECIAL in block.text(i)] if len(bars) else []
        if not odd:
            return ids, offsets
        parts = [ids[offsets[i]:offsets[i + 1]] for i in range(block.count)]
        for i in odd:
            parts[i] = np.array([*self.full.encode(block.text(i), add_special_tokens=False).ids, END_ID], dtype=np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def piece_bounds(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, and a shorter first one if needed."""
    start, length = 0, n % capacity or min(n, capacity)
    while start < n:
        yield start, length
        start, length = start + length, capacity


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Pieces of every document of ``docs(doc_id, text)``; with ``with_ids`` also their token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenIds(vocabulary)
        for batch in batches:
            names, texts = batch.column(0), as_strings(batch.column(1))
            for block in blocks(texts):
                ids, offsets = tokens(block)
                ids = ids.astype("<u4")
                rows = [
                    (i, k, start, length, int(offsets[i]) + start)
                    for i in range(block.count)
                    for k, (start, length) in enumerate(piece_bounds(int(offsets[i + 1] - offsets[i]), capacity))
                ]
                owner, piece, start, length, at = (np.array(c, dtype=np.int64) for c in zip(*rows))
                crc = [zlib.crc32(ids[a:a + m].tobytes()) for a, m in zip(at.tolist(), length.tolist())]
                columns = [
                    names.take(pa.array(owner + block.first)), pa.array(piece, pa.int32()), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([ids[a:a + m].astype(np.int32).tolist() for a, m in zip(at.tolist(), length.tolist())], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)])

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


# --- packing ------------------------------------------------------------------

def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """(length, copies) of the fullest multiset of the available lengths within ``room``.

    ``counts[l]`` copies of length ``l`` are available. Bit ``b`` of the bitset
    says that total ``b`` can be reached; copies are added in powers of two.
    """
    bits, steps, target = 1, [], 1 << room
    mask = (target << 1) - 1
    for length in np.flatnonzero(counts[:room + 1])[::-1].tolist():
        left, copies = min(int(counts[length]), room // length), 1
        while left > 0:
            take = min(copies, left)
            steps.append((length, take, bits))
            bits |= (bits << (length * take)) & mask
            left, copies = left - take, copies * 2
        if bits & target:
            break
    total, used = bits.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return sorted(used.items(), reverse=True)


def fill_patterns(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Minimum bin slack on a histogram: (bins, [(length, copies), ...]) in the order the bins are filled."""
    counts, patterns = counts.copy(), []
    for seed in range(capacity, 0, -1):
        while counts[seed]:
            counts[seed] -= 1
            parts = dict(fullest(counts, capacity - seed))
            counts[seed] += 1
            parts[seed] = parts.get(seed, 0) + 1
            bins = min(int(counts[length]) // copies for length, copies in parts.items())
            for length, copies in parts.items():
                counts[length] -= bins * copies
            patterns.append((bins, sorted(parts.items(), reverse=True)))
    return patterns


def _places(patterns, capacity: int):
    """Per length: number of the first piece, copies a bin, offset and first sequence of each pattern."""
    places: list[list[tuple[int, int, int, int]]] = [[] for _ in range(capacity + 1)]
    used = [0] * (capacity + 1)
    sequence = 0
    for bins, parts in patterns:
        offset = 0
        for length, copies in parts:
            places[length].append((used[length], copies, offset, sequence))
            used[length] += bins * copies
            offset += copies * length
        sequence += bins
    return [np.array(p, dtype=np.int64).reshape(-1, 4) for p in places]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 .. ``capacity`` tokens.

    ``pieces`` is read twice (the histogram, then the assignment): pass a
    checkpointed table. Only the histogram, of at most ``capacity`` rows, reaches
    the driver.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[row["length"]] = row["count"]
    places = _places(fill_patterns(counts, capacity), capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("_number").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else ():
                size = int(length[rows[0]])
                first, copies, at, base = places[size][np.searchsorted(places[size][:, 0], number[rows], side="right") - 1].T
                sequence[rows] = base + (number[rows] - first) // copies
                offset[rows] = at + (number[rows] - first) % copies * size
            kept = batch.drop_columns(["_number"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence), pa.array(offset)], [*kept.schema.names, "sequence_id", "offset"])

    numbered = number_salted(pieces, "length", ["doc_id", "piece", "ids_crc32"], "_number")
    schema = numbered.drop("_number").schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all documents with their places (see ``token_pieces`` and ``pack``)."""
    return pack(token_pieces(docs, capacity, vocabulary).checkpoint(), capacity)
