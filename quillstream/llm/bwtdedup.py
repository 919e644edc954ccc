"""Repeated byte strings by merged Burrows-Wheeler transforms (operator 6).

Every byte that a ``LENGTH``-byte string covers which also starts earlier
(smaller ``doc_id``, or earlier in the same document) is removed. Texts are UTF-8
bytes; strings do not cross documents.

1. Deal. Strings that may be equal have to meet in one task. Each window of
   ``LENGTH`` bytes is dealt by the smallest hash of its ``GRAM``-byte grams (its
   minimiser), a function of its content alone. Consecutive windows with the same
   minimiser stay one *segment* of at most ``2 * LENGTH - GRAM`` bytes. Segments
   whose minimiser occurs once in the corpus hold no repeated string and stay home.
2. Shards. Strings that have neither half of a window around the minimiser in common
   with another one of it are left out (``may_share``). A task lays the segments it got into shards of about ``SHARD`` bytes and
   builds the Burrows-Wheeler transform of each (``shard_bwt``).
3. Merge. ``interleave`` merges the transforms of all shards by interleave
   refinement: the merged order starts as shard after shard; each pass puts the
   rows into the buckets of the characters before them, stably, which sorts by those
   characters more. No suffixes are compared or sorted again. Where a bucket or a
   block ends, a block of the next depth ends too: that gives the common prefixes
   (in steps of the pass) and, after ``LENGTH`` characters, the intervals of equal
   strings. In each interval the earliest start stays and the others are marked.
4. Cut. Marks go back to their documents; the covered bytes are left out.

Exact copies of a text are one representative before step 1: all of a later copy's
strings start earlier. In step 1 a task sends equal segments once and marks the
later ones itself, so a passage in a third of all documents reaches its minimiser
once a task; segments of a minimiser with more than ``HOT`` occurrences are sent as
single strings dealt by their own hash instead, so differing surroundings of a
common passage do not meet in one task. Equal segments of several tasks are one
string of the transforms. Nothing is dropped or capped.

Cases: a null text is empty; texts under ``LENGTH`` bytes keep everything; rows with
the same id and text are one document and get the same result; of different texts
with one id the one with the smaller digest counts as earlier; a null ``doc_id``
ranks last; an empty table gives no rows; extra columns are not read. A document is
known by (rank, version) throughout, its version being 64 bits of the text's digest,
so many rows without an id are spread like any others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.textarrays import BLOCK_CHARS, as_strings, mix, span_hashes
from quillstream.session import default_partitions

LENGTH = 100
GRAM = 24
NEAR = 1 << 16       # bytes whose segments are found at a time, beyond one text
SHARD = 1 << 17      # bytes of a shard
STEP = 20            # characters that a pass of the merge may sort by
CHUNK = 1 << 22      # bytes merged at a time, beyond one key
HOT = 50_000         # occurrences of a minimiser from which single strings are dealt
LAST = (1 << 63) - 1

_SECOND = np.uint64(0xA0761D6478BD642F)
_BYTES = mix(np.arange(256, dtype=np.uint64) + _SECOND)  # a hash of each byte


# --- dealing ----------------------------------------------------------------------

def byte_blocks(column: pa.Array, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive texts."""
    column = as_strings(column)
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    data = column.cast(pa.large_binary())
    first = 0
    while first < len(column):
        base = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
        raw = b"".join(x.as_buffer() if x.is_valid else b"" for x in data.slice(first, last - first))
        yield first, np.frombuffer(raw, dtype=np.uint8), np.concatenate([[0], ends[first:last] - base])
        first = last


def segments(codes: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, minimiser, its place) of the segments of a block; the segment's
    bytes are ``windows + length - 1`` from its start."""
    parts, first = [], 0
    while first < len(offsets) - 1:  # whole texts of about NEAR bytes, so that the arrays stay in the processor's cache
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + NEAR, side="right")) - 1)
        base = offsets[first]
        start, windows, key, at = _segments(codes[base:offsets[last]], offsets[first:last + 1] - base, length, gram)
        parts.append((start + base, windows, key, at + base))
        first = last
    return tuple(np.concatenate(p) for p in zip(*parts))


def _segments(codes: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(codes) - length + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return none, none, none, none
    h, size = _BYTES.take(codes), 1
    while size < gram:  # hash of the first `gram` bytes from each place, by doubling
        step = min(size, gram - size)
        h = h[:len(h) - step] * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + h[step:]
        size += step
    grams = mix(h)
    # smallest upper half of the hash, the leftmost of equal ones, among the grams of each window
    packed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width, span = length - gram + 1, 1
    low = packed
    while span < width:
        step = min(span, width - span)
        low = np.minimum(low[:len(low) - step], low[step:])
        span += step
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # windows of one text: none starts in the last ``length - 1`` bytes of a text
    valid, first = np.ones(n, dtype=bool), np.zeros(n, dtype=bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        valid[max(a, b - length + 1):b] = False
        first[a:a + 1] = True
    new = first
    new[1:] |= ~valid[:-1] | (at[1:] != at[:-1])
    new &= valid
    start = np.flatnonzero(new)
    stops = np.flatnonzero(valid & np.append((~valid | new)[1:], True)) + 1
    return start, stops - start, grams[at[start]].view(np.int64), at[start]


def _minimisers(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(minimiser, rank, ver, n) of every text (rank, ver, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, codes, offsets in byte_blocks(batch.column(2)):
                start, _, key, _ = segments(codes, offsets, length, gram)
                owner = np.searchsorted(offsets, start, side="right") - 1
                order = np.lexsort((key, owner))
                key, owner = key[order], owner[order]
                cut = np.ones(len(key), dtype=bool)
                cut[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
                places = np.flatnonzero(cut)
                at = pa.array(owner[places] + first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[places]), batch.column(0).take(at), batch.column(1).take(at), pa.array(np.diff(np.append(places, len(key))).astype(np.int32))],
                    ["minimiser", "rank", "ver", "n"],
                )

    return texts.mapInArrow(run, "minimiser long, rank long, ver long, n int")


DEALT = "key long, rank long, ver long, start long, windows long, pivot int, bytes binary"


def _dealt(marked: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments to merge, and (with null bytes) windows already found to be repeated,
    of texts (rank, ver, text, shared) where ``shared`` lists (minimiser, hot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}  # segments this task has sent
        for batch in batches:
            listed = batch.column(3)
            sizes = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, flat = np.cumsum(sizes), listed.flatten()
            keys = flat.field(0).to_numpy(zero_copy_only=False)
            hots = flat.field(1).to_numpy(zero_copy_only=False)
            ranks, vers = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for first, codes, offsets in byte_blocks(batch.column(2)):
                start, windows, key, pivot = segments(codes, offsets, length, gram)
                owner = np.searchsorted(offsets, start, side="right") - 1
                last = first + len(offsets) - 2
                here = slice(ends[first] - sizes[first], ends[last])
                tag = lambda who, x: mix(x.view(np.uint64) + mix(who.astype(np.uint64)))
                of = np.repeat(np.arange(len(offsets) - 1), sizes[first:last + 1])
                wanted = tag(of, keys[here].astype(np.int64))
                mine = tag(owner, key)
                some = np.isin(mine, wanted)
                hot = np.isin(mine, wanted[hots[here].astype(bool)])
                start, windows, key, pivot, owner, hot = start[some], windows[some], key[some], pivot[some], owner[some], hot[some]
                if hot.any():  # single strings, dealt by their own hash
                    n = np.where(hot, windows, 1)
                    shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    start, windows = np.repeat(start, n) + shift, np.where(np.repeat(hot, n), 1, np.repeat(windows, n))
                    key, pivot, owner, hot = np.repeat(key, n), np.repeat(pivot, n), np.repeat(owner, n), np.repeat(hot, n)
                stop = start + windows + length - 1
                one = span_hashes(codes, start, stop)
                two = span_hashes(_BYTES.take(codes), start, stop)
                key = np.where(hot, one.view(np.int64), key)
                digests = np.stack([one, two], axis=1)
                rank, ver = ranks[first + owner], vers[first + owner]
                place = start - offsets[owner]
                raw, data = codes.tobytes(), []
                for d, a, b, r, v, p in zip(digests, start.tolist(), stop.tolist(), rank.tolist(), ver.tolist(), place.tolist()):
                    digest, at = d.tobytes(), (r, v, p)
                    data.append(None if seen.setdefault(digest, at) < at else raw[a:b])
                # neighbours already found are one row
                known = np.array([d is None for d in data], dtype=bool)
                joins = np.zeros(len(known), dtype=bool)
                joins[1:] = known[1:] & known[:-1] & (owner[1:] == owner[:-1]) & (place[1:] == (place + windows)[:-1])
                heads = np.flatnonzero(~joins)
                if len(heads):
                    windows = np.add.reduceat(windows, heads)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[heads]), pa.array(rank[heads]), pa.array(ver[heads]), pa.array(place[heads]), pa.array(windows), pa.array((pivot - start)[heads].astype(np.int32)), pa.array([data[i] for i in heads.tolist()], pa.binary())],
                    ["key", "rank", "ver", "start", "windows", "pivot", "bytes"],
                )

    return marked.mapInArrow(run, DEALT)


# --- transforms ---------------------------------------------------------------------

def shard_bwt(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and Burrows-Wheeler transform of one shard.

    ``codes`` ends with the terminator 0. Suffixes are sorted by at least ``depth``
    characters, equal ones by position.
    """
    n = len(codes)
    bits = n.bit_length()
    width = max(1, min(8, (64 - bits) // 8))  # characters beside a position in a number
    padded = np.concatenate([codes, np.zeros(width, dtype=np.uint8)])
    key = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        key = (key << np.uint64(8)) | padded[i:n + i]
    reached = width
    while True:
        ordered, order = _sorted(key, bits)
        new = np.ones(n, dtype=np.int64)
        new[1:] = ordered[1:] != ordered[:-1]
        ranked = np.cumsum(new)
        if reached >= depth or ranked[-1] == n:
            break
        rank = np.empty(n, dtype=np.int64)
        rank[order] = ranked
        after = np.zeros(n, dtype=np.int64)
        after[:n - reached] = rank[reached:] if reached < n else 0
        key = ((rank << bits) | after).astype(np.uint64)
        reached *= 2
    return order, codes.take(order - 1)


def _sorted(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their positions, equal keys by position; sorted as one number
    with the position in its low ``bits`` where it has room."""
    if int(key.max(initial=0)).bit_length() + bits > 64:
        order = np.argsort(key, kind="stable")
        return key.take(order), order
    packed = (key << np.uint64(bits)) | np.arange(len(key), dtype=np.uint64)
    packed.sort()
    return packed >> np.uint64(bits), (packed & np.uint64((1 << bits) - 1)).view(np.int64)


def _before(last: np.ndarray, step: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A number, in their order, of the ``size`` characters before each row (the earlier
    one in the text is the more significant), and the row of the suffix longer by them."""
    bits = len(last).bit_length()
    one = last.astype(np.uint64)
    key, jump, width = one, step, 8
    for more in bin(size)[3:]:  # by doubling
        if 2 * width + 8 + bits > 64:  # no room: numbers of the distinct ones
            ordered, order = _sorted(key, bits)
            new = np.ones(len(key), dtype=np.uint64)
            new[1:] = ordered[1:] != ordered[:-1]
            ranked = np.cumsum(new)
            key = np.empty_like(ranked)
            key[order] = ranked
            width = int(ranked[-1]).bit_length()
        key, jump, width = (key.take(jump) << np.uint64(width)) | key, jump.take(jump), 2 * width
        if more == "1":
            key, jump, width = (one.take(jump) << np.uint64(width)) | key, step.take(jump), width + 8
    return key, jump


def interleave(bwts: list[np.ndarray], depth: int, size: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge transforms by interleave refinement to ``depth`` characters, ``size`` of them
    a pass (``depth`` is a multiple).

    Returns the merged order (row numbers, counted through the shards), the block of
    equal prefixes of each merged row, and the common prefix of each row with the one
    before it (rounded down to the step of a pass; ``depth`` for rows of one block).
    """
    total = sum(map(len, bwts))
    narrow = np.int32 if total < 1 << 31 else np.int64
    # the row of the suffix one character longer, by counting within each shard
    step = np.empty(total, dtype=narrow)
    base = 0
    for b in bwts:
        step[base + np.argsort(b, kind="stable")] = np.arange(base, base + len(b))
        base += len(b)
    key, jump = _before(np.concatenate(bwts), step, size)
    row, block = np.arange(total, dtype=narrow), np.zeros(total, dtype=narrow)
    common = np.full(total, depth, dtype=np.int16)
    for reached in range(0, depth, size):
        k, order = _sorted(key.take(row), total.bit_length())  # stable buckets
        held = block.take(order)
        new = np.zeros(total, dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (held[1:] != held[:-1])
        row, block = jump.take(row.take(order)), np.cumsum(new, dtype=narrow)
        common[new & (common == depth)] = reached
    common[:1] = 0
    return row, block, common


def repeated_starts(strings: list[bytes], windows: np.ndarray, rank: np.ndarray, ver: np.ndarray, start: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of the windows that also start earlier.

    String ``i`` has ``windows[i]`` windows of ``length`` bytes and starts at byte
    ``start[i]`` of document (``rank[i]``, ``ver[i]``).
    """
    sizes = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    # no byte of UTF-8 is 255, so one up leaves 0 to the terminators
    codes = np.frombuffer(b"\xff".join(strings) + b"\xff", dtype=np.uint8) + np.uint8(1)
    cuts = np.flatnonzero(np.diff(begin // SHARD)) + 1
    bounds = [0, *begin[cuts].tolist(), len(codes)]
    orders, bwts = [], []
    for a, b in zip(bounds[:-1], bounds[1:]):
        order, bwt = shard_bwt(codes[a:b], length)
        orders.append(order + a)
        bwts.append(bwt)
    row, block, _ = interleave(bwts, length, max(n for n in range(1, STEP + 1) if length % n == 0))
    place = np.concatenate(orders).take(row)
    owner = np.repeat(np.arange(len(strings)), sizes)
    whole = (np.arange(len(codes)) - begin.take(owner) < windows.take(owner)).take(place)
    place, block = place[whole], block[whole]
    string = owner.take(place)
    offset = place - begin.take(string)
    # repeated intervals: blocks with several whole windows; the earliest stays
    same = np.zeros(len(block), dtype=bool)
    same[1:] = block[1:] == block[:-1]
    same[:-1] |= same[1:]
    string, offset, block = string[same], offset[same], block[same]
    at = start[string] + offset
    order = np.lexsort((at, ver[string], rank[string], block))
    string, offset, block, at = string[order], offset[order], block[order], at[order]
    head = np.ones(len(block), dtype=bool)
    head[1:] = block[1:] != block[:-1]
    lead = np.maximum.accumulate(np.where(head, np.arange(len(block)), 0))
    later = (rank[string] != rank[string[lead]]) | (ver[string] != ver[string[lead]]) | (at != at[lead])
    return string[later], offset[later]


def may_share(strings: list[bytes], key: np.ndarray, pivot: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Mask of the strings that may share ``length`` bytes with another one of their key.

    Equal windows have the minimiser (at ``pivot``) at the same place, so half of the
    bytes beside it lie before it in both, or more than the rest from it on. A string
    that has neither part in common with another shares no window: nothing is lost.
    """
    half = (length - gram) // 2
    rest = length - half + 1
    mask = np.zeros(len(strings), dtype=bool)
    for parts in (
        [hash((k, s[p - half:p])) if p >= half else None for s, k, p in zip(strings, key.tolist(), pivot.tolist())],
        [hash((k, s[p:p + rest])) if len(s) >= p + rest else None for s, k, p in zip(strings, key.tolist(), pivot.tolist())],
    ):
        at = np.array([i for i, h in enumerate(parts) if h is not None], dtype=np.int64)
        _, of, sizes = np.unique(np.array([h for h in parts if h is not None], dtype=np.int64), return_inverse=True, return_counts=True)
        mask[at[sizes[of] > 1]] = True
    return mask


def _merged(dealt: DataFrame, length: int, gram: int) -> DataFrame:
    """(rank, ver, start, windows): runs of windows that also start earlier."""

    def runs(string: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((offset, string))
        string, offset = string[order], offset[order]
        cut = np.ones(len(string), dtype=bool)
        cut[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
        first = np.flatnonzero(cut)
        return string[first], offset[first], np.diff(np.append(first, len(string)))

    def merge(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        key, rank, ver, start, windows = (table.column(c).to_numpy().astype(np.int64) for c in ("key", "rank", "ver", "start", "windows"))
        pivot = table.column("pivot").to_numpy().astype(np.int64)
        data = table.column("bytes").to_pylist()
        # equal segments of several tasks are one string; the later ones are marked whole
        order = np.lexsort((start, ver, rank))
        first: dict[bytes, int] = {}
        lead = np.empty(len(data), dtype=np.int64)
        for i in order.tolist():
            lead[i] = first.setdefault(data[i], i)
        copies = np.flatnonzero((rank[lead] != rank) | (ver[lead] != ver) | (start[lead] != start))
        # a minimiser with one string left has nothing to compare
        ones = np.flatnonzero(lead == np.arange(len(data)))
        _, of, sizes = np.unique(key[ones], return_inverse=True, return_counts=True)
        ones = ones[sizes[of] > 1]
        ones = ones[may_share([data[i] for i in ones.tolist()], key[ones], pivot[ones], length, gram)]
        string, offset, count = copies, np.zeros(len(copies), dtype=np.int64), windows[copies]
        if len(ones):
            found, at, n = runs(*repeated_starts([data[i] for i in ones.tolist()], windows[ones], rank[ones], ver[ones], start[ones], length))
            string, offset, count = np.concatenate([string, ones[found]]), np.concatenate([offset, at]), np.concatenate([count, n])
        return pa.RecordBatch.from_arrays(
            [pa.array(rank[string]), pa.array(ver[string]), pa.array(start[string] + offset), pa.array(count)], ["rank", "ver", "start", "windows"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:  # sorted by key
            done = batch.filter(pc.is_null(batch.column("bytes")))
            if len(done):
                yield done.select(["rank", "ver", "start", "windows"])
            batch = batch.filter(pc.is_valid(batch.column("bytes")))
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)] if len(keys) else [0]
            total = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy(zero_copy_only=False).astype(np.int64))])
            at = 0
            for a, b in zip(cuts[:-1], cuts[1:]):  # groups of one key; the first may go on from the batch before
                if size + total[a] - total[at] >= CHUNK and (a or not held or held[-1].column("key")[-1].as_py() != keys[0]):
                    held += [batch.slice(at, a - at)] if a > at else []
                    if held:
                        yield merge(held)
                    held, size, at = [], 0, a
            if len(keys) > at:
                held.append(batch.slice(at))
                size += int(total[-1] - total[at])
        if held:
            yield merge(held)

    return dealt.mapInArrow(run, "rank long, ver long, start long, windows long")


# --- the operator ---------------------------------------------------------------------

def _version(text: Column) -> Column:
    """The first 64 bits of the digest, as a number in the digests' order."""
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("long").bitwiseXOR(F.lit(-1 << 63))


def dedup_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row of
    ``docs(doc_id, text)``; ``spans`` lists the removed runs as ``start-end,...`` in bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), rank.alias("rank"), _version(text).alias("ver"), F.unhex(F.md5(text)).alias("digest"), text.alias("text"))
    heads = rows.groupBy(F.col("digest").alias("head")).agg(F.min("rank").alias("rank"), F.first("ver").alias("ver")).checkpoint()
    # one row a distinct text, by (rank, ver) throughout, so that the texts are shuffled once
    first = rows.select("rank", "ver", "text").join(heads.select("rank", "ver"), ["rank", "ver"])
    texts = first.groupBy("rank", "ver").agg(F.first("text").alias("text")).sortWithinPartitions("rank", "ver")

    # one shuffle of the minimisers: a window keeps their rows, so they are found and sent once
    counted = _minimisers(texts, length, gram).withColumn("all", F.sum("n").over(Window.partitionBy("minimiser")))
    listed = (
        counted.where("all > 1")
        .groupBy("rank", "ver").agg(F.collect_list(F.struct("minimiser", (F.col("all") > HOT).alias("hot"))).alias("shared"))  # at most the segments of a document
    )
    partitions = default_partitions(docs.sparkSession)
    dealt = _dealt(texts.join(listed, ["rank", "ver"]).select("rank", "ver", "text", "shared").sortWithinPartitions("rank", "ver"), length, gram)
    merged = _merged(dealt.repartition(partitions, "key").sortWithinPartitions("key"), length, gram)
    marks = merged.groupBy("rank", "ver").agg(F.collect_list(F.struct("start", "windows")).alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rank, ver, data, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = np.frombuffer(data.encode(), dtype=np.uint8)
                spans = np.array([(m["start"], m["start"] + m["windows"] + length - 1) for m in found or ()], dtype=np.int64).reshape(-1, 2)
                edges = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(edges, spans[:, 0], 1)
                np.add.at(edges, spans[:, 1], -1)
                gone = np.cumsum(edges[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                kept = raw[~gone].tobytes()
                out.append((rank, ver, int(gone.sum()), len(turn) // 2, hashlib.sha256(kept).hexdigest(), ",".join(f"{a}-{b}" for a, b in turn.reshape(-1, 2).tolist())))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["rank", "ver", "n_removed", "n_spans", "kept_sha256", "spans"])

    result = texts.join(marks, ["rank", "ver"], "left").select("rank", "ver", "text", "marks").mapInArrow(
        cut, "rank long, ver long, n_removed long, n_spans long, kept_sha256 string, spans string"
    )
    named = heads.join(result, ["rank", "ver"]).drop("ver").withColumnRenamed("rank", "_first")
    narrow = rows.select("doc_id", "rank", F.col("digest").alias("head"), F.octet_length("text").cast("long").alias("n_bytes"))
    copy = (F.col("rank") != F.col("_first")) & (F.col("n_bytes") >= length)
    pick = lambda whole, name: F.when(copy, whole).otherwise(F.col(name)).alias(name)
    return narrow.join(named, "head").select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), "n_removed"), pick(F.lit(1).cast("long"), "n_spans"),
        pick(F.lit(hashlib.sha256(b"").hexdigest()), "kept_sha256"), pick(F.concat(F.lit("0-"), F.col("n_bytes")), "spans"),
    )
