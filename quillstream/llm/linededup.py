"""Repeated sentences and lines (operator 8): keep the earliest, remove the rest.

A text is cut into units at line breaks and sentence ends (``.``, ``!``, ``?``).
A unit is normalised to its lower-case words (runs of letters and numbers). A
unit of at least ``MIN_WORDS`` words is identified by its words; a shorter one
together with the fewest units with words before it that reach that many, so that
"Of." alone is never taken for a copy but goes with the passage around it, and a
passage of short lines is found (but for its first words). Digests (128 bits)
are grouped over all documents. The occurrence in the smallest ``doc_id`` and,
there, the first one stay; all others are removed from the texts, and their
offsets in the original text (code points) are returned.

Scale: a document sends each digest once; the groups are counts and minima, so a
unit that stands in most documents reaches its group as one row a task; what is
marked goes back through a join on the digest (a skewed one is split) and then
by document. No group is ever gathered.

Cases: a null text stays null and has no units; an empty text is unchanged; rows
that share a ``doc_id`` count as one document, so equal rows keep the same units; a
null ``doc_id`` ranks last, and there each text is a document of its own, by its
hash; other columns pass through whatever their names, but input columns named like
the added ones (``ADDED``) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.textarrays import Block, blocks, doc_starts, mix, span_hashes, word_spans

MIN_WORDS = 5
ADDED = ("n_units", "n_removed_units", "removed_spans")
LAST = (1 << 63) - 1  # rank of a null doc_id

_ENDS = np.array([ord(c) for c in ".!?\n"], dtype=np.uint32)
_GAPS = np.array([ord(c) for c in " \t\r"], dtype=np.uint32)
_SECOND = np.uint64(0xA0761D6478BD642F)
_PAIR = np.uint64(0xE7037ED1A0B428DB)


def unit_starts(block: Block) -> np.ndarray:
    """Starts of the units: texts' first characters, and whatever follows a run of
    sentence ends, line breaks and blanks that has an end or a line break in it."""
    codes = block.codes
    n = len(codes)
    if not n:
        return np.zeros(0, dtype=np.int64)
    at = np.arange(n)
    end = np.isin(codes, _ENDS)
    tail = end | np.isin(codes, _GAPS)
    last_end = np.maximum.accumulate(np.where(end, at, -1))
    last_solid = np.maximum.accumulate(np.where(tail, -1, at))
    start = np.zeros(n, dtype=bool)
    start[1:] = ~tail[1:] & (last_end[:-1] > last_solid[:-1])
    new = doc_starts(block)[:n]
    first = np.maximum.accumulate(np.where(new, at, 0))  # of the text around each character
    start[1:] &= last_end[:-1] >= first[1:]
    return np.flatnonzero(start | new)


class Units:
    """Units of a (lower-cased) block: starts, ends, owners, word counts and digests."""

    def __init__(self, block: Block, min_words: int = MIN_WORDS):
        self.starts = unit_starts(block)
        self.ends = np.append(self.starts[1:], len(block.codes))
        self.owner = np.searchsorted(block.offsets, self.starts, side="right") - 1
        word_start, word_end, _ = word_spans(block)
        hashes = span_hashes(block.codes, word_start, word_end)
        first = np.searchsorted(word_start, self.starts)
        last = np.append(first[1:], len(word_start))
        self.words = last - first
        one = span_hashes(hashes, first, last)
        two = span_hashes(mix(hashes ^ _SECOND), first, last)
        self.eligible = self.words >= min_words
        some = np.flatnonzero(self.words > 0)  # units without words stand between no others
        owner, total = self.owner[some], np.append(0, np.cumsum(self.words[some]))
        alone = one[some], two[some]
        open_ = np.flatnonzero(~self.eligible[some])
        for back in range(1, min_words):  # with so many units before them
            open_ = open_[open_ >= back]
            open_ = open_[owner[open_ - back] == owner[open_]]
            enough = total[open_ + 1] - total[open_ - back] >= min_words
            done, open_ = open_[enough], open_[~enough]
            for digest, unit in zip((one, two), alone):
                joined = unit[done - back]
                for j in range(back - 1, -1, -1):
                    joined = mix(joined * _PAIR + unit[done - j])
                digest[some[done]] = joined
            self.eligible[some[done]] = True
        self.one, self.two = one.view(np.int64), two.view(np.int64)

    def repeated_inside(self) -> np.ndarray:
        """Units whose digest stands earlier in the same text."""
        out = np.zeros(len(self.one), dtype=bool)
        some = np.flatnonzero(self.eligible)
        out[some] = pd.DataFrame({"o": self.owner[some], "a": self.one[some], "b": self.two[some]}).duplicated().to_numpy()
        return out


def _document() -> tuple[Column, Column]:
    """Rank and version of a row's document: versions tell null ids apart."""
    null = F.col("doc_id").isNull()
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return rank, F.when(null, F.xxhash64(F.col("text").cast("string"))).otherwise(F.lit(0).cast("long"))


def _free(name: str, taken: list[str]) -> str:
    """``name``, with more underscores if a column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name = "_" + name
    return name


def unit_digests(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(rank, ver, one, two): the digests of each document, each once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, ver = batch.column(0), batch.column(1)
            for block in blocks(batch.column(2), lower=True):
                units = Units(block, min_words)
                some = np.flatnonzero(units.eligible & ~units.repeated_inside())
                at = pa.array(units.owner[some] + block.first)
                yield pa.RecordBatch.from_arrays(
                    [rank.take(at), ver.take(at), pa.array(units.one[some]), pa.array(units.two[some])], ["rank", "ver", "one", "two"]
                )

    rank, ver = _document()
    narrow = docs.select(rank.alias("rank"), ver.alias("ver"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "rank long, ver long, one long, two long")


def dedup_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``, and the columns ``ADDED``:
    the number of units, of removed ones, and their spans as ``start-end,...``."""
    docs = docs.drop(*ADDED)
    digests = unit_digests(docs, min_words)
    # versions count only among null ids, which come last: a minimum of each is enough
    shared = (
        digests.groupBy("one", "two").agg(F.min("rank").alias("kept"), F.min("ver").alias("kept_ver"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n")
    )
    rank, ver, listed_in = (_free(c, docs.columns) for c in ("_rank", "_ver", "_removed"))
    removed = (
        digests.join(shared, ["one", "two"]).where(F.expr(f"rank > kept or (kept = {LAST} and ver > kept_ver)"))
        .groupBy("rank", "ver").agg(F.collect_set("one").alias(listed_in))  # at most the units of one document
        .withColumnsRenamed({"rank": rank, "ver": ver})
    )
    marked = docs.withColumns(dict(zip((rank, ver), _document()))).join(removed, [rank, ver], "left").drop(rank, ver)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, listed = batch.column("text"), batch.column(listed_in)
            kept = text.to_pylist()
            counts, gone, spans = np.zeros(len(kept), dtype=np.int64), np.zeros(len(kept), dtype=np.int64), [""] * len(kept)
            sizes = np.array([0 if x is None else x for x in pc.list_value_length(listed).to_pylist()], dtype=np.int64)
            ends, flat = np.cumsum(sizes), listed.flatten().to_numpy(zero_copy_only=False)
            for block in blocks(text, lower=True):
                units = Units(block, min_words)
                lo, hi = block.first, block.first + block.count
                counts[lo:hi] = np.bincount(units.owner, minlength=block.count)
                wanted = flat[ends[lo] - sizes[lo]:ends[hi - 1]]
                wanted_owner = np.repeat(np.arange(block.count), sizes[lo:hi])
                tag = lambda owner, digest: mix(digest.view(np.uint64) + mix(owner.astype(np.uint64)))
                out = units.eligible & (np.isin(tag(units.owner, units.one), tag(wanted_owner, wanted)) | units.repeated_inside())
                for i in np.unique(units.owner[out]).tolist():
                    base, mine = int(block.offsets[i]), units.owner == i if block.count == 1 else slice(*np.searchsorted(units.owner, [i, i + 1]))
                    s, e, o = units.starts[mine] - base, units.ends[mine] - base, out[mine]
                    whole = kept[lo + i]
                    kept[lo + i] = "".join([whole[a:b] for a, b in zip(s[~o].tolist(), e[~o].tolist())])
                    spans[lo + i] = ",".join([f"{a}-{b}" for a, b in zip(s[o].tolist(), e[o].tolist())])
                    gone[lo + i] = int(o.sum())
            new = {"text": pa.array(kept, pa.string()), "n_units": pa.array(counts), "n_removed_units": pa.array(gone), "removed_spans": pa.array(spans)}
            names = [c for c in batch.schema.names if c != listed_in]
            yield pa.RecordBatch.from_arrays([new.pop(c, None) if c == "text" else batch.column(c) for c in names] + list(new.values()), [*names, *new])

    schema = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema)
    return marked.mapInArrow(cut, schema + ", n_units long, n_removed_units long, removed_spans string")
