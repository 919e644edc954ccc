"""Phrase collocations by best-first branch and bound (operator 11).

Words are what stands between blanks and tabs inside pieces of a text (cut at
``. , ; : ! ?`` and line breaks), A-Z in lower case. A phrase of two or three words
that occurs ``a`` >= ``LEAST`` times in its language scores ``floor(SCALE * a * a /
(l * r))`` at its worst cut into a first part (``l`` times) and a rest (``r`` times).
A two-word phrase inside a three-word one that occurs half as often or more is dropped.

Growth. Words are counted first, then pairs of words that both occur often enough,
and pairs are scored. Of a pair ``xy`` the counts bound every phrase that grows from
it: ``xyz`` scores at most ``SCALE * f(xy) / f(x)`` (the cut after ``x``, as
``f(yz) >= a``), and, seen from its end, at most ``SCALE * f(yz) / f(z)``. The frontier
is a score per language: at first that of its ``FRONTIER``-th best pair. Three-word
phrases are counted only where both bounds reach the frontier, or where a pair that
reaches it could be dropped; every candidate that scores above is then known exactly.
If fewer than ``TOP`` survive, the frontier is lowered to a later pair, down to the
last, and only languages that are not settled are grown again.

Exactness. Words are 64-bit digests of (language, word), with their texts in the word
table; if two words of a language should ever share a digest, all is done again with
another seed. Counts are longs, products decimals of 38 digits (``exact_score``). Which
pairs are often enough is sent to the scans as a bit table of fixed size: a false
positive only counts a phrase in vain.

Scale. Every pass counts a task's phrases before they are shuffled, so that a word pair
that holds a third of all rows is one row a task. The 2000 best of a language are
chosen in every task before one task of the language orders them. The frontier's
bit tables have ``BITS`` bits whatever the input; no phrases reach the driver.

Cases: a null text is empty, a null language is ``und`` (as is a language of that
name); repeated rows count each time; ties in score and count go by the phrase's bytes; an
empty table or one without candidates gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.llm.textarrays import Block, blocks, mix, span_hashes
from quillstream.session import default_partitions

LEAST = 10             # occurrences of a candidate
TOP = 2000             # phrases a language
SCALE = 1_000_000
FRONTIER = 4000        # the first frontier is the score of a language's pair of this rank
WIDER = 8              # times more pairs in the next frontier
BITS = 26              # log2 of the size of a bit table
HELD_WORDS = 1 << 20   # words a task counts phrases of at a time
ROWS = 1 << 16         # handed to Spark at a time
TEXTS, CHARS = 1 << 10, 1 << 18  # texts and characters cut into words at a time
ROTATE = 23            # bits, of the second word's digest in a pair's

BREAKS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
OUT = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


# --- words --------------------------------------------------------------------------

@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """0: part of a word, 1: blank, 2: break."""
    kind = np.zeros(0x110000, dtype=np.uint8)
    kind[[ord(c) for c in BLANKS]] = 1
    kind[[ord(c) for c in BREAKS]] = 2
    return kind


def lang_seed(lang: str, seed: int) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(f"{seed}:{lang}".encode(), digest_size=8).digest(), "<u8")[0]


@dataclass
class Words:
    """The words of a block, in order, and whether each follows the one before in its piece."""

    codes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    digest: np.ndarray
    joined: np.ndarray


def words_of(block: Block, seed: np.uint64) -> Words:
    codes = np.where((block.codes >= 65) & (block.codes <= 90), block.codes + 32, block.codes).astype(np.uint32)
    kind = _kinds()[codes]
    inside = np.zeros(len(codes) + 2, dtype=bool)
    inside[1:-1] = kind == 0
    new = np.zeros(len(codes) + 1, dtype=bool)
    new[block.offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | new[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | new[1:])) + 1
    cuts = np.concatenate([[0], np.cumsum(kind == 2)])
    text = np.searchsorted(block.offsets, start, side="right")
    joined = np.zeros(len(start), dtype=bool)
    joined[1:] = (cuts[start[1:]] == cuts[end[:-1]]) & (text[1:] == text[:-1])
    return Words(codes, start, end, mix(span_hashes(codes, start, end) ^ seed), joined)


def _by_language(batch: pa.RecordBatch, seed: int) -> Iterator[tuple[str, Words]]:
    for i in range(0, batch.num_rows, TEXTS):
        texts, langs = batch.column(0).slice(i, TEXTS), batch.column(1).slice(i, TEXTS).dictionary_encode()
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for j, lang in enumerate(langs.dictionary.to_pylist()):
            for block in blocks(texts.take(pa.array(np.flatnonzero(codes == j))), limit=CHARS):
                yield lang, words_of(block, lang_seed(lang, seed))


def _same(lang: str, n: int) -> pa.Array:
    return pa.repeat(pa.scalar(lang, pa.string()), n)


def _long(digests: np.ndarray) -> pa.Array:
    return pa.array(digests.view(np.int64))


def _runs(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(places, counts) of the distinct rows of the columns (rows of which the
    mixed digests collide may be listed twice, with their counts split)."""
    mixed = columns[0]
    for c in columns[1:]:
        mixed = mix(mixed * np.uint64(0x9E3779B97F4A7C15) + c)
    order = np.argsort(mixed)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for c in columns:
        kept = c[order]
        new[1:] |= kept[1:] != kept[:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def count_words(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, text, n) of the words of ``texts(text, lang)``: one row a digest, but for collisions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def counted() -> Iterator[pa.RecordBatch]:
            if held:
                table = pa.Table.from_batches(held).group_by(["lang", "word", "text"]).aggregate([("n", "sum")])
                yield from table.select(["lang", "word", "text", "n_sum"]).rename_columns(["lang", "word", "text", "n"]).to_batches(max_chunksize=ROWS)

        for batch in batches:
            for lang, words in _by_language(batch, seed):
                at, counts = _runs([words.digest])
                text = words.codes.tobytes().decode("utf-32-le")
                found = [text[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())]
                held.append(pa.RecordBatch.from_arrays([_same(lang, len(at)), _long(words.digest[at]), pa.array(found, pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "text", "n"]))
                if sum(b.num_rows for b in held) >= HELD_WORDS >> 2:
                    yield from counted()
                    held.clear()
        yield from counted()

    # tasks have counted already: rows go to their place, and are added up there
    found = texts.mapInArrow(run, "lang string, word long, text string, n long")
    return found.repartition("lang", "word").groupBy("lang", "word", "text").agg(F.sum("n").alias("n"))


# --- bit tables -----------------------------------------------------------------------

def pair_digest(x: Column, y: Column) -> Column:
    return x.bitwiseXOR(F.shiftleft(y, ROTATE).bitwiseOR(F.shiftrightunsigned(y, 64 - ROTATE)))


def _pair_digest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return x ^ ((y << np.uint64(ROTATE)) | (y >> np.uint64(64 - ROTATE)))


def bit_table(digests: DataFrame) -> np.ndarray:
    """Bits of the digests' upper ``BITS`` bits (column ``d``): 2 ** ``BITS`` / 8 bytes, however many there are."""
    slot = F.shiftrightunsigned("d", 64 - BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(31)).cast("int"))
    bits = digests.select(F.shiftrightunsigned(slot, 5).alias("at"), bit.alias("bit"))
    table = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2 ** (BITS - 5) rows
    out = np.zeros(1 << (BITS - 5), dtype=np.uint32)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy().astype(np.uint32)
    return out


def marked(table: np.ndarray, digests: np.ndarray) -> np.ndarray:
    slot = (digests >> np.uint64(64 - BITS)).astype(np.int64)
    return (table[slot >> 5] >> (slot & 31).astype(np.uint32)) & np.uint32(1) != 0


# --- phrases ----------------------------------------------------------------------------

def _count_phrases(texts: DataFrame, seed: int, size: int, chosen) -> DataFrame:
    """(lang, x, y[, z], n) of the phrases of ``size`` words that ``chosen(digests, joined)`` marks by their first word's place."""
    names = ["x", "y", "z"][:size]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        n_held = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                columns = [np.concatenate(c) for c in zip(*parts)]
                if len(columns[0]):
                    at, counts = _runs(columns)
                    for i in range(0, len(at), ROWS):
                        some = at[i:i + ROWS]
                        yield pa.RecordBatch.from_arrays([_same(lang, len(some)), *[_long(c[some]) for c in columns], pa.array(counts[i:i + ROWS], pa.int64())], ["lang", *names, "n"])

        for batch in batches:
            for lang, words in _by_language(batch, seed):
                at = chosen(words.digest, words.joined)
                held.setdefault(lang, []).append([words.digest[at + i] for i in range(size)])
                n_held += len(at) + 1
                if n_held >= HELD_WORDS:
                    yield from counted()
                    held, n_held = {}, 0
        yield from counted()

    found = texts.mapInArrow(run, f"lang string, {', '.join(f'{c} long' for c in names)}, n long")
    return found.repartition("lang", *names).groupBy("lang", *names).agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def count_pairs(texts: DataFrame, seed: int, often: np.ndarray) -> DataFrame:
    """(lang, x, y, n) of all pairs that occur ``LEAST`` times or more; ``often`` marks such words."""

    def chosen(digest: np.ndarray, joined: np.ndarray) -> np.ndarray:
        some = marked(often, digest)
        return np.flatnonzero(joined[1:] & some[1:] & some[:-1])

    return _count_phrases(texts, seed, 2, chosen)


def count_triples(texts: DataFrame, seed: int, begins: np.ndarray, ends: np.ndarray, tops: np.ndarray, often: np.ndarray) -> DataFrame:
    """(lang, x, y, z, n) of the three-word phrases whose first pair ``begins`` and whose second ``ends``
    a phrase at the frontier, or of which a pair reaches it (``tops``) and the other is ``often`` enough."""

    def chosen(digest: np.ndarray, joined: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(joined[1:-1] & joined[2:]) if len(digest) > 2 else np.zeros(0, dtype=np.int64)
        first, second = _pair_digest(digest[at], digest[at + 1]), _pair_digest(digest[at + 1], digest[at + 2])
        f, s = (marked(often, d) for d in (first, second))
        keep = f & s & ((marked(begins, first) & marked(ends, second)) | marked(tops, first) | marked(tops, second))
        return at[keep]

    return _count_phrases(texts, seed, 3, chosen)


def exact_score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)): decimals of 38 digits hold the products of counts below 10^16."""
    wide = lambda c: c.cast("decimal(16,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * wide(a) * wide(a), wide(left) * wide(right)).cast("long")


def with_scores(pairs: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, x, y, a, l, r, score, begin, end) of pairs: ``begin`` bounds the score of
    what begins with the pair, ``end`` of what ends with it."""
    first = frequent.select("lang", F.col("word").alias("x"), F.col("n").alias("l"))
    second = frequent.select("lang", F.col("word").alias("y"), F.col("n").alias("r"))
    counted = pairs.withColumnRenamed("n", "a").join(first, ["lang", "x"]).join(second, ["lang", "y"])
    # SCALE * a * a / (l * a) = SCALE * a / l
    return counted.select(
        "lang", "x", "y", "a", "l", "r", exact_score(F.col("a"), F.col("l"), F.col("r")).alias("score"),
        exact_score(F.col("a"), F.col("l"), F.col("a")).alias("begin"), exact_score(F.col("a"), F.col("r"), F.col("a")).alias("end"),
    )


def frontiers(pairs: DataFrame, rank: int) -> DataFrame:
    """(lang, floor): the score of each language's ``rank``-th best pair, 0 if it has fewer.
    From the histogram of scores, at most SCALE + 1 rows a language."""
    histogram = pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    reached = histogram.select("lang", F.when(so_far >= rank, F.col("score")).otherwise(0).alias("at"))
    return reached.groupBy("lang").agg(F.max("at").cast("long").alias("floor"))


def surviving(pairs: DataFrame, triples: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, x, y, z, a, l, r, score, floor) of the phrases that score at least ``floor``
    (a column of ``pairs``), without the pairs that a triple covers."""
    sub = pairs.select("lang", "x", "y", "a", "floor")
    front = triples.withColumnRenamed("n", "a").join(sub.withColumnRenamed("a", "xy"), ["lang", "x", "y"])
    front = front.join(sub.select("lang", F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("yz")), ["lang", "y", "z"])
    front = front.join(frequent.select("lang", F.col("word").alias("x"), F.col("n").alias("fx")), ["lang", "x"])
    front = front.join(frequent.select("lang", F.col("word").alias("z"), F.col("n").alias("fz")), ["lang", "z"])
    one, two = exact_score(F.col("a"), F.col("fx"), F.col("yz")), exact_score(F.col("a"), F.col("xy"), F.col("fz"))
    cut = F.when(one <= two, F.struct(one.alias("score"), F.col("fx").alias("l"), F.col("yz").alias("r"))).otherwise(
        F.struct(two.alias("score"), F.col("xy").alias("l"), F.col("fz").alias("r"))
    )
    grown = front.withColumn("cut", cut).select("lang", "x", "y", "z", "a", "cut.l", "cut.r", "cut.score", "floor").where("score >= floor")
    covers = triples.select("lang", "x", "y", "n").union(triples.select("lang", F.col("y").alias("x"), F.col("z").alias("y"), "n"))
    covers = covers.groupBy("lang", "x", "y").agg(F.max("n").alias("most"))
    plain = pairs.where("score >= floor").join(covers, ["lang", "x", "y"], "left").where("most is null or 100 * most < 50 * a")
    plain = plain.select("lang", "x", "y", F.lit(None).cast("long").alias("z"), "a", "l", "r", "score", "floor")
    return grown.unionByName(plain)


def best(phrases: DataFrame, frequent: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, with their texts (``OUT``)."""
    for place in ("x", "y", "z"):
        named = frequent.select("lang", F.col("word").alias(place), F.col("text").alias(f"w{place}"))
        phrases = phrases.join(named, ["lang", place], "left" if place == "z" else "inner")
    named = phrases.select("lang", F.concat_ws(" ", "wx", "wy", "wz").alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of every part of a language, then the best of those
    part = F.pmod(F.xxhash64("phrase"), F.lit(default_partitions(phrases.sparkSession)))
    some = named.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return first.join(totals, "lang").select(*OUT)


def collocations(docs: DataFrame, top: int = TOP, frontier: int = FRONTIER) -> DataFrame:
    """The ``top`` best phrases of each language of ``docs(text, lang)`` (columns ``OUT``)."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    seed = 0
    while True:
        words = count_words(texts, seed).checkpoint()
        if not words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").limit(1).count():
            break
        seed += 1
    totals = words.groupBy("lang").agg(F.sum("n").alias("n")).checkpoint()  # one row a language
    frequent = words.where(F.col("n") >= LEAST)
    pairs = count_pairs(texts, seed, bit_table(frequent.select(F.col("word").alias("d"))))
    pairs = with_scores(pairs, frequent).checkpoint()
    done = None
    open_pairs, rank = pairs, frontier
    while True:
        at = open_pairs.join(F.broadcast(frontiers(open_pairs, rank)), "lang").checkpoint()  # one row a language
        table = lambda rows: bit_table(rows.select(pair_digest(F.col("x"), F.col("y")).alias("d")))
        langs = F.broadcast(at.select("lang").distinct())
        triples = count_triples(
            texts.join(langs, "lang", "left_semi").select("text", "lang"), seed,
            table(at.where("begin >= floor")), table(at.where("end >= floor")), table(at.where("score >= floor")), table(at),
        ).checkpoint()
        found = surviving(at, triples, frequent).checkpoint()
        floors = at.groupBy("lang").agg(F.first("floor").alias("floor"))
        settled = floors.join(found.groupBy("lang").agg(F.count(F.lit(1)).alias("found")), "lang", "left")
        settled = settled.withColumn("settled", (F.col("floor") == 0) | (F.coalesce("found", F.lit(0)) >= top)).select("lang", "settled").checkpoint()
        part = found.join(F.broadcast(settled.where("settled")), "lang").drop("settled", "floor")
        done = part if done is None else done.unionByName(part)
        if not settled.where("not settled").limit(1).count():
            return best(done, frequent, totals, top)
        open_pairs = open_pairs.join(F.broadcast(settled.where("not settled").select("lang")), "lang", "left_semi")
        rank *= WIDER
