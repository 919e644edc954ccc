"""Near duplicates by BagMinHash signatures (operator 7).

A text is the multiset of its ``SHINGLE``-word shingles (lower-case words; a
shorter text is one shingle). Weighted Jaccard of two texts is the sum of the
smaller counts over the sum of the larger ones.

Signatures. Every shingle has a Poisson process over (time, height); a text sees
the points up to the height of its count, and each point falls to one of ``m``
components. A component's signature is the first point it gets, so two texts
agree in a component with probability equal to their weighted Jaccard. Heights
are discretised to whole counts and split into dyadic intervals (0, 1], (1, 2],
(2, 4], ..., each a process of its own with the interval's width as rate: a count
``c`` costs about log2(c) processes, not ``c``. Points are drawn in order of time
and only up to a horizon that some ``m (ln m + 4)`` points of the whole text
reach; the few texts with a component still empty go on with a longer horizon.
The horizon does not change the result.

Search. Equal texts are one representative. Signatures are banded
(``BANDS`` x ``ROWS``); representatives that agree in a band share a bucket.
The exact weighted Jaccard of a candidate pair is computed from the texts. All
representatives of different classes that share a bucket are compared; links join
classes, so a large group of near copies is one class after a few texts of it have
been compared with the rest. In a bucket of up to ``SMALL`` members all pairs are
joined with their texts. A larger one is cut into blocks of about ``MEMBERS`` members
or ``CHARS`` characters. A task searches a block (``within_blocks``): members of all
classes but the largest are hubs, one after the other, and a hub is compared with the
members of other classes by adding up shingles; it yields one row for each class that
the hub joins. Two hubs of the bucket are in all of its blocks. Then classes are
joined, and only buckets of several blocks that still hold several classes go on, block
against block (``across_blocks``), without pairs of the largest class. The first
``FIRST_BANDS`` bands go before the others. A class is a connected component of links; its id is
the smallest ``doc_id`` in it.

Scale: bucket counts are aggregates; a bucket with a third of all rows is dealt out in
blocks. Links are at most a row a member and block, and a family that is one class
leaves after its blocks. Texts of one bucket that all are below the threshold cost a
comparison a pair, about a microsecond each, and no row a pair. Links are written to
the shared checkpoint folder.

Cases: null and empty texts, and texts without words, are near duplicates of
equal texts only; equal rows are copies; a null ``doc_id`` is kept and ranks last
as a class id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.textarrays import Block, as_strings, blocks, group_starts, mix, span_hashes, word_spans

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5   # a pair at 0.8 shares no band with probability 7e-5
COMPONENTS = BANDS * ROWS
LAST = (1 << 63) - 1
SMALL = 8             # members of a bucket whose pairs are all compared
MEMBERS, CHARS = 2048, 1 << 22  # size of a block of a larger bucket
FIRST_BANDS = 2       # bands whose larger buckets are searched before the others

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = np.uint64(0xD1B54A32D192ED03)


# --- multisets and signatures -----------------------------------------------------

def shingles(block: Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count) of the multiset of every text of a lower-cased block, sorted."""
    start, end, owner = word_spans(block)
    words = span_hashes(block.codes, start, end)
    first = group_starts(owner, block.count)
    n_words = np.diff(first)
    n = np.where(n_words >= size, n_words - size + 1, (n_words > 0).astype(np.int64))
    of = np.repeat(np.arange(block.count), n)
    at = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    hashes = span_hashes(words, at, np.minimum(at + size, first[of + 1])) if len(of) else np.zeros(0, dtype=np.uint64)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    places = np.flatnonzero(new)
    return of[places], hashes[places], np.diff(np.append(places, len(of)))


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1) from the upper 53 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash signatures (n, m) as 64-bit values; a text without shingles has zeros."""
    total = np.bincount(owner, weights=counts, minlength=n)
    out = np.zeros((n, m), dtype=np.uint64)
    todo = np.flatnonzero(total > 0)
    spread = 4.0
    while len(todo):
        place = np.full(n, -1)
        place[todo] = np.arange(len(todo))
        mine = place[owner] >= 0
        horizon = m * (np.log(m) + spread) / total[todo]
        done, values = _draw(place[owner[mine]], hashes[mine], counts[mine], horizon, m)
        out[todo[done]] = values[done]
        todo = todo[~done]
        spread *= 4
    return out


def _draw(owner, hashes, counts, horizon, m):
    """First point of each component up to each text's horizon; which texts have all."""
    n = len(horizon)
    first = np.full(n * m, np.inf)
    levels = int(counts.max() - 1).bit_length() if len(counts) else 0
    for level in range(levels + 1):
        low, width = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
        some = np.flatnonzero(counts > low)
        state = mix(hashes[some] + np.uint64(int(_LEVEL) * (level + 1) % (1 << 64)))
        who, height, time = owner[some], counts[some], np.zeros(len(some))
        until = horizon[who]
        while len(state):
            state = state + _STEP
            draw = mix(state)
            # most shingles have no point before the horizon: compare before the logarithm
            live = np.flatnonzero(_uniform(draw) > np.exp(-(until - time) * width))
            state, who, height, until, draw = state[live], who[live], height[live], until[live], draw[live]
            time = time[live] - np.log(_uniform(draw)) / width
            where = mix(draw ^ _LEVEL)
            seen = low + 1 + ((where >> np.uint64(32)) % np.uint64(width)).astype(np.int64) <= height
            slot = who[seen] * m + ((where[seen] & np.uint64(0xFFFFFFFF)) % np.uint64(m)).astype(np.int64)
            np.minimum.at(first, slot, time[seen])
    first = first.reshape(n, m)
    done = np.isfinite(first).all(axis=1)
    # the times themselves identify the points; single precision keeps them equal across machines
    return done, mix(first.astype(np.float32).view(np.uint32).astype(np.uint64) + _STEP)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(n, BANDS) keys of the signatures' bands."""
    n = len(signatures)
    parts = signatures.reshape(n, BANDS, ROWS)
    key = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], n, axis=0)
    for r in range(ROWS):
        key = mix(key * _STEP + parts[:, :, r])
    return key.view(np.int64)


def _bands(texts: DataFrame) -> DataFrame:
    """(key, id, bands) of (key, id, text); ``bands`` is null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2), lower=True):
                owner, hashes, counts = shingles(block)
                keys = band_keys(bag_signatures(owner, hashes, counts, block.count))
                none = np.bincount(owner, minlength=block.count) == 0
                rows = slice(block.first, block.first + block.count)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(block.count + 1) * BANDS, pa.int32()), pa.array(keys.ravel()), mask=pa.array(none))
                yield pa.RecordBatch.from_arrays([batch.column(0)[rows], batch.column(1)[rows], lists], ["key", "id", "bands"])

    return texts.mapInArrow(run, "key binary, id long, bands array<long>")


# --- verification -----------------------------------------------------------------

def pair_overlap(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard of the texts of each row."""
    out = np.zeros(len(left))
    both = pa.chunked_array([as_strings(left).cast(pa.large_string()), as_strings(right).cast(pa.large_string())]).combine_chunks()
    # left and right of a row side by side, so that both fall into one block
    n = len(left)
    order = np.arange(2 * n).reshape(2, n).T.ravel()
    held = None
    for block in blocks(both.take(pa.array(order)), lower=True):
        owner, hashes, counts = shingles(block)
        ends = np.searchsorted(owner, np.arange(block.count + 1))
        for i in range(block.count):
            bag = hashes[ends[i]:ends[i + 1]], counts[ends[i]:ends[i + 1]]
            row, side = divmod(block.first + i, 2)
            if side == 0:
                held = bag
                continue
            _, a, b = np.intersect1d(held[0], bag[0], assume_unique=True, return_indices=True)
            common = np.minimum(held[1][a], bag[1][b]).sum()
            out[row] = common / max(1, held[1].sum() + bag[1].sum() - common)
    return out


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b, linked) of the pairs (a, b), compared by their texts (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = pair_overlap(batch.column(2), batch.column(3)) >= threshold
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked)], ["a", "b", "linked"])

    left = texts.select(F.col("key").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("right"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return rows.mapInArrow(run, "a binary, b binary, linked boolean")


def block_links(texts: pa.Array, classes: np.ndarray, upper: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(hub, other): links that join the texts (all with words) as all links do.

    ``classes`` numbers the known classes. Compared are texts of different classes; if
    ``upper`` has both values, only one that has it with one that has not. A text of
    the largest class need not be a hub: those of the others are.
    """
    parts = [(owner + block.first, hashes, counts) for block in blocks(texts, lower=True) for owner, hashes, counts in [shingles(block)]]
    owner, hashes, counts = (np.concatenate(x) for x in zip(*parts))
    names, ids = np.unique(hashes, return_inverse=True)
    n = len(texts)
    first = group_starts(owner, n)
    total = np.bincount(owner, weights=counts, minlength=n).astype(np.int64)
    bag, label, done = np.zeros(len(names), dtype=np.int64), classes.copy(), np.zeros(n, dtype=bool)
    two = upper.any() and not upper.all()
    hubs, found = [], []
    while True:
        asked = ~done & (label != np.bincount(label).argmax())
        if two:  # of the side that has fewer to ask
            sides = [x for x in (np.flatnonzero(asked & upper), np.flatnonzero(asked & ~upper)) if len(x)]
        else:
            sides = [np.flatnonzero(asked)]
        if not sides or not len(sides[0]):
            break
        hub = min(sides, key=len)[0]
        done[hub] = True
        others = ~done & (label != label[hub])
        if two:
            others &= upper != upper[hub]
        others = np.flatnonzero(others & (np.minimum(total, total[hub]) / np.maximum(total, total[hub]) >= threshold))
        if not len(others):
            continue
        mine = slice(first[hub], first[hub + 1])
        bag[ids[mine]] = counts[mine]
        size = first[others + 1] - first[others]
        ends = np.cumsum(size)
        if 2 * ends[-1] > len(ids):
            common = np.add.reduceat(np.minimum(bag[ids], counts), first[:-1])[others]
        else:
            at = np.repeat(first[others] - ends + size, size) + np.arange(ends[-1])
            common = np.add.reduceat(np.minimum(bag[ids[at]], counts[at]), ends - size)
        bag[ids[mine]] = 0
        linked = others[common / (total[hub] + total[others] - common) >= threshold]
        if len(linked):
            linked = linked[np.unique(label[linked], return_index=True)[1]]  # one of each class
            label[np.isin(label, label[linked])] = label[hub]
            hubs.append(np.full(len(linked), hub))
            found.append(linked)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *hubs]), np.concatenate([none, *found])


def _searched(dealt: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links found among the rows (key, class, text, upper) of each (band, side, lo, hi), each group in a task."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("key")
        keys = table.column("key").combine_chunks()
        first = np.ones(len(keys), dtype=bool)  # a hub may be in its own block
        first[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        table, keys = table.filter(pa.array(first)), keys.filter(pa.array(first))
        classes = np.unique(np.array(table.column("class").to_pylist(), dtype=object), return_inverse=True)[1]
        upper = table.column("upper").to_numpy()
        hub, other = block_links(table.column("text").combine_chunks(), classes, upper, threshold)
        swap = hub > other  # sorted by key
        a, b = np.where(swap, other, hub), np.where(swap, hub, other)
        return pa.table({"a": keys.take(pa.array(a)), "b": keys.take(pa.array(b))})

    return dealt.groupBy("band", "side", "lo", "hi").applyInArrow(run, "a binary, b binary")


def _in_blocks(n: Column, chars: Column) -> Column:
    return F.greatest(F.ceil(n / MEMBERS), F.ceil(chars / CHARS)).cast("int")


def _upto(n: Column) -> Column:
    """0 .. n - 1 (none for 0)."""
    return F.filter(F.sequence(F.lit(0), n), lambda x: x < n)


def within_blocks(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links inside each block of the buckets' rows (band, key, class, text), and to two
    hubs of the bucket, which go to all of its blocks: a family of copies is one class
    after this, however many blocks it has."""
    sizes = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.min("key").alias("h1"), F.max("key").alias("h2"))
    sizes = sizes.select("band", _in_blocks(F.col("n"), F.col("chars")).alias("blocks"), "h1", "h2")
    at = rows.join(sizes, "band")
    mine = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    everywhere = F.col("key").isin(F.col("h1"), F.col("h2"))
    dealt = at.withColumn("lo", F.explode(F.when(everywhere, _upto(F.col("blocks"))).otherwise(F.array(mine))))
    return _searched(dealt.select("band", F.lit("").alias("side"), "lo", F.col("lo").alias("hi"), F.lit(False).alias("upper"), "key", "class", "text"), threshold)


def across_blocks(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links between members of different classes of the buckets that have more than one block.

    Only members outside the bucket's largest class ask: their blocks meet those of the
    largest class and each other, so a bucket with ``m`` of them sends a member about
    ``m / MEMBERS`` times. Each pair of classes that a task joins is one row.
    """
    by_class = rows.groupBy("band", "class").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    sizes = by_class.groupBy("band").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.max(F.struct("n", "class", "chars")).alias("top"))
    sizes = sizes.where(_in_blocks(F.col("n"), F.col("chars")) > 1).where(F.col("n") > F.col("top.n")).select(
        "band", F.col("top.class").alias("top"), _in_blocks(F.col("top.n"), F.col("top.chars")).alias("tops"),
        _in_blocks(F.col("n") - F.col("top.n"), F.col("chars") - F.col("top.chars")).alias("others"),
    )
    at = rows.join(sizes, "band").withColumn("asks", F.col("class") != F.col("top"))
    mine = F.pmod(F.xxhash64("key"), F.when(F.col("asks"), F.col("others")).otherwise(F.col("tops"))).cast("int")
    at = at.withColumn("mine", mine)
    task = lambda side, lo, hi, upper: F.struct(F.lit(side).alias("side"), lo.alias("lo"), hi.alias("hi"), upper.alias("upper"))
    own = F.col("mine")
    asking = F.concat(
        F.transform(_upto(F.col("tops")), lambda x: task("top", own, x, F.lit(True))),
        F.transform(_upto(F.col("others")), lambda x: task("other", F.least(own, x), F.greatest(own, x), own > x)),
    )
    asked = F.transform(_upto(F.col("others")), lambda x: task("top", x, own, F.lit(False)))
    dealt = at.withColumn("task", F.explode(F.when(F.col("asks"), asking).otherwise(asked)))
    return _searched(dealt.select("band", "task.side", "task.lo", "task.hi", "task.upper", "key", "class", "text"), threshold)


# --- classes ------------------------------------------------------------------------

CHUNK = 200_000  # links a task contracts at a time


def contracted(links: DataFrame) -> DataFrame:
    """(a, b): each linked key with the smallest key it reaches through the links of
    its partition, up to ``CHUNK`` of them at a time. The components are the same,
    but long ways between their keys become short."""

    def roots(left: list[bytes], right: list[bytes]) -> pa.RecordBatch:
        parent: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            way = []
            while (up := parent.setdefault(x, x)) != x:
                way.append(x)
                x = up
            for y in way:
                parent[y] = x
            return x

        for x, y in zip(left, right):
            x, y = root(x), root(y)
            parent[max(x, y)] = min(x, y)
        keys = list(parent)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([root(k) for k in keys], pa.binary())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for batch in batches:
            left += batch.column(0).to_pylist()
            right += batch.column(1).to_pylist()
            if len(left) >= CHUNK:
                yield roots(left, right)
                left, right = [], []
        if left:
            yield roots(left, right)

    return links.select("a", "b").repartition("a").mapInArrow(run, "a binary, b binary").where("a != b")


def components(links: DataFrame) -> DataFrame:
    """(key, class): the smallest key of the connected component of each linked key.

    Links are first contracted within partitions. Then every key takes the smallest
    label around it, then the label of its label; written out each round, until no
    label changes.
    """
    links = contracted(links)
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("near")).select("key", F.least("key", "near").alias("class")).checkpoint()
    while True:
        near = both.join(labels.select(F.col("key").alias("b"), F.col("class").alias("around")), "b").groupBy(F.col("a").alias("key")).agg(F.min("around").alias("around"))
        nearer = labels.join(near, "key").select("key", F.least("class", "around").alias("next"), F.col("class").alias("was"))
        jump = labels.select(F.col("key").alias("next"), F.col("class").alias("far"))
        after = nearer.join(jump, "next", "left").select("key", F.least("next", "far").alias("class"), "was").checkpoint()
        changed = after.where(F.col("class") != F.col("was")).limit(1).count()
        labels = after.select("key", "class")
        if not changed:
            return labels


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, class_key, doc_id, class_id) of every row of ``docs(doc_id, text)``:
    ``key`` is the digest of the text, ``class_key`` the smallest of its class."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.unhex(F.md5(text)).alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), text.alias("text"))
    signed = _bands(rows).checkpoint()
    heads = signed.groupBy("key").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    members = heads.select("key", F.posexplode("bands").alias("at", "band"))  # texts without words have none
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = members.join(shared, "band").checkpoint()
    # the texts of representatives in shared buckets, once each
    wanted = heads.select("key", "id").join(members.select("key").distinct(), "key")
    texts = rows.join(wanted, ["key", "id"]).groupBy("key").agg(F.first("text").alias("text")).checkpoint()

    # small buckets: every pair at once; the first bands' larger ones: inside blocks
    few = members.where(F.col("n") <= SMALL)
    asked = _pairs(few.select("band", "key").join(few.select("band", F.col("key").alias("hub")), "band").select("key", "hub"))
    first, others = (members.where(F.col("n") > SMALL).where(c).select("band", "key") for c in (F.col("at") < FIRST_BANDS, F.col("at") >= FIRST_BANDS))
    inside = within_blocks(first.join(texts, "key").withColumn("class", F.col("key")), threshold)
    classes = components(verified(asked, texts, threshold).where("linked").select("a", "b").union(inside))
    # then what still holds several classes: between blocks, and in the other bands
    for search, some in ((across_blocks, first), (within_blocks, others), (across_blocks, others)):
        known = some.join(classes, "key", "left").withColumn("class", F.coalesce("class", "key")).checkpoint()
        mixed = known.groupBy("band").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").select("band")
        links = search(known.join(mixed, "band").join(texts, "key"), threshold).checkpoint()
        if links.limit(1).count():
            classes = components(links.union(classes.select(F.col("key").alias("a"), F.col("class").alias("b"))))
    grouped = heads.select("key", "id").join(classes, "key", "left").withColumn("class", F.coalesce("class", "key"))
    smallest = grouped.groupBy("class").agg(F.min("id").alias("class_id"))
    named = grouped.join(smallest, "class").select("key", F.col("class").alias("class_key"), "class_id")
    null = F.lit(None).cast("long")
    return signed.select("key", "id").join(named, "key").select(
        "key", "class_key", F.when(F.col("id") != LAST, F.col("id")).otherwise(null).alias("doc_id"),
        F.when(F.col("class_id") != LAST, F.col("class_id")).otherwise(null).alias("class_id"),
    )


def _pairs(asked: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of the two columns, a member and a hub."""
    asked = asked.toDF("key", "hub")
    return asked.where("key != hub").select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: the smallest ``doc_id`` (of equal rows, one). Other columns pass through."""
    classes = near_classes(docs, threshold)
    rank = lambda name: F.coalesce(F.col(name).cast("long"), F.lit(LAST))
    kept = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_key").agg(F.min("key").alias("key"), F.min(rank("doc_id")).alias("id")).drop("class_key")
    # by digest and id: copies of one text go to different tasks; equal rows (same id, same text) leave one
    whole = docs.select(
        F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("key"), rank("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    )
    return whole.join(kept, ["key", "id"]).dropDuplicates(["key", "id"]).select("row.*")
