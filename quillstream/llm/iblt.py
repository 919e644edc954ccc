"""Document fingerprints as invertible Bloom lookup sketches (operator 2).

A text's paragraphs (lines, cut at sentence ends) are hashed to a set of 64-bit
digests. A sketch is three tables of cells; a digest goes to one cell of each, and
a cell holds the number of its digests and the XOR of the digests and of their
checks. Two sketches of one size subtract cell by cell: what the versions share
cancels. A cell left with one digest gives it away; taking it out of its other
cells frees further ones (peeling), until all differing digests are known.

``fingerprint`` is the sketch of ``CELLS`` cells, written out; it holds some half a
dozen differences. Sizes are powers of two a table and a smaller sketch is a larger one
folded, so ``version_cells`` makes, in one aggregation over the exploded digests, the
sketches of both versions at a size that holds all their digests at ``SPARE`` cells each
and the written ones; empty cells are no rows. ``differing`` subtracts the versions'
cells and peels table by table: a digest has one cell in each table, so the digests that
one table gives away are distinct, and are taken out of the other two.

A pair that does not peel is taken again with larger sketches and other hashes
(``differences``): the digests of both versions are dealt by hash into as many sketches as
leave about ``LOAD`` in each; each first has one cell, then more (``LADDER``). Summing
signed digests gives the cells that subtracting would give. What fails on every rung is
settled by comparing its digests. The work is linear in the paragraphs.

Likeness of two texts is the Jaccard index of their digest sets, from the sizes and
the number of recovered differences. DataFrame functions only; after the texts are
shuffled by document, sketches are built and peeled where the documents are.

Cases: a null text is empty; two texts without paragraphs have likeness 1; rows with
the same id and text are one document in the order of documents and get the same
result; of different texts with one id the larger hash comes first; a null ``doc_id``
comes last; a single document is its own next one; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.session import default_partitions

CELLS = 12                  # of a fingerprint, in three tables
SPARE = 2                   # cells a table for a digest of either version
LEAST_BITS = 4              # of a cell's number in a table
STEPS = 6                   # tables peeled, in turn
LOAD = 0.5                  # digests of both texts in a larger sketch, on average
LOAD_OF_VERSIONS = 4        # the same for versions of one text, which share most of them
LADDER = (36, 324)          # cells of a larger sketch after its single one
ROUNDS = (6, 8, 12)         # peeling rounds at most: of a fingerprint, then by rung
FIRST = -(1 << 63)          # rank of a null doc_id: below all others

_PARAGRAPH_END = r"\s*\n\s*|(?<=[.!?])\s+"
_LONG = lambda: F.lit(0).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def paragraph_digests(text: Column) -> Column:
    """Set of the hashes of the text's paragraphs."""
    parts = F.filter(F.split(F.trim(text), _PARAGRAPH_END), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def _cells_of(digest: Column, cells: int, seed: int) -> Column:
    """The three cells of a digest, one in each third: from other bits of it for
    each third and seed (a digest is a hash already)."""
    third = cells // 3
    bits = lambda j: F.shiftrightunsigned(digest, 20 * j + 4 * seed)
    return F.array(*[(F.pmod(bits(j), F.lit(third)) + j * third).cast("int") for j in range(3)])


def _none() -> Column:
    return F.expr("cast(array() as array<struct<x:bigint,s:int>>)")


def _add(cell: Column, e: Column) -> Column:
    return F.struct((cell["n"] + e["s"]).alias("n"), cell["k"].bitwiseXOR(e["x"]).alias("k"), cell["h"].bitwiseXOR(e["h"]).alias("h"))


def one_cell(signed: Column) -> Column:
    """The single cell of a group's digests."""
    empty = F.struct(F.lit(0).alias("n"), _LONG().alias("k"), _LONG().alias("h"))
    return F.aggregate(signed, empty, lambda c, e: _add(c, F.struct(e["x"].alias("x"), e["s"].alias("s"), _check(e["x"]).alias("h"))))


def sketch(signed: Column, cells: int, seed: int) -> Column:
    """Cells (n, k, h) of an array of (digest ``x``, sign ``s``)."""

    def build(items: Column) -> Column:
        def cell(c: Column) -> Column:
            empty = F.struct(F.lit(0).alias("n"), _LONG().alias("k"), _LONG().alias("h"))
            return F.aggregate(F.filter(items, lambda e: F.array_contains(e["p"], c)), empty, _add)

        return F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), cell)

    items = F.transform(signed, lambda e: F.struct(e["x"].alias("x"), e["s"].alias("s"), _check(e["x"]).alias("h"), _cells_of(e["x"], cells, seed).alias("p")))
    return _let(items, build)


def subtract(a: Column, b: Column) -> Column:
    """Difference of two sketches of the same size and seed."""
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["h"].bitwiseXOR(y["h"]).alias("h")))


def peel(cells: Column, size: int, seed: int) -> Column:
    """Digests (x, s) left in a subtracted sketch; null if it does not peel."""

    def pure(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (c["h"] == _check(c["k"]))

    def step(state: Column, _: Column) -> Column:
        single = F.array_distinct(F.transform(F.filter(state["cells"], pure), lambda c: F.struct(c["k"].alias("x"), c["n"].alias("s"))))
        found = F.transform(single, lambda e: F.struct(e["x"].alias("x"), e["s"].alias("s"), _check(e["x"]).alias("h"), _cells_of(e["x"], size, seed).alias("p")))

        def take(found: Column) -> Column:
            def without(cell: Column, at: Column) -> Column:
                return F.aggregate(
                    F.filter(found, lambda e: F.array_contains(e["p"], at)), cell,
                    lambda a, e: F.struct((a["n"] - e["s"]).alias("n"), a["k"].bitwiseXOR(e["x"]).alias("k"), a["h"].bitwiseXOR(e["h"]).alias("h")),
                )

            after = F.struct(
                F.transform(state["cells"], without).alias("cells"),
                F.concat(state["out"], F.transform(found, lambda e: F.struct(e["x"].alias("x"), e["s"].alias("s")))).alias("out"),
            )
            return F.when(F.size(found) == 0, state).otherwise(after)

        return _let(found, take)

    start = F.struct(cells.alias("cells"), _none().alias("out"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS[seed])), start, step)
    empty = lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["h"] == 0)
    return _let(done, lambda d: F.when(F.forall(d["cells"], empty), d["out"]))


def _signed(digests: Column, sign: int) -> Column:
    return F.transform(digests, lambda x: F.struct(x.alias("x"), F.lit(sign).alias("s")))


def base_sketch(digests: Column) -> Column:
    """The sketch a fingerprint writes out."""
    return sketch(_signed(digests, 1), CELLS, 0)


def _apart(signed: Column) -> Column:
    """The exact way out: digests of one sign that the other sign does not have."""
    of = lambda sign: F.transform(F.filter(signed, lambda e: e["s"] == sign), lambda e: e["x"])
    return F.concat(_signed(F.array_except(of(1), of(-1)), 1), _signed(F.array_except(of(-1), of(1)), -1))


def differences(a: Column, b: Column, base_a: Column, base_b: Column, load: float | Column = LOAD) -> Column:
    """Digests (x, s) that differ between sets ``a`` (s = 1) and ``b`` (s = -1)."""

    def larger(size_of_both: Column) -> Column:
        groups = F.greatest(F.lit(1), F.ceil(size_of_both / load)).cast("long")
        dealt = F.sort_array(F.transform(
            F.concat(_signed(a, 1), _signed(b, -1)),
            lambda e: F.struct(F.pmod(F.xxhash64(e["x"], F.lit(-2)), groups).alias("g"), e["x"].alias("x"), e["s"].alias("s")),
        ))

        def by_group(sorted_: Column) -> Column:
            n = F.size(sorted_)
            heads = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(sorted_, i)["g"] != F.get(sorted_, i - 1)["g"]))

            def each(heads: Column) -> Column:
                return F.flatten(F.transform(heads, lambda at, i: recovered(
                    F.transform(
                        F.slice(sorted_, at + 1, F.coalesce(F.get(heads, i + 1), n) - at),
                        lambda e: F.struct(e["x"].alias("x"), e["s"].alias("s")),
                    )
                )))

            return _let(heads, each)

        return _let(dealt, by_group)

    def recovered(group: Column) -> Column:
        def climb(g: Column) -> Column:
            rungs = [peel(sketch(g, size, seed), size, seed) for seed, size in enumerate(LADDER, start=1)]
            single = _let(one_cell(g), lambda c: F.when(
                (c["n"] == 0) & (c["k"] == 0) & (c["h"] == 0), _none()
            ).when((F.abs(c["n"]) == 1) & (c["h"] == _check(c["k"])), F.array(F.struct(c["k"].alias("x"), c["n"].alias("s")))))
            return F.coalesce(single, *rungs, _apart(g))

        return _let(group, climb)

    both = F.size(a) + F.size(b)
    small = peel(subtract(base_a, base_b), CELLS, 0)
    return F.when(both == 0, _none()).otherwise(F.coalesce(small, larger(both)))


def likeness(a: Column, b: Column, base_a: Column, base_b: Column, load: float | Column = LOAD) -> Column:
    """Jaccard index of two digest sets, from their sizes and recovered differences."""
    both = F.size(a) + F.size(b)
    apart = F.size(differences(a, b, base_a, base_b, load))
    return F.when(both == 0, F.lit(1.0)).otherwise((both - apart) / (both + apart))


# --- the operator ---------------------------------------------------------------------

KEY = ("rank", "hash")


def _next_documents(rows: DataFrame) -> DataFrame:
    """(rank, hash, previous, wanted): the document before each one in descending order
    (the last one before the first) and the characters that its edited text takes.

    Narrow rows (rank, hash, n) are dealt into descending ranges and numbered within each;
    a range's last document is followed by the next range's first, from a table of
    one row a range.
    """
    partitions = default_partitions(rows.sparkSession)
    distinct = rows.groupBy(*KEY).agg(F.max("n").alias("n")).select(F.struct(*KEY).alias("key"), "n")
    ranged = distinct.repartitionByRange(partitions, F.desc("key.rank")).withColumn("range", F.spark_partition_id()).checkpoint()
    firsts = ranged.groupBy("range").agg(F.max("key").alias("first"))  # one row a range
    around = Window.partitionBy(F.lit(0)).orderBy("range")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = firsts.select("range", F.coalesce(F.lead("first").over(around), F.first("first").over(whole)).alias("after"))
    follows = F.lead("key").over(Window.partitionBy("range").orderBy(F.desc("key")))
    linked = ranged.withColumn("next", follows).join(F.broadcast(edges), "range").withColumn("next", F.coalesce("next", "after"))
    return linked.select("next.*", F.col("key").alias("previous"), F.floor(F.col("n") / 3).cast("int").alias("wanted"))


#: Kinds of sketches: own text with edited, own with next, and the written ones of own and edited.
EDITED, NEXT, OWN_WRITTEN, EDITED_WRITTEN = range(4)
_OUT = 3           # in place of a table: digests recovered
_LANE_BITS = 10    # two for the kind, the others for the size in bits
_AT_BITS = 2 + _LANE_BITS


def _bits(both: Column) -> Column:
    """log2 of the cells of a table that hold ``both`` digests."""
    return F.greatest(F.lit(LEAST_BITS), F.ceil(F.log2(F.greatest(both, F.lit(1)) * SPARE)).cast("int"))


def _lane(kind: int, bits: Column) -> Column:
    return (bits * 4 + kind).cast("long")


def _at(digest: Column, table: Column, lane: Column) -> Column:
    """Place of a digest as one number: cell, lane and table. The cell is the digest's low
    bits after the first ``20 * table``, as many as the lane's size says."""
    size = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(lane, 2).cast("int"))
    cell = F.call_function("shiftrightunsigned", digest, table * 20).bitwiseAND(size - 1)
    return F.shiftleft(cell, _AT_BITS).bitwiseOR(F.shiftleft(lane, 2)).bitwiseOR(table.cast("long"))


def _parts(at: Column) -> tuple[Column, Column, Column]:
    """(table, lane, cell) of a place."""
    return at.bitwiseAND(3), F.shiftright(at, 2).bitwiseAND((1 << _LANE_BITS) - 1), F.shiftright(at, _AT_BITS)


def version_cells(sets: DataFrame) -> DataFrame:
    """Stored sketches: (rank, hash, at) with n, k, h of the own text (0) and of the other
    one (1), from one row a document with its digest sets ``own``, ``new`` and ``next``."""
    size = lambda other: _bits(F.size("own") + F.size(other))
    edited, following = _lane(EDITED, size("new")), _lane(NEXT, size("next"))
    small = F.lit((CELLS // 3).bit_length() - 1)
    sides = F.array(
        F.struct(F.col("own").alias("xs"), F.array(edited, following, _lane(OWN_WRITTEN, small)).alias("lanes"), F.lit(0).alias("other")),
        F.struct(F.col("new").alias("xs"), F.array(edited, _lane(EDITED_WRITTEN, small)).alias("lanes"), F.lit(1).alias("other")),
        F.struct(F.col("next").alias("xs"), F.array(following).alias("lanes"), F.lit(1).alias("other")),
    )
    placed = (
        sets.select(*KEY, F.inline(sides)).select(*KEY, "lanes", "other", F.explode("xs").alias("x"))
        .select(*KEY, "other", "x", F.explode("lanes").alias("lane"))
        .select(*KEY, "other", "x", "lane", F.explode(F.array(*map(F.lit, range(3)))).alias("table"))
        .select(*KEY, "other", "x", _check(F.col("x")).alias("check"), _at(F.col("x"), F.col("table"), F.col("lane")).alias("at"))
    )
    of = lambda side, value: F.when(F.col("other") == side, value).otherwise(_LONG())
    return placed.groupBy(*KEY, "at").agg(*[
        agg(of(side, value)).alias(f"{name}{side}")
        for side in (0, 1)
        for name, agg, value in (("n", F.sum, F.lit(1).cast("long")), ("k", F.bit_xor, F.col("x")), ("h", F.bit_xor, F.col("check")))
    ])


def differing(cells: DataFrame) -> DataFrame:
    """Subtracted and peeled: (rank, hash, apart and failed of ``EDITED`` and ``NEXT``, written cells).

    ``apart*`` counts recovered digests, ``failed*`` says that cells are left.
    """
    table, lane, cell = _parts(F.col("at"))
    kind = lane.bitwiseAND(3)
    state = cells.select(
        *KEY, "at",
        F.when(kind >= OWN_WRITTEN, F.col("n0") + F.col("n1")).otherwise(F.col("n0") - F.col("n1")).alias("n"),
        F.col("k0").bitwiseXOR(F.col("k1")).alias("k"),
        F.col("h0").bitwiseXOR(F.col("h1")).alias("h"),
    )
    empty = (F.col("n") == 0) & (F.col("k") == 0) & (F.col("h") == 0)
    out = F.struct(F.shiftleft(lane, 2).bitwiseOR(_OUT).alias("at"), F.lit(1).cast("long").alias("n"), _LONG().alias("k"), _LONG().alias("h"))
    for step in range(STEPS):
        this = step % 3
        pure = (table == this) & (kind < OWN_WRITTEN) & (F.abs("n") == 1) & (F.col("h") == _check(F.col("k")))
        taken = [
            F.struct(_at(F.col("k"), F.lit(j), lane).alias("at"), (-F.col("n")).alias("n"), F.col("k").alias("k"), F.col("h").alias("h"))
            for j in range(3) if j != this
        ]
        moved = state.where(~empty).select(*KEY, F.inline(F.when(pure, F.array(*taken, out)).otherwise(F.array(F.struct("at", "n", "k", "h")))))
        state = moved.groupBy(*KEY, "at").agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"))
    written = F.struct((table * (CELLS // 3) + cell).cast("int").alias("c"), F.col("n").cast("int").alias("n"), "k", "h")
    return state.where(~empty).groupBy(*KEY).agg(
        *[F.sum(F.when((kind == w) & (table == _OUT), F.col("n")).otherwise(_LONG())).alias(f"apart{w}") for w in (EDITED, NEXT)],
        *[F.max((kind == w) & (table != _OUT)).alias(f"failed{w}") for w in (EDITED, NEXT)],
        *[F.collect_list(F.when(kind == w, written)).alias(f"written{w}") for w in (OWN_WRITTEN, EDITED_WRITTEN)],
    )


def _filled(cells: Column) -> Column:
    """All cells of a written sketch in order, from those that are not empty."""
    none = F.struct(F.lit(0).alias("n"), _LONG().alias("k"), _LONG().alias("h"))
    listed = F.coalesce(cells, F.expr("cast(array() as array<struct<c:int,n:int,k:bigint,h:bigint>>)"))
    at = lambda c: F.get(F.filter(listed, lambda e: e["c"] == c), F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), F.lit(CELLS - 1)),
        lambda c: _let(at(c), lambda e: F.when(e.isNull(), none).otherwise(F.struct(e["n"].alias("n"), e["k"].alias("k"), e["h"].alias("h")))),
    )


def _size(cells: Column) -> Column:
    """Digests in a sketch: those of its first table."""
    return F.aggregate(F.slice(cells, 1, CELLS // 3), F.lit(0), lambda n, c: n + c["n"])


def written(cells: Column) -> Column:
    """A fingerprint as text: the number of paragraphs, then the cells."""
    hexes = F.transform(cells, lambda c: F.concat_ws(".", c["n"].cast("string"), F.hex(c["k"]), F.hex(c["h"])))
    return F.concat_ws(":", _size(cells).cast("string"), F.concat_ws("-", hexes))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("rank"), F.xxhash64(text).alias("hash")]
    rows = docs.select(*key, text.alias("text"))
    following = _next_documents(docs.select(*key, F.length(text).alias("n")))
    # what a document gives to the one before it: the beginning of its text, and its digests
    given = (
        rows.join(following, [*KEY])
        .select("previous.*", F.substring("text", F.lit(1), F.col("wanted")).alias("head"), paragraph_digests(F.col("text")).alias("next"))
        .groupBy(*KEY).agg(F.first("head").alias("head"), F.first("next").alias("next"))
    )
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), "head")
    pairs = rows.join(given, [*KEY])
    single = pairs.groupBy(*KEY).agg(*[F.first(c).alias(c) for c in ("text", "head", "next")])  # repeated rows once
    sets = single.select(*KEY, paragraph_digests(F.col("text")).alias("own"), paragraph_digests(edited).alias("new"), "next")
    peeled = differing(version_cells(sets))

    def found(kind: int, both: Column, other: Column, load: float) -> Column:
        """What the likeness takes: counts, or the digests of a pair that did not peel."""
        failed = F.coalesce(F.col(f"failed{kind}"), F.lit(False))
        return F.struct(
            both.alias("both"), F.coalesce(F.col(f"apart{kind}"), _LONG()).alias("apart"),
            F.when(failed, paragraph_digests(F.col("text"))).alias("a"), F.when(failed, other).alias("b"), F.lit(load).alias("load"),
        )

    def near(e: Column) -> Column:
        again = likeness(e["a"], e["b"], base_sketch(e["a"]), base_sketch(e["b"]), e["load"])
        return F.when(e["a"].isNotNull(), again).when(e["both"] == 0, F.lit(1.0)).otherwise((e["both"] - e["apart"]) / (e["both"] + e["apart"]))

    result = _let(F.struct(_filled(F.col(f"written{OWN_WRITTEN}")).alias("own"), _filled(F.col(f"written{EDITED_WRITTEN}")).alias("new")), lambda c: F.struct(
        written(c["own"]).alias("own"), written(c["new"]).alias("new"),
        F.transform(F.array(
            found(EDITED, _size(c["own"]) + _size(c["new"]), paragraph_digests(F.col("edited")), float(LOAD_OF_VERSIONS)),
            found(NEXT, _size(c["own"]) + F.size("next"), F.col("next"), float(LOAD)),
        ), near).alias("near"),
    ))
    joined = pairs.join(peeled, [*KEY], "left").withColumn("edited", edited)
    return joined.select(
        F.when(F.col("rank") != FIRST, F.col("rank")).alias("doc_id"),
        n.cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        result.alias("result"),
    ).select(
        "doc_id", "n_chars", "edited_sha256",
        F.col("result.own").alias("fingerprint"), F.col("result.new").alias("edited_fingerprint"),
        F.col("result.near")[0].alias("near_edited"), F.col("result.near")[1].alias("near_next"),
    )
