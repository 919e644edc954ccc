"""Benchmark decontamination by template windows (operator 4).

A text becomes its words and numbers in order, lower case. Numbers, names (a
capitalised word inside a sentence) and units (a unit word after a number) are
slots: in the template they are replaced by a placeholder of their type. Windows
of ``WINDOW`` template tokens of all documents are joined by hash with those of
the benchmark items, so a question with other numbers or names still matches.
Then the slots are checked: along one alignment of a document with an item, equal
values of the item must stand for equal values in the document and the other way
round; an alignment that breaks this is dropped. A document is contaminated by an
item if the tokens covered by the remaining windows are at least ``MIN_COVERED``
or the share ``MIN_SHARE`` of the item.

Whether a capitalised word at the start of a text or sentence is a name cannot be
seen, so every text has two readings: with such words as words, and with all
capitalised words as names. Windows match within one reading, and an alignment is
checked in each reading by itself.

An item shorter than ``WINDOW`` tokens is one window of its own length. Windows
with fewer than half of their tokens outside slots match only if all their slot
values are equal. DataFrame
functions only. The benchmark's windows are broadcast if they are few by count;
otherwise the join shuffles. Per document nothing is gathered beyond its matches.

Cases: null and empty texts and items match nothing; equal rows get equal results;
rows that share a ``doc_id`` are told apart by their text; a null ``doc_id`` is
kept; an empty benchmark contaminates nothing; an empty table gives no rows;
other columns pass through ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
MIN_COVERED = 12
MIN_SHARE = 0.8
MAX_BROADCAST_WINDOWS = 200_000

# --- fixed values: unit words that are a slot after a number
UNITS = (
    "mm cm m km in ft yd mi mg g kg lb lbs oz ml l s sec min h hr hrs mph kph "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "meter meters metre metres kilometer kilometers kilometre kilometres mile miles "
    "foot feet inch inches gram grams kilogram kilograms pound pounds liter liters litre litres "
    "dollar dollars euro euros cent cents percent degree degrees"
).split()

NAME, UNIT, CAPITAL = "\u0001", "\u0002", "\u0003"  # marks before a token

# the letters come first in the patterns: most positions fail there at once
_NAME_AT = r"(?=\p{Lu}\p{Ll})(?<=[\p{Ll},;:] )"
_CAPITAL_AT = r"(?=\p{Lu}\p{Ll})(?<![\p{L}" + NAME + r"])"
_BEFORE_UNIT = r"([0-9] ?)(?=(?:" + "|".join(UNITS) + r")(?![\p{L}\p{N}]))"
_TOKEN = f"[{NAME}{UNIT}{CAPITAL}]?\\p{{L}}+|[0-9]+(?:[.,][0-9]+)*"

# kinds of a token, the lower three bits of its code: a capitalised first word is either a word or a name
WORD, NUMBER, IS_NAME, IS_UNIT, EITHER = 0, 1, 2, 3, 4
KIND, VALUE = 7, ~7
BOTH, INSIDE, ALL = 0, 1, 2  # readings: capitalised words are names inside a sentence, or all are
CHUNK = 4096                 # tokens of a text whose windows start in one row


def codes(text: Column) -> Column:
    """Array of a code for each word and number in order: a hash of the lower-case token, and its kind."""
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, _NAME_AT, NAME), _CAPITAL_AT, CAPITAL), _BEFORE_UNIT, f"$1{UNIT}")
    found = F.regexp_extract_all(F.lower(marked), F.lit(_TOKEN), F.lit(0))

    def code(t: Column) -> Column:
        # the marks sort before the digits, and these before the letters
        kind = F.when(t >= ":", WORD).when(t >= "0", NUMBER).when(t < UNIT, IS_NAME).when(t < CAPITAL, IS_UNIT).otherwise(EITHER)
        value = F.when(t < "0", F.substring(t, 2, 1 << 30)).otherwise(t)
        return F.xxhash64(value).bitwiseAND(F.lit(VALUE)).bitwiseOR(kind.cast("long"))

    return F.transform(found, code)


def _as_read(code: Column, reading: int) -> Column:
    """The code with its kind in this reading."""
    either = code.bitwiseAND(F.lit(KIND)) == EITHER
    return F.when(either, code.bitwiseAND(F.lit(VALUE)).bitwiseOR(F.lit(IS_NAME if reading == ALL else WORD).cast("long"))).otherwise(code)


def _kind(code: Column) -> Column:
    return code.bitwiseAND(F.lit(KIND))


def _shape(code: Column) -> Column:
    """What a token is in a template: the kind of a slot, or else the token's code."""
    return F.when(_kind(code) != WORD, _kind(code)).otherwise(code)


def slots_of(found: Column, reading: Column) -> Column:
    """The codes of a window's slots in order."""
    read = F.transform(found, lambda c: F.when(reading == ALL, _as_read(c, ALL)).otherwise(_as_read(c, INSIDE)))
    return F.filter(read, lambda c: _kind(c) != WORD)


def windows(rows: DataFrame, keep: list[str], sizes: list[int]) -> DataFrame:
    """(keep, h, p, size, r, part, i): the windows of the given sizes of the texts' ``codes``:
    hash, position, reading (``BOTH`` where the readings agree), and where their codes stand.

    The hash is that of the template: the kinds of the slots and the other tokens. With
    fewer than half of the tokens outside slots it is, as another kind of hash, that of
    the values. A long text is cut into rows of ``CHUNK`` starts; tokens are read in
    both ways once a row, and windows are hashed by generated code (kept short: a
    large method is not compiled)."""
    pieces = F.filter(F.sequence(F.lit(0), F.floor(F.size("codes") / CHUNK).cast("int")), lambda x: x * CHUNK < F.size("codes"))
    cut = rows.select(*keep, "codes", F.explode(pieces).alias("chunk"))
    cut = cut.select(*keep, (F.col("chunk") * CHUNK).alias("base"), F.slice("codes", F.col("chunk") * CHUNK + 1, CHUNK + WINDOW - 1).alias("part"))

    def read(reading: int) -> Column:
        values = F.transform("part", lambda c: _as_read(c, reading))
        return F.struct(F.lit(reading).alias("r"), values.alias("values"), F.transform(values, _shape).alias("shape"))

    either = F.exists("part", lambda c: _kind(c) == EITHER)
    ways = F.when(either, F.array(read(INSIDE), read(ALL))).otherwise(F.array(read(INSIDE)))
    at = cut.select(*keep, "base", "part", F.explode(ways).alias("way")).select(*keep, "base", "part", "way.r", "way.values", "way.shape")
    at = at.select(*keep, "base", "part", "r", "values", "shape", F.posexplode("shape").alias("i", "_")).where(F.col("i") < CHUNK)
    at = at.withColumn("size", F.explode(F.lit(sizes).cast("array<int>")) if len(sizes) > 1 else F.lit(sizes[0]))
    at = at.where(F.col("i") + F.col("size") <= F.size("shape"))

    def count(array: str, is_it) -> Column:
        def one(k: int) -> Column:
            return is_it(F.get(array, F.col("i") + k)) if k < min(sizes) else (F.lit(k) < F.col("size")) & is_it(F.get(array, F.col("i") + k))

        tests = [F.when(one(k), 1).otherwise(0) for k in range(max(sizes))]
        return sum(tests[1:], tests[0])

    slots = count("shape", lambda c: (c >= NUMBER) & (c <= IS_UNIT))
    unsure = count("part", lambda c: _kind(c) == EITHER)
    of = lambda array: F.slice(array, F.col("i") + 1, F.col("size"))
    h = F.when(2 * slots > F.col("size"), F.xxhash64(of("values"), -F.col("size"))).otherwise(F.xxhash64(of("shape"), F.col("size")))
    told = at.withColumn("unsure", unsure).where((F.col("r") == INSIDE) | (F.col("unsure") > 0))
    r = F.when(F.col("unsure") == 0, BOTH).otherwise(F.col("r"))
    return told.select(*keep, h.alias("h"), (F.col("base") + F.col("i") + 1).alias("p"), "size", r.alias("r"), "part", "i")


def _coded(texts: DataFrame, keep: list[Column]) -> DataFrame:
    return texts.select(*keep, codes(F.col("text").cast("string")).alias("codes"))


def _slots(reading: Column) -> Column:
    return slots_of(F.slice("part", F.col("i") + 1, F.col("size")), reading)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(h, item_id, tokens, size, item_slots, at, reading): windows of the items in both readings."""
    items = _coded(benchmark, [F.col("item_id")]).withColumn("tokens", F.size("codes")).checkpoint()
    found = windows(items, ["item_id", "tokens"], list(range(1, WINDOW + 1))).where(F.col("size") == F.least("tokens", F.lit(WINDOW)))
    both = found.withColumn("reading", F.explode(F.when(F.col("r") == BOTH, F.array(F.lit(INSIDE), F.lit(ALL))).otherwise(F.array("r"))))
    return both.select("h", "item_id", "tokens", "size", _slots(F.col("reading")).alias("item_slots"), F.col("p").alias("at"), "reading")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, covered, tokens): the contaminating items of each document key (see ``doc_key``)."""
    known = benchmark_windows(benchmark).checkpoint()
    found = known.agg(F.count(F.lit(1)).alias("n"), F.collect_set("size").alias("sizes")).first()  # at most WINDOW sizes
    few = found["n"] <= MAX_BROADCAST_WINDOWS
    sizes = sorted(found["sizes"]) or [WINDOW]
    asked = windows(_coded(docs, [doc_key().alias("key")]), ["key"], sizes)
    known = known.withColumnRenamed("size", "item_size")
    matched = asked.join(F.broadcast(known) if few else known, "h").where("size = item_size").where((F.col("r") == BOTH) | (F.col("r") == F.col("reading")))
    matched = matched.withColumn("s", _slots(F.col("reading")))  # the slots of matched windows only
    # along one alignment: positions differ by the same number
    aligned = matched.groupBy("key", "item_id", "tokens", "reading", (F.col("p") - F.col("at")).alias("shift")).agg(
        F.collect_set(F.struct("item_slots", "s")).alias("slots"), F.collect_set(F.struct("at", "size")).alias("places")
    )
    values = F.array_distinct(F.flatten(F.transform("slots", lambda x: F.arrays_zip(x["item_slots"].alias("i"), x["s"].alias("d")))))
    distinct = lambda side: F.size(F.array_distinct(F.transform("values", lambda x: x[side])))
    consistent = aligned.withColumn("values", values).where((F.size("values") == distinct("i")) & (F.size("values") == distinct("d")))
    cover = F.flatten(F.transform("places", lambda x: F.sequence(x["at"], x["at"] + x["size"] - 1)))
    covered = F.size(F.array_distinct(F.flatten(F.collect_list(cover))))
    share = F.ceil(F.col("tokens") * F.lit(MIN_SHARE))
    return (
        consistent.groupBy("key", "item_id", "tokens").agg(covered.alias("covered"))
        .where(F.col("covered") >= F.least(F.lit(MIN_COVERED).cast("long"), share)).select("key", "item_id", "covered", "tokens")
    )


def doc_key() -> Column:
    """A document's key: its id and a hash of its text (null ids are equal as fields of a struct)."""
    return F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("h"))


def flag_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, share) of every row; ``item_ids`` in ascending order."""
    by_doc = contaminated(docs, benchmark).groupBy("key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max(F.col("covered") / F.col("tokens")).alias("share")
    )
    rows = docs.select("doc_id", doc_key().alias("key")).join(by_doc, "key", "left")
    return rows.select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join(F.col("item_ids").cast("array<string>"), ","), F.lit("")).alias("item_ids"), F.coalesce("share", F.lit(0.0)).alias("share"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = contaminated(docs, benchmark).select("key").distinct()
    whole = docs.select(doc_key().alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return whole.join(bad, "key", "left_anti").select("row.*")
