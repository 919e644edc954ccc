"""Prefix trie of conversations by fixed-length block hashing (operator 13).

A conversation is its turns in order; the trie has a node for every distinct
sequence of first turns. Hashing every prefix of every conversation would shuffle a
row a turn, most of them equal. Instead a conversation is cut into blocks of
``BLOCK`` turns:

1. *Blocks.* A turn's place in the trie is a digest of its depth, role and text; the
   digest of a prefix is the exclusive or of its turns' digests, so a block's prefix
   digest is that of the blocks before and its own. Conversations are grouped by the
   prefix digest after each block: one row a distinct block prefix, with its number
   of members and the smallest. A block prefix that thousands share is combined
   before the shuffle.
2. *Turns.* Distinct block prefixes with the same parent prefix are siblings. Only
   where there are several is the block opened turn by turn and its turn prefixes
   grouped again; a block without siblings is a chain of nodes with the block's
   members.
3. *Subtrees.* A node belongs to its smallest member, so a subtree's sum over nodes
   is a sum over the members of what they own further on. That is a running sum
   within each conversation, added up by block prefix and then by node: no step
   walks the trie level by level.

Running values within a conversation are built in two levels (``SPAN`` blocks at a
time, then the spans), so a conversation that holds a third of all turns is no window
of its own. Numbering uses the same cuts (``operators.numbering``). Joins on prefix
digests look hot nodes up in a broadcast table of at most ``HOT`` rows.

Cases: a null role or text is empty; a null turn comes first; turns with equal
numbers are ordered by the digest of role and text, so repeated rows are turns of
their own; rows without ``conv_id`` are in no conversation; an empty table gives the
root alone, without members (``conv_id`` null). Long texts are digested in the scan
and go no further. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.operators.numbering import number_within

BLOCK = 4          # turns of a block
SPAN = 1024        # blocks whose running values are built in one window
HEAD = 3           # turns taken over from another conversation, at most
EVERY = 20         # that conversation's id is this one's less its remainder (of SQL's sign) by this
HOT = 1000         # hot nodes looked up by broadcast, at most
CHUNK = 1024       # ids of a node joined to one string at a time, at most
WORD = r"[^\x20\x09-\x0D]+"

NODE = ["p1", "p2"]  # a prefix digest
NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words) of the rows that are in a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the role's length tells where the role ends
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def head_of(conv_id: Column) -> Column:
    """Turns that conversation ``conv_id`` takes over from another."""
    return (F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % F.lit(HEAD + 1)).cast("int")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, taken) of every conversation, with its number of taken-over turns,
    and (conv_id, depth, digest, words) of the rebuilt turns, depths from 1."""
    placed = number_within(turns, ["conv_id"], ["turn", "digest"], "at")
    heads = placed.where((F.col("at") < HEAD) & (F.col("conv_id") % EVERY == 0)).groupBy(F.col("conv_id").alias("source")).agg(
        F.array_sort(F.collect_list(F.struct("at", "digest", "words"))).alias("head")  # at most HEAD entries
    )
    own = placed.where("at = 0").select("conv_id").withColumn("source", F.col("conv_id") - F.col("conv_id") % EVERY)
    convs = own.join(heads, "source", "left").select(
        "conv_id", F.slice(F.coalesce("head", F.array().cast("array<struct<at:bigint,digest:binary,words:bigint>>")), F.lit(1), head_of(F.col("conv_id"))).alias("head")
    ).checkpoint()
    taken = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", (F.col("t.at") + 1).alias("depth"), "t.digest", "t.words")
    # where the other conversation is shorter, own turns move up
    short = convs.select("conv_id", (F.size("head") - head_of(F.col("conv_id"))).alias("less")).where("less < 0")
    later = placed.where(F.col("at") >= head_of(F.col("conv_id"))).join(short, "conv_id", "left")
    later = later.select("conv_id", (F.col("at") + 1 + F.coalesce("less", F.lit(0))).alias("depth"), "digest", "words")
    return convs.select("conv_id", F.size("head").alias("taken")), taken.union(later)


def marks(digest: Column, depth: Column) -> list[Column]:
    """Two 64-bit digests of a turn at its depth."""
    return [F.xxhash64(F.lit(seed), depth.cast("long"), digest) for seed in (1, 2)]


def running(rows: DataFrame, key: str, at: str, values: dict[str, tuple[str, Column]], last_first: bool = False) -> DataFrame:
    """Add, for each new column, the running total (``sum`` or ``bit_xor``) of a column
    over the rows of ``key`` *before* this one by ``at`` (after it: ``last_first``).

    Built within spans of ``SPAN`` values of ``at``, then over the spans of a key.
    """
    rows = rows.withColumn("_span", F.floor(F.col(at) / SPAN)).withColumns({f"_v_{c}": v for c, (_, v) in values.items()})
    order = (lambda c: F.desc(c)) if last_first else (lambda c: F.asc(c))
    inside = Window.partitionBy(key, "_span").orderBy(order(at)).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(key).orderBy(order("_span")).rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy(key, "_span").agg(*[F.expr(f"{how}(_v_{c})").alias(f"_s_{c}") for c, (how, _) in values.items()])
    spans = spans.select(key, "_span", *[F.coalesce(F.expr(f"{how}(_s_{c})").over(before), F.lit(0)).alias(f"_b_{c}") for c, (how, _) in values.items()])
    # a key of one span has nothing before it: only others are looked up
    spans = spans.where(" or ".join(f"_b_{c} != 0" for c in values))
    out = rows.withColumns({f"_r_{c}": F.coalesce(F.expr(f"{how}(_v_{c})").over(inside), F.lit(0)) for c, (how, _) in values.items()})
    out = out.join(spans, [key, "_span"], "left")
    total = {c: (F.col(f"_r_{c}") + F.coalesce(F.col(f"_b_{c}"), F.lit(0))) if how == "sum"
             else F.col(f"_r_{c}").bitwiseXOR(F.coalesce(F.col(f"_b_{c}"), F.lit(0).cast("long"))) for c, (how, _) in values.items()}
    return out.withColumns(total).drop("_span", *[f"_{x}_{c}" for c in values for x in "vrb"])


def blocks_of(turns: DataFrame) -> DataFrame:
    """(conv_id, k, from1, from2, p1, p2, turns): block ``k`` of a conversation with the
    prefix digests before and after it, and its at most ``BLOCK`` turns (m1, m2, words) in order."""
    m1, m2 = marks(F.col("digest"), F.col("depth"))
    cut = turns.select("conv_id", F.floor((F.col("depth") - 1) / BLOCK).alias("k"), F.struct("depth", m1.alias("m1"), m2.alias("m2"), "words").alias("t"))
    blocks = cut.groupBy("conv_id", "k").agg(
        F.array_sort(F.collect_list("t")).alias("turns"),  # at most BLOCK
        F.bit_xor("t.m1").alias("b1"), F.bit_xor("t.m2").alias("b2"),
    )
    begun = running(blocks, "conv_id", "k", {"from1": ("bit_xor", F.col("b1")), "from2": ("bit_xor", F.col("b2"))})
    return begun.select("conv_id", "k", "from1", "from2", F.col("from1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("from2").bitwiseXOR(F.col("b2")).alias("p2"), "turns")


def looked_up(rows: DataFrame, table: DataFrame, on: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``table`` (one row a key, ``weight`` = how many rows look it
    up, which add up to ``total``): keys that more than one row in ``HOT`` looks up
    are at most ``HOT``; they are broadcast, and only the others are shuffled."""
    hot = table.where(F.col(weight) * HOT > total)
    rest = table.where(F.coalesce(F.col(weight), F.lit(0)) * HOT <= total)
    some = rows.join(F.broadcast(hot.select(*on, F.lit(True).alias("_hot"))), on, "left")
    found = some.where("_hot").drop("_hot").join(F.broadcast(hot), on)
    return found.unionByName(some.where("_hot is null").drop("_hot").join(rest, on, how), allowMissingColumns=True)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(p1, p2, ends_sha256): digest of the ascending ids of each prefix, comma-joined.

    Ids are first joined within chunks of ``CHUNK`` consecutive values. A node's
    chunks are then streamed in order through the hash: nothing is held but a batch.
    """
    chunks = ends.groupBy(*NODE, F.floor(F.col("conv_id") / CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")  # ids are distinct: at most CHUNK
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "ends_sha256"]
        node, hashed = None, None
        for batch in batches:
            done = []
            for p1, p2, ids in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3))):
                if (p1, p2) != node:
                    if node:
                        done.append((*node, hashed.hexdigest()))
                    node, hashed = (p1, p2), hashlib.sha256()
                else:
                    hashed.update(b",")
                hashed.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, hashed.hexdigest())], names)

    # node by node, each in one task, in order
    dealt = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk")
    return dealt.mapInArrow(run, "p1 long, p2 long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the prefix trie (``NODE_COLUMNS``) of ``conversations(conv_id, turn, role, text)``, rebuilt."""
    convs, turns = rebuilt(turns_of(conversations))
    blocks = blocks_of(turns).checkpoint()

    # 1. distinct block prefixes, with their members
    prefixes = blocks.groupBy("k", "from1", "from2", *NODE).agg(
        F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("owner"), F.first("turns").alias("turns")
    ).checkpoint()
    siblings = prefixes.groupBy("k", "from1", "from2").agg(F.count(F.lit(1)).alias("siblings"))
    parts = looked_up(prefixes, siblings, ["k", "from1", "from2"], "siblings", prefixes.count())

    # 2. turns: of every block prefix, then those of siblings grouped
    def prefix(mark: str, start: str) -> Column:
        one = lambda i: F.aggregate(F.slice(F.col("turns"), F.lit(1), i), F.col(start), lambda acc, t: acc.bitwiseXOR(t[mark]))
        return F.transform(F.sequence(F.lit(0), F.size("turns")), one)

    opened = parts.withColumns({"x1": prefix("m1", "from1"), "x2": prefix("m2", "from2")}).select(
        F.col("p1").alias("e1"), F.col("p2").alias("e2"), "members", "owner", "siblings", "x1", "x2", F.posexplode("turns").alias("i", "t")
    )
    steps = opened.select(
        "e1", "e2", "members", "owner", "siblings", F.col("t.depth").alias("depth"), F.col("t.words").alias("words"),
        F.col("x1")[F.col("i")].alias("up1"), F.col("x2")[F.col("i")].alias("up2"), F.col("x1")[F.col("i") + 1].alias("p1"), F.col("x2")[F.col("i") + 1].alias("p2"),
    ).checkpoint()
    keys = [*NODE, "up1", "up2", "depth", "words"]
    grouped = steps.where("siblings > 1").groupBy(*keys).agg(F.sum("members").alias("n_convs"), F.min("owner").alias("conv_id"), F.count(F.lit(1)).alias("through"))
    chains = steps.where("siblings = 1").select(*keys, F.col("members").alias("n_convs"), F.col("owner").alias("conv_id"), F.lit(1).cast("long").alias("through"))
    found = grouped.unionByName(chains).checkpoint()
    children = found.groupBy(F.col("up1").alias("p1"), F.col("up2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children")).checkpoint()
    nodes = found.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("value", (F.col("n_convs") - 1) * F.col("words")).withColumn("leaf", (F.col("n_children") == 0).cast("long")).checkpoint()
    n_nodes = nodes.count()

    # 3. what each conversation owns in its blocks, and after them
    owned = nodes.groupBy("conv_id", F.floor((F.col("depth") - 1) / BLOCK).alias("k")).agg(F.sum("value").alias("value"), F.sum("leaf").alias("leaf"))
    held = blocks.select("conv_id", "k", *NODE).join(owned, ["conv_id", "k"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("value", "leaf")})
    after = running(held, "conv_id", "k", {"later_value": ("sum", F.col("value")), "later_leaf": ("sum", F.col("leaf"))}, last_first=True)
    after = after.groupBy(*NODE).agg(F.sum("later_value").alias("later_value"), F.sum("later_leaf").alias("later_leaf"))
    # a turn's node counts in the block prefix of its owner, with what stands below it there
    n_steps = steps.count()
    own = nodes.select(*NODE, "conv_id", "value", "leaf", "through")
    valued = looked_up(steps.select("e1", "e2", "depth", "owner", *NODE), own, NODE, "through", n_steps)
    mine = F.col("owner") == F.col("conv_id")
    valued = valued.select("e1", "e2", "depth", *NODE, F.when(mine, F.col("value")).otherwise(0).alias("value"), F.when(mine, F.col("leaf")).otherwise(0).alias("leaf"))
    below = Window.partitionBy("e1", "e2").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)  # at most BLOCK rows
    summed = valued.withColumns({"value": F.sum("value").over(below), "leaf": F.sum("leaf").over(below)})
    summed = summed.join(after.select(F.col("p1").alias("e1"), F.col("p2").alias("e2"), "later_value", "later_leaf"), ["e1", "e2"])
    subtrees = summed.groupBy(*NODE).agg(F.sum(F.col("value") + F.col("later_value")).alias("saved_tokens"), F.sum(F.col("leaf") + F.col("later_leaf")).alias("n_leaves"))

    # ends: the conversations whose last block ends here
    last = blocks.groupBy("conv_id").agg(F.max_by(F.struct(*NODE), "k").alias("p"))
    every = convs.select("conv_id").join(last, "conv_id", "left").select("conv_id", *[F.coalesce(f"p.{c}", F.lit(0).cast("long")).alias(c) for c in NODE])
    ends = ends_digests(every).checkpoint()

    none = hashlib.sha256(b"").hexdigest()
    root = _root(convs, nodes, ends, none)
    up = nodes.select(F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("conv_id").alias("parent_conv_id"), "n_children").where("n_children > 0")
    up = up.unionByName(root.select(F.lit(0).cast("long").alias("up1"), F.lit(0).cast("long").alias("up2"), F.col("conv_id").alias("parent_conv_id"), "n_children"))
    out = looked_up(nodes.select(*NODE, "up1", "up2", "conv_id", "depth", "n_convs", F.col("n_children").alias("children")), up, ["up1", "up2"], "n_children", n_nodes)
    out = out.drop("n_children").withColumnRenamed("children", "n_children").join(subtrees, NODE).join(ends, NODE, "left")
    out = out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
    return out.select(*NODE_COLUMNS).unionByName(root.select(*NODE_COLUMNS)).select(*[F.col(c) if c == "ends_sha256" else F.col(c).cast("long").alias(c) for c in NODE_COLUMNS])


def _root(convs: DataFrame, nodes: DataFrame, ends: DataFrame, none: str) -> DataFrame:
    """The root's row, from totals that are aggregated partially."""
    total = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    below = nodes.agg(F.sum((F.col("depth") == 1).cast("long")).alias("n"), F.sum("leaf").alias("leaf"), F.sum("value").alias("value")).first()
    here = ends.where("p1 = 0 and p2 = 0").select("ends_sha256").first()
    row = (total.conv_id, 0, None, total.n_convs, below.n or 0, below.leaf or 1, below.value or 0, here.ends_sha256 if here else none)
    schema = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in NODE_COLUMNS)
    return nodes.sparkSession.createDataFrame([row], schema)
