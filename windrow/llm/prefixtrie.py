"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is laid out in blocks of ``BLOCK`` turns. One ROLLUP over a block's turn columns
aggregates all prefixes that end in it, ``grouping_id`` tells their depth. Blocks after the first
are keyed by the node that the block before ended in: a pair of 64-bit sums (exclusive or) of
position-tagged turn hashes, which a two-level running total gives, so a conversation of any
length is never gathered. A first ROLLUP counts members; a second one adds up what its leaves and
shared turns give to every node above them, each credited to one member of its node and summed
from the end of that member's path.

Turns and prefixes are told apart by 128-bit hashes. Null ``conv_id``: no conversation, left out.
Null role or text: empty. Turns go by turn number, null first, then by hash; a row that is repeated
inside a conversation is a turn of its own. Very long texts are hashed and counted whole.
Conversations without a turn are members of the root. Other columns are ignored. An empty table
gives an empty result. A group that holds very many ids is hashed from pieces of up to
``_IDS`` ids in order; only the running digest is in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.shared import column, word_count, written
from windrow.scale import ship

# Turns in a block of columns.
BLOCK = 8
# Blocks of one conversation that a window runs over at once, and conv_ids of one piece of a digest.
_RUN, _IDS = 256, 4096
_NODE = ["depth", "a", "b"]


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, hi, lo, words): the turns of every conversation, numbered from 1.

    Rows are dealt by ranges of (conv_id, turn), so the turns of a very long conversation lie in
    several tasks; only the first conversation of a range can have begun before it.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("hi"),
        F.xxhash64(F.lit(2), text, role).alias("lo"), word_count(text).alias("words"), F.monotonically_increasing_id().alias("u"))
    order = ["turn", "hi", "lo", "u"]
    parts = written(turns, "turns").repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    parts = written(parts, "turns-dealt")
    inside = parts.withColumn("nth", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)))
    sizes = parts.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # At most one conversation of each range: no more rows than partitions.
    begun = sizes.withColumn("ahead", ahead).filter("ahead > 0").select("conv_id", "part", "ahead")
    joined = inside.join(F.broadcast(begun), ["conv_id", "part"], "left")
    return joined.select("conv_id", (F.col("nth") + F.coalesce("ahead", F.lit(0))).alias("pos"), "hi", "lo", "words")


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Numbered ``turns`` with heads exchanged: conversation c begins with the first h turns of
    c - c % ``every`` (h: checksum of c modulo ``most``) and goes on with its own after its first h.
    Adds ``n_turns``; a conversation without a turn has one row with a null ``pos``."""
    turns = written(turns, "numbered")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = turns.filter((F.col("conv_id") % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    convs = convs.join(heads.groupBy("base").agg(F.count(F.lit(1)).alias("there")), "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    convs = convs.withColumn("n_turns", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = written(convs, "conversations")
    out = ["conv_id", "pos", "hi", "lo", "words", "n_turns"]
    lent = convs.join(heads, "base").filter("pos <= h").select(*out)
    kept = turns.join(convs.select("conv_id", "h", "taken", "n_turns"), "conv_id").filter("pos > h")
    kept = kept.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken")).select(*out)
    none = convs.filter("n_turns = 0").select("conv_id", *(F.lit(None).cast("bigint").alias(c) for c in out[1:5]), "n_turns")
    return lent.unionByName(kept).unionByName(none)


def _tag(seed: int, pos: Column, hi: Column, lo: Column) -> Column:
    return F.xxhash64(F.lit(seed), pos.cast("bigint"), hi, lo)


def _before(rows: DataFrame, order: str, values: dict[str, tuple[str, callable]]) -> DataFrame:
    """Add, under each name, an aggregate of a column over the conversation's earlier rows by
    ``order``. Windows hold ``_RUN`` rows at most; runs are totalled first."""
    rows = rows.withColumn("_run", F.floor(F.col(order) / _RUN))
    totals = rows.groupBy("conv_id", "_run").agg(*(f(c).alias(f"_{n}") for n, (c, f) in values.items()))
    earlier = Window.partitionBy("conv_id").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = totals.select("conv_id", "_run", *(f(f"_{n}").over(earlier).alias(f"_{n}") for n, (_, f) in values.items()))
    runs = runs.filter(reduce(lambda x, y: x | y, (F.col(f"_{n}").isNotNull() for n in values)))
    near = Window.partitionBy("conv_id", "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", *(f(c).over(near).alias(n) for n, (c, f) in values.items())).join(runs, ["conv_id", "_run"], "left")
    both = {F.bit_xor: lambda x, y: x.bitwiseXOR(y), F.sum: lambda x, y: x + y}
    for n, (_, f) in values.items():
        rows = rows.withColumn(n, both[f](F.coalesce(n, F.lit(0)), F.coalesce(f"_{n}", F.lit(0))))
    return rows.drop("_run", *(f"_{n}" for n in values))


def _blocks(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: conv_id, block, n_turns, ba, bb (the node before it), xa, xb
    (what its turns add to that) and the turns t1, t2, ... as (hi, lo, words)."""
    pos = F.col("pos") - 1
    rows = turns.withColumn("block", F.coalesce(F.floor(pos / BLOCK), F.lit(0))).withColumn("slot", pos % BLOCK + 1)
    rows = rows.withColumn("ta", _tag(3, F.col("pos"), F.col("hi"), F.col("lo"))).withColumn("tb", _tag(4, F.col("pos"), F.col("hi"), F.col("lo")))
    rows = rows.withColumn("ta", F.when(F.col("pos").isNotNull(), F.col("ta"))).withColumn("tb", F.when(F.col("pos").isNotNull(), F.col("tb")))
    cells = [F.max(F.when(F.col("slot") == k, F.col(c))).alias(f"{c}{k}") for k in range(1, BLOCK + 1) for c in ("hi", "lo", "words")]
    wide = rows.groupBy("conv_id", "block").agg(F.max("n_turns").alias("n_turns"), F.bit_xor("ta").alias("xa"), F.bit_xor("tb").alias("xb"), *cells)
    wide = wide.fillna(0, ["xa", "xb"])
    wide = _before(wide, "block", {"ba": ("xa", F.bit_xor), "bb": ("xb", F.bit_xor)})
    turn = [F.when(F.col(f"hi{k}").isNotNull(), F.struct(F.col(f"hi{k}").alias("hi"), F.col(f"lo{k}").alias("lo"), F.col(f"words{k}").alias("words"))).alias(f"t{k}")
            for k in range(1, BLOCK + 1)]
    return wide.select("conv_id", "block", "n_turns", "ba", "bb", "xa", "xb", *turn)


def _rolled(blocks: DataFrame, *aggregates: Column) -> DataFrame:
    """Every prefix that ends in a block: depth, a, b, the parent's pa and pb, last turn, aggregates."""
    keyed = blocks.withColumn("key", F.struct("block", "ba", "bb"))
    names = [f"t{k}" for k in range(1, BLOCK + 1)]
    rolled = keyed.rollup("key", *names).agg(F.grouping_id().alias("g"), *aggregates).filter(F.col("g") < 1 << BLOCK)
    inside = F.lit(BLOCK) - F.bit_count("g")
    rolled = rolled.withColumn("inside", inside).withColumn("last", F.coalesce(*reversed(names)))
    # A level is a prefix if its own column has a turn; level 0 is the node before, or the root.
    own = reduce(lambda x, y: x | y, ((F.col("inside") == k) & F.col(f"t{k}").isNotNull() for k in range(1, BLOCK + 1)))
    rolled = rolled.filter(own | ((F.col("inside") == 0) & (F.col("key.block") == 0)))
    depth = F.col("key.block") * BLOCK + F.col("inside")
    rolled = rolled.withColumn("depth", depth)
    for lane, seed in (("a", 3), ("b", 4)):
        total = F.col(f"key.b{lane}")
        for k in range(1, BLOCK + 1):
            turn = F.col(f"t{k}")
            total = total.bitwiseXOR(F.when(turn.isNotNull(), _tag(seed, F.col("key.block") * BLOCK + k, turn["hi"], turn["lo"])).otherwise(F.lit(0)))
        mine = F.when(F.col("depth") > 0, _tag(seed, F.col("depth"), F.col("last.hi"), F.col("last.lo"))).otherwise(F.lit(0))
        rolled = rolled.withColumn(lane, total).withColumn(f"p{lane}", F.col(lane).bitwiseXOR(mine))
    return rolled


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): SHA-256 over the ascending, comma-joined conv_ids of each node."""
    ship(ends.sparkSession)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy(*_NODE, F.floor(F.col("conv_id") / _IDS).alias("piece")).agg(ids.alias("ids"))
    pieces = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []

        def flush():
            cols = list(zip(*done)) or [()] * 4
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64()] * 3 + [pa.string()])], names=[*_NODE, "ends_sha256"])

        for batch in batches:
            for *node, ids in zip(*(column(batch, c).to_pylist() for c in (*_NODE, "ids"))):
                if node != now:
                    if now is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield flush()
        if now is not None:
            done.append((*now, digest.hexdigest()))
        yield flush()

    return pieces.select(*_NODE, "ids").mapInArrow(run, "depth bigint, a bigint, b bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and turn_hi and turn_lo, the hashes of its last turn.

    ``turns`` holds conv_id, pos, hi, lo, words and n_turns as ``rebuilt`` gives them.
    """
    names = [f"t{k}" for k in range(1, BLOCK + 1)]
    blocks = written(_blocks(turns), "blocks")
    nodes = _rolled(blocks, F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    nodes = written(nodes.select(*_NODE, "pa", "pb", "conv_id", "n_convs", "last"), "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, _NODE, "left").fillna(0, ["n_children"]), "nodes-children")

    # Credits: a leaf counts for its smallest member, a shared turn's saved words lie where they are on
    # the path of the node's smallest member.
    leaves = nodes.filter("n_children = 0").select("conv_id", F.lit(1).cast("bigint").alias("leaf"))
    shared = nodes.filter("depth > 0 and n_convs > 1").withColumn("saved", (F.col("n_convs") - 1) * F.col("last.words"))
    shared = shared.withColumn("block", F.floor((F.col("depth") - 1) / BLOCK)).withColumn("slot", (F.col("depth") - 1) % BLOCK + 1)
    shared = shared.groupBy("conv_id", "block").agg(F.sum("saved").alias("all"), *(F.sum(F.when(F.col("slot") == k, F.col("saved"))).alias(f"s{k}") for k in range(1, BLOCK + 1)))
    credit = blocks.join(shared, ["conv_id", "block"], "left").join(leaves, "conv_id", "left")
    credit = credit.fillna(0, ["leaf", "all", *(f"s{k}" for k in range(1, BLOCK + 1))]).withColumn("back", -F.col("block"))
    credit = _before(credit, "back", {"later": ("all", F.sum)})
    credit = credit.filter("leaf > 0 or all > 0 or later > 0")
    upto = {k: reduce(lambda x, y: x + y, [F.col("later"), *(F.col(f"s{i}") for i in range(k, BLOCK + 1))]) for k in range(1, BLOCK + 1)}
    credit = credit.select("block", "ba", "bb", *names, "leaf", *(e.alias(f"s{k}") for k, e in upto.items()))
    sums = _rolled(credit, F.sum("leaf").alias("n_leaves"), *(F.sum(f"s{k}").alias(f"s{k}") for k in range(1, BLOCK + 1)))
    saved = F.coalesce(*(F.when(F.col("inside") == k, F.col(f"s{k}")) for k in range(2, BLOCK + 1)), F.col("s1"))
    sums = sums.select(*_NODE, "n_leaves", saved.alias("saved_tokens"))

    last = F.col("block") == F.greatest(F.floor((F.col("n_turns") - 1) / BLOCK), F.lit(0))
    ends = blocks.filter(last).select("conv_id", F.col("n_turns").alias("depth"), F.col("ba").bitwiseXOR(F.col("xa")).alias("a"), F.col("bb").bitwiseXOR(F.col("xb")).alias("b"))
    full = nodes.join(sums, _NODE).join(_digests(ends), _NODE, "left")
    return _with_parent(full, nodes).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_tokens").cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        F.col("last.hi").alias("turn_hi"), F.col("last.lo").alias("turn_lo"))


def _with_parent(full: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add parent_conv_id. Parents of over a thousandth of all nodes, fewer than a thousand, are broadcast;
    the children of every other one are few."""
    parents = nodes.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent"), "n_children")
    up, least = ["depth", "pa", "pb"], nodes.count() / 1000
    wide = parents.filter(F.col("n_children") > least).select(*up, F.col("parent").alias("wide"))
    full = full.join(F.broadcast(wide), up, "left")
    known = full.filter("wide is not null or depth = 0").withColumn("parent_conv_id", F.col("wide"))
    rest = full.filter("wide is null and depth > 0").join(parents.filter(F.col("n_children") <= least).select(*up, F.col("parent").alias("parent_conv_id")), up, "left")
    return known.unionByName(rest.select(*known.columns))


def with_turns(trie: DataFrame, conversations: DataFrame) -> DataFrame:
    """The trie with role and text of each node's last turn (null at the root)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    seen = conversations.select(F.xxhash64(F.lit(1), role, text).alias("turn_hi"), F.xxhash64(F.lit(2), text, role).alias("turn_lo"), role.alias("role"), text.alias("text"))
    return trie.join(seen.groupBy("turn_hi", "turn_lo").agg(F.min("role").alias("role"), F.min("text").alias("text")), ["turn_hi", "turn_lo"], "left")
