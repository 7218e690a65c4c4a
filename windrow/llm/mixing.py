"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their pattern). Words flow from
patterns to the quotas of their sources; the first pass over a pattern's documents is free, each
repetition costs more than the one before, up to ``most`` passes. Costs sit on the arcs into the
patterns and rise with the pass, so augmenting along shortest paths means opening the passes one
after the other and routing as much as possible before the next opens. Then documents are
selected: all of a pattern's documents for its full passes, and for the rest the first ones in a
seeded hash order; the document at the border gives only the words still missing, so a source
gets its quota to the word.

Only one row per pattern reaches the driver (sources of real corpora form few sets). Documents
are never gathered by source: the border is found in a histogram of 4,096 hash ranges and a second
one of the border range alone, and only the fine range it names, one of 16 million, is put in order.

Null text: size 0. Null source: a source of its own, last. Empty source array: taken 0. Repeated
rows are documents of their own. Other columns stay untouched where rows are returned. An empty
table gives an empty result.
"""

from __future__ import annotations

import json
import math
from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.llm.shared import folded, small, unfolded, word_count, written

# Bits of the hash that name a range, and as many more for a fine range inside it.
_BITS = 12


def shared_targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Share ``total`` by weight; no share exceeds ``most`` times its size, the excess is shared anew."""
    targets, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while free:
        weight = sum(weights[i] for i in sorted(free))
        over = [i for i in sorted(free) if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in free:
                targets[i] = left * weights[i] / weight
            break
        for i in over:
            targets[i] = float(most * sizes[i])
            free.discard(i)
        left = float(total) - sum(targets[i] for i in range(len(sizes)) if i not in free)
    return targets


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], most: int) -> list[int]:
    """Words each pattern (its sources, its size) gives. Shortest augmenting paths, pass by pass."""
    given = [0] * len(patterns)
    flow: dict[tuple[int, int], int] = {}
    left = list(quotas)
    users: list[list[int]] = [[] for _ in quotas]
    for p, (members, _) in enumerate(patterns):
        for s in members:
            users[s].append(p)
    for passes in range(1, most + 1):
        for p, (members, size) in enumerate(patterns):
            while given[p] < passes * size:
                came: dict[tuple[str, int], tuple[str, int]] = {}
                todo, goal = deque([("p", p)]), None
                while todo and goal is None:
                    kind, x = todo.popleft()
                    if kind == "p":
                        ways = [("s", s) for s in patterns[x][0]]
                    else:
                        if left[x] > 0:
                            goal = x
                            break
                        ways = [("p", other) for other in users[x] if flow.get((other, x), 0) > 0]
                    for way in ways:
                        if way not in came and way != ("p", p):
                            came[way] = (kind, x)
                            todo.append(way)
                if goal is None:
                    break
                path, at = [], ("s", goal)
                while at != ("p", p):
                    path.append((came[at], at))
                    at = came[at]
                amount = min([passes * size - given[p], left[goal], *(flow[b[1], a[1]] for a, b in path if a[0] == "s")])
                for a, b in path:
                    key = (a[1], b[1]) if a[0] == "p" else (b[1], a[1])
                    flow[key] = flow.get(key, 0) + (amount if a[0] == "p" else -amount)
                given[p] += amount
                left[goal] -= amount
    return given


def _pattern(source: Column, kind: T.DataType) -> Column:
    """A document's set of sources as JSON text: ``s`` and the name, or ``n`` for null."""
    named = lambda x: F.coalesce(F.concat(F.lit("s"), x.cast("string")), F.lit("n"))
    if isinstance(kind, T.ArrayType):
        members = F.array_sort(F.array_distinct(F.transform(F.coalesce(source, F.array().cast(kind)), named)))
    else:
        members = F.array(named(source))
    return F.to_json(members)


def _border(hist: DataFrame, plan: DataFrame) -> DataFrame:
    """(_key, _border, _before): the range of each pattern in which the running words pass its rest,
    and the words before that range. ``hist`` (_key, _border, _in) has one row per range."""
    upto = F.sum("_in").over(Window.partitionBy("_key").orderBy("_border"))
    return (hist.withColumn("_before", upto - F.col("_in")).join(plan, "_key")
            .filter((F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_in") >= F.col("_rest")))
            .select("_key", "_border", "_before"))


def with_taken(sized: DataFrame, size: str, pattern: str, ident: str, weights: tuple[int, ...] = (1, 2, 3),
               share: float = 1.0, most: int = 3, seed: int = 17, ties: tuple[Column, ...] = ()) -> DataFrame:
    """Add ``_source_size``, ``_target`` (of a document's first source) and ``_taken`` to ``sized``,
    whose columns ``size``, ``pattern`` and ``ident`` name words, source set and id. Equal ids go by
    size, then by ``ties``."""
    spark = sized.sparkSession
    # 60 bits of a digest of seed and id; the first 12 give the range, the first 24 the fine range.
    h = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(seed), F.col(ident)).cast("binary")), 1, 15), 16, 10).cast("bigint")
    fine = F.shiftright("_h", 60 - 2 * _BITS)
    ranged = sized.withColumn("_h", h).withColumn("_fine", fine.cast("int")).withColumn("_range", F.shiftright("_fine", _BITS))
    hist = written(ranged.groupBy(F.col(pattern).alias("_key"), F.col("_range").alias("_border")).agg(F.sum(size).alias("_in")), "ranges")
    totals = sorted((tuple(json.loads(r[0])), r[0], int(r[1])) for r in hist.groupBy("_key").agg(F.sum("_in")).collect())
    # Code points order names; null ("n") comes last.
    names = sorted({m for members, _, _ in totals for m in members}, key=lambda m: (m == "n", m))
    code = {m: i for i, m in enumerate(names)}
    sizes = [0] * len(names)
    for members, _, n in totals:
        for m in members:
            sizes[code[m]] += n
    whole = sum(n for _, _, n in totals)
    targets = shared_targets(sizes, [weights[i % len(weights)] for i in range(len(names))], share * whole, most)
    quotas = [min(most * n, math.floor(t + 0.5)) for n, t in zip(sizes, targets)]
    given = route([(tuple(code[m] for m in members), n) for members, _, n in totals], quotas, most)
    shape = "_key string, _full bigint, _rest bigint, _source_size bigint, _target double"
    rows = []
    for (members, key, n), words in zip(totals, given):
        full = words // n if n else 0
        first = code[members[0]] if members else None
        rows.append((key, full, words - full * n, sizes[first] if members else 0, targets[first] if members else 0.0))
    # One row per pattern each: its border range, then the fine range inside that.
    rests = spark.createDataFrame([(r[0], r[2]) for r in rows], "_key string, _rest bigint")
    coarse = {r["_key"]: (r["_border"], r["_before"]) for r in _border(hist, rests).collect()}
    open_ = spark.createDataFrame([(r[0], r[2] - coarse[r[0]][1], coarse[r[0]][0]) for r in rows if r[0] in coarse], "_key string, _rest bigint, _in_range int")
    inner = ranged.join(small(open_, len(coarse)), (ranged[pattern] == open_["_key"]) & (ranged["_range"] == open_["_in_range"]))
    inner = inner.groupBy("_key", F.col("_fine").alias("_border")).agg(F.sum(size).alias("_in"))
    exact = {r["_key"]: (r["_border"], coarse[r["_key"]][1] + r["_before"]) for r in _border(inner, open_.drop("_in_range")).collect()}
    plan = spark.createDataFrame([(*r, *exact.get(r[0], (None, None))) for r in rows], f"{shape}, _border int, _before bigint")
    rows = ranged.join(small(plan, len(rows)), ranged[pattern] == plan["_key"], "left")
    border_row = F.coalesce(F.col("_fine") == F.col("_border"), F.lit(False))
    order = Window.partitionBy("_key").orderBy("_h", ident, size, *ties).rowsBetween(Window.unboundedPreceding, -1)
    at = rows.filter(border_row).withColumn("_ahead", F.col("_before") + F.coalesce(F.sum(size).over(order), F.lit(0)))
    extra = F.greatest(F.lit(0), F.least(F.col(size), F.col("_rest") - F.col("_ahead")))
    inside = rows.filter(~border_row).withColumn("_ahead", F.lit(None).cast("bigint"))
    part = F.when(F.col("_ahead").isNotNull(), extra).when(F.col("_fine") < F.col("_border"), F.col(size)).otherwise(0)
    done = inside.unionByName(at).withColumn("_taken", (F.coalesce(F.col("_full"), F.lit(0)) * F.col(size) + part).cast("bigint"))
    return done.drop("_h", "_fine", "_range", "_key", "_rest", "_border", "_before", "_ahead", "_full")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs`` (doc_id, text, source);
    ``source`` may be an array. For several sources the size and target are the first one's."""
    sized = docs.select("doc_id", word_count(F.col("text")).alias("size"), _pattern(F.col("source"), docs.schema["source"].dataType).alias("pattern"))
    done = with_taken(written(sized, "sizes"), "size", "pattern", "doc_id", weights, share, most, seed)
    return done.select("doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3, seed: int = 17) -> DataFrame:
    """The mix itself: every document as often as it is taken, whole and with its own columns. Of a document
    at the border of a source the last copy is whole or left out, whichever is nearer to the target, so a
    source misses its target by half a document at most. Documents without a word are not in the mix."""
    kind, keep = docs.schema["source"].dataType, ("doc_id", "text", "source")
    kept = folded(docs, *keep).withColumn("_size", word_count(F.col("text"))).withColumn("_pattern", _pattern(F.col("source"), kind))
    done = with_taken(kept, "_size", "_pattern", "doc_id", weights, share, most, seed, (F.xxhash64("text"),)).filter("_taken > 0")
    # Whole copies only, as many as come nearest to the words taken.
    times = F.floor((2 * F.col("_taken") + F.col("_size")) / (2 * F.col("_size"))).cast("int")
    copies = done.withColumn("_times", times).filter("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return unfolded(copies, docs.columns, *keep)
