"""Deletion of repeated line runs by a distributed suffix array over line ids. DataFrame code only.

Lines become 128-bit ids; only stretches of lines that each occur twice or more, with enough words
together, can hold a repeated run, and all other lines leave at once. Prefix doubling then ranks
the suffixes of these stretches by their first 1, 2, 4, ... lines. A rank is 1 + the number of
suffixes with a smaller prefix, so a rank and its count are an interval of the suffix array: all
suffixes in it share that prefix (an LCP interval). Ranks come from range partitions of the distinct
keys with running counts; no window spans all rows and no key's rows are gathered.

A run counts if it has at least ``min_words`` words. At every line, the shortest run that starts
there and the shortest that ends there with that many words are looked up as two overlapping
prefixes of the doubled ranks: equal length and equal ranks mean one LCP interval at that depth.
Their union is exactly the union of all maximal repeated runs, so depth beyond the shortest runs
is never needed and doubling ends after a few rounds. In an interval the first occurrence, by
document id and line, stays; the lines of later ones are deleted. A document's other lines stay.

Documents are told apart by id and text. Repeated rows are one document and share its result. Null
text: no lines, stays null. Empty text: one empty line. Null ids come first. Other columns pass
through untouched. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.shared import folded, unfolded, word_count, written

_DOC = ("_d1", "_d2")


def with_key(docs: DataFrame) -> DataFrame:
    """Add the 128-bit identity of a document: its id and text."""
    ident = F.col("doc_id").cast("string")
    return docs.withColumn("_d1", F.xxhash64(ident, "text")).withColumn("_d2", F.xxhash64(F.lit(11), "text", ident))


def split_lines(text: Column | str) -> Column:
    return F.split(text, "\n")


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, _d1, _d2, pos, h1, h2, w: ids and words of every line, without its text."""
    cell = F.transform(split_lines("text"), lambda x: F.struct(
        F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(5), x).alias("h2"), word_count(x).alias("w")))
    rows = with_key(docs.select("doc_id", "text")).select("doc_id", *_DOC, F.posexplode(cell).alias("pos", "cell"))
    return rows.select("doc_id", *_DOC, "pos", "cell.*")


def ranked(groups: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add ``rank`` = 1 + the total ``cnt`` of all smaller keys; ``groups`` has distinct keys."""
    parts = written(groups.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), name)
    totals = parts.groupBy("part").agg(F.sum("cnt").alias("total"))
    before = F.sum("total").over(Window.orderBy("part")) - F.col("total")  # one row per partition
    base = totals.select("part", before.alias("base"))
    inside = F.sum("cnt").over(Window.partitionBy("part").orderBy(*keys)) - F.col("cnt")
    return parts.withColumn("inside", inside).join(base, "part").withColumn("rank", F.col("base") + F.col("inside") + 1).drop("part", "base", "inside")


def stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Lines that occur twice or more, in gapless stretches with enough words."""
    twice = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1").drop("cnt")
    rows = lines.join(twice, ["h1", "h2"]).groupBy(*_DOC, "pos").agg(*(F.first(c).alias(c) for c in ("doc_id", "h1", "h2", "w")))
    doc = Window.partitionBy(*_DOC).orderBy("pos")
    rows = rows.withColumn("island", F.col("pos") - F.row_number().over(doc))
    island = Window.partitionBy(*_DOC, "island")
    rows = rows.withColumn("words", F.sum("w").over(island)).filter(F.col("words") >= min_words)
    upto = F.sum("w").over(island.orderBy("pos"))
    last = F.max("pos").over(island)
    return rows.select("doc_id", *_DOC, "pos", "island", "h1", "h2", (upto - F.col("w")).alias("before"), upto.alias("upto"), (last - F.col("pos") + 1).alias("left"))


def shortest_runs(rows: DataFrame, min_words: int) -> DataFrame:
    """(document, start, len): for every line the shortest run that starts, or ends, at it.

    A run from ``i`` ends at the first line whose running words reach the words before ``i`` plus
    the minimum. Both sides are merged in one order, and the nearest end is carried along.
    """
    same = [*_DOC, "island"]

    def nearest(asking: Column, answering: Column, upward: bool) -> DataFrame:
        asks = rows.select(*same, F.col("pos").alias("own"), asking.alias("at"), F.lit(None).cast("int").alias("end"), F.lit(1).alias("late"))
        ends = rows.select(*same, F.lit(None).cast("int").alias("own"), answering.alias("at"), F.col("pos").alias("end"), F.lit(0).alias("late"))
        order = [F.desc("at"), F.col("late"), F.desc("end")] if upward else [F.col("at"), F.col("late"), F.col("end")]
        carried = F.last("end", ignorenulls=True).over(Window.partitionBy(*same).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        return asks.unionByName(ends).withColumn("end", carried).filter(F.col("own").isNotNull() & F.col("end").isNotNull())

    forward = nearest(F.col("before") + min_words, F.col("upto"), True)
    back = nearest(F.col("upto") - min_words, F.col("before"), False)
    runs = forward.select(*_DOC, F.col("own").alias("start"), (F.col("end") - F.col("own") + 1).alias("len"))
    return runs.union(back.select(*_DOC, F.col("end").alias("start"), (F.col("own") - F.col("end") + 1).alias("len"))).distinct()


def suffix_ranks(rows: DataFrame, longest: int) -> DataFrame:
    """(document, pos, depth, rank, cnt): order of every suffix by its first ``depth`` lines, for
    depths 1, 2, 4, ... up to ``longest``."""
    groups = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("cnt"))
    now = rows.join(ranked(groups, ["h1", "h2"], "ranks-1"), ["h1", "h2"])
    now = written(now.select(*_DOC, "island", "pos", "left", F.lit(1).alias("depth"), "rank", "cnt"), "suffixes-1")
    levels, depth = now, 1
    while 2 * depth <= longest:
        ahead = F.lead("rank", depth).over(Window.partitionBy(*_DOC, "island").orderBy("pos"))
        pairs = now.withColumn("second", ahead).filter(F.col("left") >= 2 * depth).drop("cnt", "depth").withColumnRenamed("rank", "first")
        groups = pairs.groupBy("first", "second").agg(F.count(F.lit(1)).alias("cnt"))
        depth *= 2
        now = pairs.join(ranked(groups, ["first", "second"], f"ranks-{depth}"), ["first", "second"])
        now = written(now.select(*_DOC, "island", "pos", "left", F.lit(depth).alias("depth"), "rank", "cnt"), f"suffixes-{depth}")
        levels = levels.unionByName(now)
    return levels.select(*_DOC, "pos", "depth", "rank", "cnt")


def later_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(document, cuts): the deleted line intervals of every document that has some, in order."""
    rows = written(stretches(written(line_table(docs), "lines"), min_words), "stretches")
    runs = written(shortest_runs(rows, min_words), "runs")
    longest = runs.agg(F.max("len")).first()[0] or 0
    ranks = suffix_ranks(rows, longest)
    depth = F.expr("shiftleft(1, length(bin(len)) - 1)")  # the largest power of two within len
    runs = runs.withColumn("depth", depth).withColumn("tail", F.col("start") + F.col("len") - F.col("depth"))
    head = ranks.filter("cnt > 1").select(*_DOC, "depth", F.col("pos").alias("start"), F.col("rank").alias("r1"))
    tail = ranks.filter("cnt > 1").select(*_DOC, "depth", F.col("pos").alias("tail"), F.col("rank").alias("r2"))
    named = runs.join(head, [*_DOC, "depth", "start"]).join(tail, [*_DOC, "depth", "tail"])
    named = named.join(rows.select(*_DOC, F.col("pos").alias("start"), "doc_id"), [*_DOC, "start"])
    named = written(named.select("doc_id", *_DOC, "start", "len", "r1", "r2"), "intervals")
    place = F.struct("doc_id", *_DOC, "start")
    firsts = named.groupBy("len", "r1", "r2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("cnt")).filter("cnt > 1").drop("cnt")
    later = named.join(firsts, ["len", "r1", "r2"]).filter(~place.eqNullSafe(F.col("first")))
    stops = later.groupBy(*_DOC, "start").agg(F.max(F.col("start") + F.col("len") - 1).alias("stop")).withColumnRenamed("start", "pos")
    order = Window.partitionBy(*_DOC).orderBy("pos")
    covered = rows.select(*_DOC, "pos").join(stops, [*_DOC, "pos"], "left").withColumn("stop", F.max("stop").over(order)).filter("stop >= pos")
    covered = covered.withColumn("cut", F.col("pos") - F.row_number().over(order))
    cuts = covered.groupBy(*_DOC, "cut").agg(F.min("pos").alias("a"), F.max("pos").alias("b"))
    return cuts.groupBy(*_DOC).agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("cuts"))


def without_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``, and two more columns:
    ``_cuts`` (deleted line intervals, null if none) and ``_lines`` (lines before)."""
    cuts = written(later_lines(docs, min_words), "cuts").select(F.col("_d1").alias("_c1"), F.col("_d2").alias("_c2"), F.col("cuts").alias("_cuts"))
    keyed = with_key(docs)
    # One plan at every size: the table of cuts grows with the corpus and is never broadcast.
    joined = keyed.join(cuts.hint("merge"), (keyed["_d1"] == cuts["_c1"]) & (keyed["_d2"] == cuts["_c2"]), "left").drop("_c1", "_c2", *_DOC)
    lines = split_lines("text")
    starts = F.concat(F.array(F.lit(0)), F.transform("_cuts", lambda c: c["b"] + 1))
    stops = F.concat(F.transform("_cuts", lambda c: c["a"]), F.array(F.size(lines)))
    kept = F.flatten(F.zip_with(starts, stops, lambda a, b: F.slice(lines, a + 1, b - a)))
    text = F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("_lines", F.coalesce(F.size(lines), F.lit(0))).withColumn("text", text)


def report(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """doc_id, n_lines, n_deleted, cuts (``a-b`` intervals, comma-joined) and kept_md5 of every row."""
    done = without_repeats(docs.select("doc_id", "text"), min_words)
    deleted = F.coalesce(F.aggregate("_cuts", F.lit(0), lambda n, c: n + c["b"] - c["a"] + 1), F.lit(0))
    shown = F.coalesce(F.array_join(F.transform("_cuts", lambda c: F.concat_ws("-", c["a"], c["b"])), ","), F.lit(""))
    return done.select("doc_id", F.greatest(F.lit(0), F.col("_lines")).cast("bigint").alias("n_lines"), deleted.cast("bigint").alias("n_deleted"),
                       shown.alias("cuts"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("kept_md5"))


def deduplicated(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` with repeats deleted; documents of which no line is left go."""
    done = without_repeats(folded(docs, "doc_id", "text"), min_words)
    lines = F.coalesce(F.aggregate("_cuts", F.lit(0), lambda n, c: n + c["b"] - c["a"] + 1), F.lit(0))
    left = done.filter(F.col("_cuts").isNull() | (lines < F.col("_lines")))
    return unfolded(left, docs.columns, "doc_id", "text")
