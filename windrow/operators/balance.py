"""Ordered quota fill, exact class parity, and the audit of both.

Count first, build later: windows are counted per source (no text is carried), running
totals decide which windows of which sources are wanted, and only those are cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions import text as T
from windrow.operators.chunking import chunk_counts, window_at
from windrow.operators.ordering import running_before
from windrow.scale import BROADCAST_ROWS, broadcast_if, share

# Windows wanted per class in training and in evaluation.
QUOTA = 2_500
EVAL_QUOTA = 100


def source_counts(
    docs: DataFrame, catalog: DataFrame, size: int = T.CHUNK_WORDS, offset: int = 0
) -> DataFrame:
    """``(t2, seq, source_id, n)`` of every readable catalogued source.

    Several later steps read this narrow table: pass it through ``scale.share`` first.
    """
    n = chunk_counts(docs, size=size, offset=offset)
    return catalog.select("t2", "seq", "source_id").join(n, "source_id")


def within(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """``docs`` limited to the id range of ``sources``.

    The two border ids become literals, so they reach the scan and skip the parquet row
    groups outside; the exact selection stays with the join that follows.
    """
    ends = sources.agg(F.min("source_id").alias("low"), F.max("source_id").alias("high")).first()
    if ends["low"] is None:
        return docs.limit(0)
    return docs.filter(F.col("source_id").between(ends["low"], ends["high"]))


def counts_until_full(
    docs: DataFrame, catalog: DataFrame, quota: int = QUOTA, size: int = T.CHUNK_WORDS,
    offset: int = 0, first: int | None = None, growth: int = 16,
) -> DataFrame:
    """Shared :func:`source_counts` of as many leading sources as the quota needs.

    Sources are read in catalogue order until every class has its quota or has no source
    left: first ``first`` positions per class, then ``growth`` times as many, and so on. What
    is left out could not be taken anyway, so fill, parity and audit are the same as with all
    sources, while a quota that is small next to the data reads little of it.
    """
    reach = max(1, first or quota)
    longest = catalog.agg(F.max("seq").alias("m")).first()["m"] or 0
    while longest > reach:
        part = catalog.filter(F.col("seq") <= reach)
        counts = share(source_counts(within(docs, part), part, size, offset))
        pools = counts.groupBy("t2").agg(F.sum("n").alias("total"))
        unfinished = catalog.groupBy("t2").agg(F.max("seq").alias("last")).join(pools, "t2", "left").filter(
            (F.col("last") > reach) & (F.coalesce("total", F.lit(0)) < quota)
        )
        if unfinished.isEmpty():
            return counts
        counts.unpersist()
        reach *= growth
    return share(source_counts(docs, catalog, size, offset))


def progress(counts: DataFrame, quota: int = QUOTA) -> DataFrame:
    """Per source visited before the class is full: windows taken and running total."""
    before = running_before(counts, "t2", ["seq", "source_id"], "n", "start", limit=quota)
    taken = F.least(F.col("n").cast("bigint"), F.lit(quota) - F.col("start"))
    return before.select(
        "t2", "seq", "source_id", taken.alias("taken"), (F.col("start") + taken).alias("pool_size")
    )


def pool_sizes(counts: DataFrame, taxonomy: DataFrame, quota: int = QUOTA) -> DataFrame:
    """``(t1_idx, t1, t2_idx, t2, n)``; a class without windows counts 0."""
    totals = counts.groupBy("t2").agg(F.sum("n").alias("_n"))
    return taxonomy.join(totals, "t2", "left").select(
        "t1_idx", "t1", "t2_idx", "t2", F.least(F.coalesce("_n", F.lit(0)), F.lit(quota)).alias("n")
    )


def parity_size(counts: DataFrame, taxonomy: DataFrame, quota: int = QUOTA) -> DataFrame:
    """One row, ``final_quota``: the smallest pool over all classes, empty ones included."""
    return pool_sizes(counts, taxonomy, quota).agg(F.min("n").alias("final_quota"))


def take_windows(
    docs: DataFrame,
    counts: DataFrame,
    taxonomy: DataFrame,
    limit: int,
    size: int = T.CHUNK_WORDS,
    offset: int = 0,
) -> DataFrame:
    """The first ``limit`` windows of every class in catalogue order, with codes.

    Every wanted source gives at least one window, so there are at most
    ``limit * classes`` of them: that bound decides about broadcasting.
    """
    classes = taxonomy.count()
    wanted = (
        running_before(counts.filter("n > 0"), "t2", ["seq", "source_id"], "n", "start", limit=limit)
        .join(F.broadcast(taxonomy.select("t2", "t2_idx", "t1_idx")), "t2")
        .select(
            "source_id", "seq", "t1_idx", "t2_idx",
            F.least(F.col("n").cast("bigint"), F.lit(limit) - F.col("start")).cast("int").alias("take"),
        )
    )
    docs = docs.select("source_id", "text")
    if limit * classes <= BROADCAST_ROWS:
        wanted = share(wanted)
        docs = within(docs, wanted)
    cut = docs.join(broadcast_if(wanted, limit * classes), "source_id")
    cut = cut.withColumn("_w", T.shifted(T.words("text"), offset)).drop("text")
    windows = F.transform(
        F.sequence(F.lit(0), F.col("take") - 1), lambda i: window_at(F.col("_w"), i, size)
    )
    return cut.select(
        "t1_idx", "t2_idx", "seq", "source_id", F.posexplode(windows).alias("pos", "text")
    ).select(
        F.concat_ws("-", "t2_idx", "source_id", "pos").alias("chunk_id"),
        "t1_idx", "t2_idx", "seq", "source_id", "pos", "text",
    )


def quota_fill(docs, counts, taxonomy, quota: int = QUOTA, size=T.CHUNK_WORDS, offset: int = 0):
    """Every class filled in source order, then position order, up to ``quota`` windows."""
    return take_windows(docs, counts, taxonomy, quota, size, offset)


def balanced(docs, counts, taxonomy, quota: int = QUOTA, size=T.CHUNK_WORDS, offset: int = 0):
    """Quota fill cut to the smallest class; the first windows of every class are kept.

    The parity size is one number and is fixed before the windows are cut. An empty class
    makes the whole result empty, as the parity rule says.
    """
    limit = parity_size(counts, taxonomy, quota).first()["final_quota"]
    return take_windows(docs, counts, taxonomy, int(limit), size, offset)


def audit_table(pools: DataFrame, quota: int = QUOTA) -> DataFrame:
    """Counts after parity per class plus a TOTAL row, with status and target note.

    ``pools`` is the output of :func:`pool_sizes`.
    """
    smallest = pools.agg(F.min("n").alias("q")).scalar()
    rows = pools.withColumn("final_quota", smallest).withColumn("n", F.least("n", "final_quota"))
    # Note and status texts of the audit.
    note = F.when(
        F.col("final_quota") < quota, F.concat(F.lit("DEGRADED to "), F.col("final_quota").cast("string"))
    ).otherwise(F.concat(F.lit("TARGET MET: "), F.col("final_quota").cast("string")))
    summed = rows.rollup("t2_idx", "t2", "t1").agg(
        F.sum("n").alias("n"),
        F.max("final_quota").alias("final_quota"),
        F.count(F.lit(1)).alias("classes"),
        F.grouping_id().alias("level"),
    ).filter("level in (0, 7)")
    expected = F.when(F.col("level") == 0, F.col("final_quota")).otherwise(
        F.col("final_quota") * F.col("classes")
    )
    return summed.select(
        F.coalesce("t2_idx", F.lit(-1)).alias("t2_idx"),
        F.coalesce("t2", F.lit("TOTAL")).alias("t2"),
        F.when(F.col("level") == 0, F.coalesce("t1", F.lit("?"))).otherwise("").alias("t1"),
        F.col("n").cast("bigint").alias("n"),
        expected.cast("bigint").alias("expected"),
        F.when(F.col("n") == expected, F.lit("OK"))
        .otherwise(F.concat(F.lit("WARN "), F.col("n").cast("string")))
        .alias("status"),
        note.alias("note"),
    )
