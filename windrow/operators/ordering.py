"""Numbering and running totals inside ordered groups, safe for very large groups.

A plain window puts a whole group into one task. Here a group is first cut into ordered
ranges; ranges are totalled (a small table), and only the inside of one range is windowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of one group that one task may window over.
RANGE_ROWS = 1 << 16
# Ranges cut at once; a group of more than GRID * RANGE_ROWS rows is cut in several levels.
GRID = 256


def number_in_group(df: DataFrame, group: str, order: str, out: str = "seq", level: int = 0) -> DataFrame:
    """Add ``out`` = 1, 2, 3, ... by ``order`` inside every ``group``.

    ``order`` is a numeric key that is unique inside its group. Range borders come from one
    narrow quantile pass and are fixed before use, so a recomputed task sees the same borders.
    """
    fractions = [i / GRID for i in range(1, GRID)]
    stats = (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(order, fractions, 10000).alias("q"))
        .collect()
    )
    borders = []
    for row in stats:
        parts = min(GRID, max(1, row["n"] // RANGE_ROWS + 1))
        picks = sorted({row["q"][(i * GRID) // parts - 1] for i in range(1, parts)})
        borders.append((row[group], picks))
    if all(not picks for _, picks in borders):
        whole = Window.partitionBy(group).orderBy(order)
        return df.withColumn(out, F.row_number().over(whole).cast("bigint"))

    kind = df.schema[group].dataType.simpleString()
    key = df.schema[order].dataType.simpleString()
    fixed = df.sparkSession.createDataFrame(borders, f"`{group}` {kind}, _cuts array<{key}>")
    ranged = df.join(F.broadcast(fixed), group).withColumn(
        "_range", F.size(F.filter("_cuts", lambda b: b < F.col(order))).cast("bigint")
    ).drop("_cuts")
    if max(row["n"] for row in stats) <= GRID * RANGE_ROWS:
        return _running(ranged, group, [order], F.lit(1), out, inclusive=True)
    # Ranges of a very large group are still large: number inside each range the same way, then
    # add what comes before the range.
    totals = ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(group, "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    cell, outer, inside = f"_cell{level}", f"_range{level}", f"_inside{level}"
    cells = ranged.withColumn(cell, F.to_json(F.struct(F.col(group), F.col("_range")))).withColumnRenamed("_range", outer)
    inner = number_in_group(cells, cell, order, inside, level + 1)
    numbered = inner.join(base.withColumnRenamed("_range", outer), [group, outer])
    return numbered.withColumn(out, F.col("_base") + F.col(inside)).select(*df.columns, out)


def running_before(
    df: DataFrame, group: str, order: list[str], value: str, out: str, limit=None
) -> DataFrame:
    """Add ``out`` = total of ``value`` over the rows of the group that come earlier.

    ``order[0]`` is a dense position (1, 2, 3, ...), so ``order[0] div RANGE_ROWS`` are even
    ranges. With ``limit`` only rows whose total before is below it are kept, and ranges that
    start beyond it are dropped before anything is sorted.
    """
    ranged = df.withColumn("_range", F.floor(F.col(order[0]) / RANGE_ROWS))
    return _running(ranged, group, order, F.col(value), out, inclusive=False, limit=limit)


def _running(ranged, group, order, value, out, inclusive, limit=None):
    totals = ranged.groupBy(group, "_range").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        group, "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base")
    )
    if limit is not None:
        base = base.filter(F.col("_base") < limit)
    inside = Window.partitionBy(group, "_range").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    run = F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("_base")
    done = (
        ranged.join(base, [group, "_range"])
        .withColumn(out, run.cast("bigint"))
        .drop("_base", "_range")
    )
    return done if limit is None else done.filter(F.col(out) < limit)
