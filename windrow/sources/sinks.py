"""Writers of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_edge_cases(cases: DataFrame, path: str) -> None:
    """Text lines of the (at most a few) listed errors; a note when there is none."""
    # Layout of an entry and the note of an empty list.
    line = F.concat(
        F.lit("TRUE CLASS: "), "true_class", F.lit(" | PREDICTED: "), "predicted",
        F.lit('\nTEXT: "'), "preview", F.lit('"\n' + "-" * 50),
    )
    lines = cases.select(line.alias("value"))
    if lines.isEmpty():
        lines = cases.sparkSession.range(1).select(F.lit("No errors found in this sample!").alias("value"))
    lines.coalesce(1).write.mode("overwrite").text(path)


def append_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """The rows of one training run in the metrics history; a run written again replaces its rows."""
    keyed = metrics.withColumn("run_id", F.lit(run_id))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def write_run(rows: DataFrame, path: str, run_id: str) -> DataFrame:
    """``rows`` as the run's folder of a table that ``run_id`` partitions, and read back from there.

    A run written again replaces its folder, also by no rows.
    """
    folder = f"{path}/run_id={run_id}"
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
