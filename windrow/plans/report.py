"""Metrics of several models in one pass over the scored rows."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.models.svm import predict_svm
from windrow.operators.metrics import class_scores, macro_of
from windrow.operators.sampling import fast_subset
from windrow.scale import share


def run_stamp(moment: datetime | None = None) -> str:
    """Minute-precise UTC text of a run's time; a naive time is taken as UTC."""
    return (moment or datetime.now(UTC)).strftime("%Y-%m-%d %H:%M UTC")


def by_mode(mode: str, fast, slow):
    """``fast`` for the mode named "fast"; any other value, null included, takes ``slow``."""
    return F.when(F.col(mode) == "fast", fast).otherwise(slow)


def classifier_metrics(scored: DataFrame, y: str, predictions: dict[str, str]) -> DataFrame:
    """Long ``(model, metric, value)`` of several prediction columns, one scan and one shuffle."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(c).alias("y_pred")) for m, c in predictions.items()
    ]))
    confusion = (
        scored.select(F.col(y).alias("y_true"), pairs.alias("p"))
        .select("y_true", "p.*")
        .groupBy("model", "y_true", "y_pred")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    wide = macro_of(class_scores(confusion, by=["model"]), by=["model"])
    return _long(wide, ["accuracy", "precision", "recall", "f1_macro"])


def cluster_metrics(assigned: DataFrame, models: dict[str, tuple[str, str, str | None]]) -> DataFrame:
    """Long metrics of several clusterings, one scan.

    ``models`` gives per model the cluster column, the squared-distance column and the boolean
    column of the rows the model was fitted on (None: all). Inertia is that of the fit rows;
    the number of clusters in use is counted over all rows.
    """
    cells = F.explode(F.array(*[
        F.struct(
            F.lit(m).alias("model"), F.col(c).alias("cluster"),
            (F.col(d) if fit is None else F.when(F.col(fit), F.col(d))).alias("d2"),
        )
        for m, (c, d, fit) in models.items()
    ]))
    wide = (
        assigned.select(cells.alias("c")).select("c.*")
        .groupBy("model", "cluster").agg(F.sum("d2").alias("d2"))
        .groupBy("model").agg(
            F.round(F.sum("d2"), 2).alias("inertia"),
            F.count(F.lit(1)).cast("double").alias("n_clusters"),
        )
    )
    return _long(wide, ["inertia", "n_clusters"])


def metrics_report(parts: list[DataFrame], run_ts: str, n_rows) -> DataFrame:
    """``metrics(model, metric, value, run_ts, n)`` of one training run.

    ``run_ts`` is the rendered UTC time; ``n_rows`` a number or a scalar column.
    """
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    n = n_rows if not isinstance(n_rows, int) else F.lit(n_rows).cast("bigint")
    return out.select("model", "metric", "value", F.lit(run_ts).alias("run_ts"), n.alias("n"))


def _long(wide: DataFrame, metrics: list[str]) -> DataFrame:
    return wide.unpivot(["model"], metrics, "metric", "value")


def engine_metrics(engine, vectors: DataFrame, run_ts: str) -> DataFrame:
    """Metrics of both SVMs and both K-Means models over the whole training set.

    Support rows of an SVM are those with a pairwise margin of at most 1. Inertia is the cost
    on the rows a model was fitted on; clusters in use are counted over all rows.
    """
    scored = engine.raw_scores(vectors.withColumnRenamed("t1_idx", "y_true"))
    one = scored.select("y_true", "svm_slow", "svm_fast", "km_slow", "km_fast")
    shared = share(one)
    classes = classifier_metrics(shared, "y_true", {"svm_slow": "svm_slow", "svm_fast": "svm_fast"})
    use = shared.agg(
        F.count_distinct("km_slow").alias("slow"), F.count_distinct("km_fast").alias("fast"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    spark = vectors.sparkSession
    rest = spark.createDataFrame([
        ("kmeans_slow", "inertia", round(engine.kmeans_slow.cost, 2)),
        ("kmeans_fast", "inertia", round(engine.kmeans_fast.cost, 2)),
        ("kmeans_slow", "n_clusters", float(use["slow"])),
        ("kmeans_fast", "n_clusters", float(use["fast"])),
        ("svm_slow", "n_margin_rows", float(margin_rows(engine.svm_slow, vectors))),
        ("svm_fast", "n_margin_rows", float(margin_rows(
            engine.svm_fast, fast_subset(vectors, "chunk_id", engine.params.seed)))),
    ], "model string, metric string, value double")
    return metrics_report([classes, rest], run_ts, int(use["n"]))


def margin_rows(model, vectors: DataFrame) -> int:
    """Rows of a fit set that lie on or inside a margin of one of their class pairs."""
    rows = vectors.select(F.col("t1_idx").alias("y_true"), "idx", "val")
    return predict_svm(rows, model).filter("margin_row").count()
