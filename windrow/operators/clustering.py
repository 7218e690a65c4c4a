"""Cluster assignment and cluster quality as tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from windrow.models.numeric import Rows, sum_over_rows
from windrow.scale import ship


def group_means(df: DataFrame, vec: str, group: str) -> DataFrame:
    """``(group, center)``: mean vector of every group, combined on the map side."""
    return (
        df.select(group, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
        .groupBy(group)
        .agg(Summarizer.mean(F.col("_v")).alias("_m"))
        .select(group, vector_to_array("_m").alias("center"))
    )


def nearest_centroid(df: DataFrame, vec: str, centers: list[tuple[int, list[float]]]) -> DataFrame:
    """Add ``cluster`` and ``dist2`` of the closest of a few centres (a fitted model's size).

    Works per Arrow batch: one small matrix product, no row pairs, no shuffle. Ties go to
    the first centre.
    """
    ship(df.sparkSession)
    ids = np.array([c for c, _ in centers], dtype=np.int32)
    mat = np.array([v for _, v in centers], dtype=np.float64)

    @F.pandas_udf("struct<cluster:int,dist2:double>")
    def assign(v: pd.Series) -> pd.DataFrame:
        if len(v) == 0:
            return pd.DataFrame({"cluster": np.zeros(0, np.int32), "dist2": np.zeros(0)})
        x = np.stack(v.to_numpy()).astype(np.float64)
        d = np.stack([((x - c) ** 2).sum(axis=1) for c in mat], axis=1)
        best = d.argmin(axis=1)
        return pd.DataFrame({"cluster": ids[best], "dist2": d[np.arange(len(x)), best]})

    got = assign(F.col(vec).cast("array<double>"))
    return df.withColumn("_a", got).select(
        *df.columns, F.col("_a.cluster").alias("cluster"), F.col("_a.dist2").alias("dist2")
    )


def inertia(assigned: DataFrame) -> DataFrame:
    """One row: within-cluster sum of squares and number of clusters in use."""
    return assigned.agg(
        F.sum("dist2").alias("inertia"), F.count_distinct("cluster").alias("n_clusters")
    )


def cluster_majority(df: DataFrame, cluster: str = "cluster", label: str = "y_true") -> DataFrame:
    """Most frequent label of every cluster; on a tie the lowest code.

    Two counting steps, so a huge cluster is combined before it meets one task.
    """
    pairs = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(cluster).agg(
        F.max_by(F.col(label), F.struct(F.col("n"), -F.col(label))).alias("majority")
    )


def homogeneity_completeness(df: DataFrame, label: str = "y_true", cluster: str = "cluster") -> DataFrame:
    """One row: both entropy scores. One class (or one cluster) scores 1."""
    cells = df.groupBy(F.col(label).alias("c"), F.col(cluster).alias("k")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rows = cells.groupBy("c").agg(F.sum("n").alias("nc"))
    cols = cells.groupBy("k").agg(F.sum("n").alias("nk"))
    total = cells.agg(F.sum("n").alias("t")).scalar()

    def entropy(side: DataFrame, size: str) -> Column:
        share = F.col(size) / total
        return side.agg(F.sum(-share * F.log(share)).alias("h")).scalar()

    joint = cells.join(rows, "c").join(cols, "k").withColumn("_s", F.col("n") / total)
    one = joint.agg(
        F.sum(-F.col("_s") * F.log(F.col("n") / F.col("nk"))).alias("h_ck"),
        F.sum(-F.col("_s") * F.log(F.col("n") / F.col("nc"))).alias("h_kc"),
    ).select("*", entropy(rows, "nc").alias("h_c"), entropy(cols, "nk").alias("h_k"))
    return one.select(
        F.when(F.col("h_c") == 0, 1.0).otherwise(1 - F.col("h_ck") / F.col("h_c")).alias("homogeneity"),
        F.when(F.col("h_k") == 0, 1.0).otherwise(1 - F.col("h_kc") / F.col("h_k")).alias("completeness"),
    )


def silhouette_squared(df: DataFrame, vec: str, cluster: str = "cluster") -> float:
    """Mean silhouette with squared Euclidean distance; linear in rows, no row pairs.

    ``vec`` is an array column or an ML vector column.
    """
    ready_made = isinstance(df.schema[vec].dataType, VectorUDT)
    features = F.col(vec) if ready_made else array_to_vector(F.col(vec).cast("array<double>"))
    ready = df.select(features.alias("features"), F.col(cluster).cast("double").alias("prediction"))
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(ready)


def sparse_form(df: DataFrame, vec: str) -> DataFrame:
    """``df`` with the array column ``vec`` as sparse columns ``idx`` and ``val``."""
    return df.withColumn("idx", F.sequence(F.lit(0), F.size(vec) - 1)).withColumnRenamed(vec, "val")


def silhouette_rows(df: DataFrame, width: int, cluster: str = "cluster") -> DataFrame:
    """Add ``silhouette`` (squared Euclidean) to every row with ``idx``, ``val`` and a cluster code.

    Count, sum and sum of squares of each cluster give a row's mean squared distance to every
    cluster, so two linear passes do: one small partial per task, then a narrow step with a matrix
    product per batch. ``idx`` and ``val`` are dropped. Rows without a cluster or a vector get null,
    rows of a cluster of one, or of the only cluster, 0.
    """
    spark, given = df.sparkSession, F.col(cluster).isNotNull() & F.col("idx").isNotNull()
    ship(spark)
    known = sorted((int(r[0]), r[1]) for r in df.filter(given).groupBy(cluster).count().collect())
    codes, sizes = np.array([c for c, _ in known], dtype=np.int64), np.array([n for _, n in known], dtype=np.float64)
    k = len(codes)

    def sums(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        rows = Rows.from_arrow(batch)
        member = np.equal.outer(batch.column(0).to_numpy(zero_copy_only=False), codes).astype(np.float64)
        return {"sum": rows.transposed_dot(member, width).T, "square": rows.squared_norms() @ member}

    total = {"sum": np.zeros((0, width)), "square": np.zeros(0)}
    if k:
        rows = df.filter(given).select(F.col(cluster).cast("bigint").alias("_c"), "idx", "val")
        total = sum_over_rows(rows, ["_c", "idx", "val"], sums, {"sum": (k, width), "square": (k,)}, rows.rdd.getNumPartitions())
    stats = spark.sparkContext.broadcast((np.ascontiguousarray((total["sum"] / sizes[:, None]).T), total["square"] / sizes))
    keep = [c for c in df.columns if c not in ("idx", "val")]

    def run(batches):
        means, squares = stats.value
        for b in batches:
            code = b.column(b.schema.get_field_index(cluster))
            ok = np.asarray(pc.and_(code.is_valid(), b.column(b.schema.get_field_index("idx")).is_valid()))
            out, at = np.full(b.num_rows, np.nan), np.flatnonzero(ok)
            if len(at):
                some = b.take(pa.array(at))
                rows = Rows.from_arrow(some)
                own = np.searchsorted(codes, some.column(some.schema.get_field_index(cluster)).to_numpy(zero_copy_only=False))
                out[at] = _silhouettes(rows.squared_norms()[:, None] + squares - 2 * rows.dot(means), own, sizes)
            kept = [b.column(b.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, mask=~ok)], names=[*keep, "silhouette"])

    target = StructType([df.schema[c] for c in keep] + [StructField("silhouette", DoubleType())])
    return df.withColumn("idx", F.col("idx").cast("array<int>")).withColumn("val", F.col("val").cast("array<double>")).mapInArrow(run, target)


def _silhouettes(far: np.ndarray, own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Silhouettes from mean squared distances to every cluster, the own one with the row itself in it."""
    at, n = np.arange(len(own)), sizes[own]
    a = far[at, own] * n / np.maximum(n - 1, 1)
    far[at, own] = np.inf
    b = far.min(axis=1)
    top = np.maximum(a, b)
    good = (n > 1) & np.isfinite(b) & (top > 0)
    return np.where(good, (np.where(good, b, 0.0) - a) / np.where(good, top, 1.0), 0.0)
