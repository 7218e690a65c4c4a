"""JSON scoring requests in, JSON responses out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions import text as T

REQUEST_SCHEMA = "text string, speed string"
# Fixed value: speed of a request that names none.
DEFAULT_SPEED = "slow"


def parse_requests(raw: DataFrame, json_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``. A request without a text of at least 20 characters is rejected."""
    body = raw.withColumn("_r", F.from_json(json_col, REQUEST_SCHEMA))
    ok = F.coalesce(F.length("_r.text") >= T.MIN_REQUEST_CHARS, F.lit(False))
    keep = [c for c in raw.columns if c != json_col]
    accepted = body.filter(ok).select(
        *keep, F.col("_r.text").alias("text"),
        F.coalesce("_r.speed", F.lit(DEFAULT_SPEED)).alias("speed"),
    )
    return accepted, body.filter(~ok).drop("_r")


def response_json() -> Column:
    """JSON text of one prediction row; probabilities carry 3 decimals, coordinates 4."""
    def tier(name: str) -> Column:
        return F.struct(
            F.col(f"{name}.label").alias("label"),
            F.transform_values(f"{name}.probabilities", lambda _, v: F.round(v, 3)).alias("probabilities"),
        )

    return F.to_json(F.struct(
        F.col("svm_label"),
        tier("tier1").alias("nn_tier1"),
        tier("tier2").alias("nn_tier2"),
        F.col("cluster").alias("kmeans_cluster"),
        F.round("pca_x", 4).alias("pca_x"),
        F.round("pca_y", 4).alias("pca_y"),
    ))


def render_responses(predictions: DataFrame, id_col: str = "id") -> DataFrame:
    return predictions.select(id_col, response_json().alias("value"))
