"""Evaluation on shifted windows of the same books, as tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions import probs as P
from windrow.functions import text as T
from windrow.operators import balance, clustering
from windrow.operators import metrics as M
from windrow.plans.engine import Engine
from windrow.scale import share
from windrow.sources.documents import ingest


def scatter_table(points: DataFrame, centers: DataFrame, names: DataFrame) -> DataFrame:
    """``(kind, id, cluster, name, x, y)``: projected points and, below them, the centroids.

    ``names(cluster, name)`` has one row per cluster in use; a cluster without points keeps
    a plain name. A column ``silhouette`` of the points is kept; centroids have none.
    """
    lookup = F.broadcast(names)
    more = [c for c in points.columns if c == "silhouette"]
    dots = points.join(lookup, "cluster").select(
        F.lit("point").alias("kind"), F.col("id").cast("string").alias("id"), "cluster", "name", "x", "y", *more
    )
    spots = centers.join(lookup, "cluster", "left").select(
        F.lit("centroid").alias("kind"), F.col("cluster").cast("string").alias("id"), "cluster",
        F.coalesce("name", F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))).alias("name"),
        "x", "y",
    )
    return dots.unionByName(spots, allowMissingColumns=True)


@dataclass
class Evaluation:
    """Named result tables of one evaluation run."""

    confusion: DataFrame
    report: DataFrame
    clusters: DataFrame
    scatter: DataFrame
    edge_cases: DataFrame


def scored_windows(
    engine: Engine, books: DataFrame, catalog: DataFrame, taxonomy: DataFrame,
    quota: int = balance.EVAL_QUOTA, offset: int = T.SHIFT_WORDS,
) -> DataFrame:
    """The balanced shifted windows with their vectors (``sparse``) and all outputs of the engine's models."""
    size, books = engine.params.chunk_words, ingest(books)
    counts = balance.counts_until_full(books, catalog, quota, size, offset)
    corpus = balance.balanced(books, counts, taxonomy, quota, size, offset)
    return engine.raw_scores(engine.vectors(corpus).withColumn("sparse", F.struct("idx", "val")))


def silhouette_points(raw: DataFrame, engine: Engine) -> DataFrame:
    """``(id, cluster, x, y, silhouette)`` of every scored window."""
    sparse = raw.select(F.col("chunk_id").alias("id"), F.col("km_slow").alias("cluster"),
                        F.col("pca_x").alias("x"), F.col("pca_y").alias("y"), "sparse.idx", "sparse.val")
    return clustering.silhouette_rows(sparse, engine.tfidf.width)


def evaluate(
    engine: Engine, books: DataFrame, catalog: DataFrame, taxonomy: DataFrame,
    quota: int = balance.EVAL_QUOTA, offset: int = T.SHIFT_WORDS,
) -> Evaluation:
    """Score shifted windows with the fitted models.

    The training vocabulary is used as it is. School predictions are the plain arg-max of the
    network's logits: the branch mask is not applied here.
    """
    lab = engine.labels
    raw = share(
        scored_windows(engine, books, catalog, taxonomy, quota, offset)
        .withColumn("mlp_t1", P.argmax("z1")).withColumn("mlp_t2", P.argmax("z2"))
    )
    runs = [("svm_fast", "t1_idx", "svm_fast"), ("svm_slow", "t1_idx", "svm_slow"),
            ("mlp_t1", "t1_idx", "mlp_t1"), ("mlp_t2", "t2_idx", "mlp_t2")]
    # All four runs in one scan; the counts are as many as there are pairs of labels.
    cases = F.explode(F.array(*[
        F.struct(F.lit(model).alias("model"), F.col(y).cast("int").alias("y_true"), F.col(p).cast("int").alias("y_pred")) for model, y, p in runs]))
    confusion = share(raw.select(cases.alias("r")).select("r.*").groupBy("model", "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n")))
    report = M.report_of(M.class_scores(confusion, by=["model"]), by=["model"])

    spark = books.sparkSession
    points = share(silhouette_points(raw, engine))
    silhouette = ("silhouette_sq", points.agg(F.avg("silhouette")).first()[0])
    both = _entropy_scores(raw)
    scores = [silhouette, ("homogeneity", both["homogeneity"]), ("completeness", both["completeness"])]
    clusters = spark.createDataFrame(scores, "metric string, value double")

    majority = clustering.cluster_majority(raw, "km_slow", "t2_idx")
    names = majority.select(F.col("km_slow").alias("cluster"), P.label_at(lab.t2, "majority").alias("name"))
    spots = engine.cluster_meta(spark).select("cluster", "x", "y")
    wrong = raw.select(
        "t2_idx", "seq", "source_id", "pos", "text",
        F.col("t1_idx").alias("y_true"), F.col("svm_slow").alias("y_pred"),
        P.label_at(lab.t1, "t1_idx").alias("true_class"), P.label_at(lab.t1, "svm_slow").alias("predicted"),
    )
    return Evaluation(
        confusion, report, clusters, scatter_table(points, spots, names),
        M.edge_cases(wrong, ["t2_idx", "seq", "source_id", "pos"]),
    )


def _entropy_scores(raw: DataFrame):
    return clustering.homogeneity_completeness(raw, "t2_idx", "km_slow").first()
