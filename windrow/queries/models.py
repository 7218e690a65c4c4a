"""Queries over fitted models.

A fitted weight has no SQL form. Each query therefore returns what SQL can work out from the
tables (ids, counts, sums) next to flags, all computed from the models' output over whole tables.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.models import pca as PCA
from windrow.models.svm import predict_svm
from windrow.operators import balance
from windrow.operators.metrics import macro_metrics
from windrow.plans import engine as E
from windrow.plans.evaluate import evaluate, scored_windows, silhouette_points
from windrow.plans.report import engine_metrics
from windrow.plans.train import train
from windrow.queries import corpus as C
from windrow.queries import roles as R
from windrow.scale import checkpoint_dir, share
from windrow.sources import artifacts
from windrow.sources.requests import parse_requests
from windrow.streaming import scoring

QUERIES, ORACLES = {}, {}
_built: dict[tuple, tuple] = {}

_CORPUS = f"corpus AS ({C.ORACLES['balance_parity']})"
_PAIRS = "(SELECT count(DISTINCT lang) * (count(DISTINCT lang) - 1) / 2 FROM documents)::DOUBLE"


def query(name: str, sql: str):
    def add(fn):
        QUERIES[name], ORACLES[name] = fn, sql
        return fn
    return add


def settings() -> E.Params:
    return E.Params(quota=R.QUOTA, stop_words=R.STOP_1, term_stop_words=R.STOP_2)


def engine_for(spark, sf, models=E.MODELS):
    """Engine and training vectors of one data folder, vectorised once per application; ``models`` are fitted if
    no query before has asked for them."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _built:
        lemmas = share(C.lemma_inputs(spark, sf)[1])
        _built[key] = E.build(R.books(spark, sf), share(R.catalog(spark, sf)), R.taxonomy(spark, sf), settings(), lemmas, models=models)
        lemmas.unpersist()
    E.fit_models(*_built[key], models)
    return _built[key]


def _sums_to_one(probabilities: str) -> Column:
    total = F.aggregate(F.map_values(probabilities), F.lit(0.0), lambda a, x: a + x)
    return F.abs(total - 1) < 1e-6


def _flags(spark, **flags: bool) -> DataFrame:
    return spark.createDataFrame([tuple(bool(v) for v in flags.values())], ", ".join(f"{k} boolean" for k in flags))


# Bytes up to which a source counts as unreadable here: too few for one window of words.
_SHORT = 190


@query("training_run", f"""WITH audit AS ({C.ORACLES['audit_table']}), progress AS ({C.ORACLES['ingest_progress']}),
pairs AS (SELECT m, x FROM (SELECT unnest(['svm_slow', 'svm_fast']) AS m), (SELECT unnest(['accuracy', 'precision', 'recall', 'f1_macro', 'n_margin_rows']) AS x)
  UNION ALL SELECT m, x FROM (SELECT unnest(['kmeans_slow', 'kmeans_fast']) AS m), (SELECT unnest(['inertia', 'n_clusters']) AS x))
SELECT 'audit' AS part, t2 AS key, n::BIGINT AS n FROM audit UNION ALL
SELECT 'progress', t2, sum(taken)::BIGINT FROM progress GROUP BY t2 UNION ALL
SELECT 'reject', doc_id::VARCHAR, 1 FROM documents WHERE coalesce(octet_length(encode(text)), 0) <= {_SHORT} UNION ALL
SELECT 'metric', m || '.' || x, (SELECT n FROM audit WHERE t2_idx = -1)::BIGINT FROM pairs""")
def training_run(spark, sf):
    """A whole run with short fits, from ranked copies in bytes (the better-ranked one is cut off)."""
    whole = R.books(spark, sf).select("source_id", F.lit(1).alias("copy"), F.encode("text", "UTF-8").alias("text"))
    cut = R.books(spark, sf).select("source_id", F.lit(0).alias("copy"), F.encode(F.substring("text", 1, 40), "UTF-8").alias("text"))
    short = replace(settings(), epochs=4, restarts=2, svm_features=128, kmeans_max_iter=50, pca_max_passes=20)
    folder = f"{checkpoint_dir(spark)}/training-{uuid.uuid4().hex}"
    run = train(whole.unionByName(cut), share(R.catalog(spark, sf)), R.taxonomy(spark, sf), folder, "run-1", short,
                candidate="copy", min_chars=_SHORT)
    run.vectors.unpersist()
    parts = [
        run.audit.select(F.lit("audit").alias("part"), F.col("t2").alias("key"), "n"),
        run.progress.groupBy("t2").agg(F.sum("taken").alias("n")).select(F.lit("progress").alias("part"), F.col("t2").alias("key"), "n"),
        run.rejects.select(F.lit("reject").alias("part"), F.col("source_id").cast("string").alias("key"), F.lit(1).cast("bigint").alias("n")),
        run.metrics.select(F.lit("metric").alias("part"), F.concat_ws(".", "model", "metric").alias("key"), "n"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("build_all", f"""WITH {_CORPUS}
SELECT 'rows' AS part, count(*)::DOUBLE AS value FROM corpus UNION ALL
SELECT unnest(['svm_slow_pairs', 'svm_fast_pairs']), {_PAIRS} UNION ALL
SELECT unnest(['kmeans_slow_clusters', 'kmeans_fast_clusters']), 7 UNION ALL
SELECT unnest(['vocabulary_in_bounds', 'loss_falls', 'ratios_ordered', 'fits_converged']), 1""")
def build_all(spark, sf):
    """Sizes of everything a full build fits, and whether the fits ended as they should."""
    e, vectors = engine_for(spark, sf)
    ratio = e.pca.ratio
    facts = [
        ("svm_slow_pairs", len(e.svm_slow.pairs)), ("svm_fast_pairs", len(e.svm_fast.pairs)),
        ("kmeans_slow_clusters", len(e.kmeans_slow.centers)), ("kmeans_fast_clusters", len(e.kmeans_fast.centers)),
        ("vocabulary_in_bounds", 0 < e.tfidf.width <= e.params.max_features),
        ("loss_falls", e.mlp.losses[-1] < e.mlp.losses[0]), ("ratios_ordered", 1 > ratio[0] >= ratio[1] > 0),
        ("fits_converged", all(m.converged for m in (e.svm_slow, e.svm_fast, e.kmeans_slow, e.kmeans_fast, e.pca))),
    ]
    rows = vectors.agg(F.lit("rows").alias("part"), F.count(F.lit(1)).cast("double").alias("value"))
    return rows.unionByName(spark.createDataFrame([(k, float(v)) for k, v in facts], "part string, value double"))


@query("svm_train", f"WITH {_CORPUS} SELECT count(*) AS rows, true AS accurate, true AS some_margin_rows FROM corpus")
def svm_train(spark, sf):
    """The branch SVM on its own training rows: accuracy above 0.8, margin rows a part of all."""
    engine, vectors = engine_for(spark, sf)
    scored = predict_svm(vectors.select(F.col("t1_idx").alias("y_true"), "idx", "val"), engine.svm_slow)
    n, right, margin = scored.agg(F.count(F.lit(1)), F.count_if(F.col("y_true") == F.col("y_pred")), F.count_if("margin_row")).first()
    macro = macro_metrics(scored).first()
    accurate = right / n > 0.8 and abs(macro["accuracy"] - round(right / n, 4)) < 1e-9
    return _flags(spark, accurate=accurate, some_margin_rows=0 < margin <= n).select(F.lit(n).cast("bigint").alias("rows"), "*")


@query("mlp_train", "SELECT true AS within_epochs, true AS loss_falls, true AS accurate")
def mlp_train(spark, sf):
    """The network: epochs within the limit, falling loss, branch accuracy above 0.8 on its rows."""
    engine, vectors = engine_for(spark, sf)
    losses = engine.mlp.losses
    raw = engine.raw_scores(vectors.select("chunk_id", "t1_idx", "idx", "val"))
    hit = raw.agg(F.avg((F.array_position("z1", F.array_max("z1")) - 1 == F.col("t1_idx")).cast("double"))).first()[0]
    return _flags(spark, within_epochs=0 < len(losses) <= engine.params.epochs, loss_falls=losses[-1] < losses[0], accurate=hit > 0.8)


@query("mlp_score", f"WITH {_CORPUS} SELECT chunk_id AS id, true AS sums_t1, true AS sums_t2, true AS school_is_likeliest FROM corpus")
def mlp_score(spark, sf):
    """Branch and masked school probabilities of every training row."""
    engine, vectors = engine_for(spark, sf)
    lab = engine.labels
    p = engine.predictions(engine.raw_scores(vectors.select("chunk_id", "idx", "val")), "chunk_id")
    best = F.array_max(F.map_values("tier2.probabilities"))
    known = F.col("tier2.label").isin(*lab.t2) & (F.element_at("tier2.probabilities", F.col("tier2.label")) == best)
    return p.select("id", _sums_to_one("tier1.probabilities").alias("sums_t1"), _sums_to_one("tier2.probabilities").alias("sums_t2"),
                    known.alias("school_is_likeliest"))


@query("kmeans_fit", "SELECT unnest(range(10))::INTEGER AS restart, true AS kept_is_least, true AS cost_is_assignments")
def kmeans_fit(spark, sf):
    """No restart costs less than the kept one, whose cost is that of the assignment."""
    engine, vectors = engine_for(spark, sf, ("kmeans_slow",))
    km = engine.kmeans_slow
    total = engine.raw_scores(vectors.select("chunk_id", "idx", "val")).agg(F.sum("km_slow_d2")).first()[0]
    same = abs(total - km.cost) <= 1e-4 * km.cost
    rows = [(i, bool(km.cost <= c), bool(same)) for i, c in enumerate(km.costs)]
    return spark.createDataFrame(rows, "restart int, kept_is_least boolean, cost_is_assignments boolean")


@query("pca_project", """WITH cells AS (
  SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS p FROM embeddings),
total AS (SELECT sum(s) AS t FROM (SELECT var_samp(v) AS s FROM cells GROUP BY p))
SELECT vec_id, (SELECT round(t, 4) FROM total) AS total_variance, true AS centred, true AS variances_match FROM embeddings""")
def pca_project(spark, sf):
    """Narrow input: every embedding on its two main components, and what their variances must be."""
    vecs = R.embeddings(spark, sf)
    model = PCA.fit_pca_narrow(vecs, "embedding")
    p = PCA.project(vecs, "embedding", model).select("vec_id", "pca_x", "pca_y")
    m = p.agg(F.avg("pca_x"), F.avg("pca_y"), F.var_samp("pca_x"), F.var_samp("pca_y")).first()
    total = float(model.variance[0] / model.ratio[0])
    match = all(abs(m[2 + i] - model.variance[i]) <= 1e-6 * total for i in range(2)) and m[2] >= m[3] > 0
    return p.select("vec_id", F.lit(round(total, 4)).alias("total_variance"), F.lit(abs(m[0]) + abs(m[1]) < 1e-9).alias("centred"),
                    F.lit(bool(match)).alias("variances_match"))


@query("pca_project_wide", f"WITH {_CORPUS} SELECT chunk_id, true AS centred, true AS ordered FROM corpus")
def pca_project_wide(spark, sf):
    """Wide sparse input: every training row on its two main components."""
    engine, vectors = engine_for(spark, sf)
    p = share(engine.raw_scores(vectors.select("chunk_id", "idx", "val")).select("chunk_id", "pca_x", "pca_y"))
    m = p.agg(F.avg("pca_x"), F.avg("pca_y"), F.var_samp("pca_x"), F.var_samp("pca_y")).first()
    return p.select("chunk_id", F.lit(abs(m[0]) + abs(m[1]) < 1e-6).alias("centred"), F.lit(m[2] >= m[3] > 0).alias("ordered"))


@query("fast_models", "SELECT true AS models_agree, true AS fast_is_accurate, true AS clusters_in_use")
def fast_models(spark, sf):
    """The models fitted on a quarter of the rows against the full ones."""
    engine, vectors = engine_for(spark, sf)
    raw = engine.raw_scores(vectors.select("chunk_id", "t1_idx", "idx", "val"))
    m = raw.agg(F.avg((F.col("svm_fast") == F.col("svm_slow")).cast("double")), F.avg((F.col("svm_fast") == F.col("t1_idx")).cast("double")),
                F.count_distinct("km_fast")).first()
    return _flags(spark, models_agree=m[0] > 0.7, fast_is_accurate=m[1] > 0.7, clusters_in_use=1 < m[2] <= engine.params.clusters)


@query("score_batch", "SELECT doc_id AS id, true AS sums_t1, true AS sums_t2, true AS known_labels, true AS known_cluster FROM documents")
def score_batch(spark, sf):
    """Every document scored as one passage, fast or slow as its request says."""
    engine, _ = engine_for(spark, sf)
    requests = R.books(spark, sf).withColumn("speed", F.when(F.col("source_id") % 3 == 0, "fast").otherwise("slow"))
    p = engine.score(requests, "source_id", mode_col="speed")
    known = F.col("svm_label").isin(*engine.labels.t1) & F.col("tier1.label").isin(*engine.labels.t1) & F.col("tier2.label").isin(*engine.labels.t2)
    return p.select("id", _sums_to_one("tier1.probabilities").alias("sums_t1"), _sums_to_one("tier2.probabilities").alias("sums_t2"),
                    known.alias("known_labels"), F.col("cluster").between(0, engine.params.clusters - 1).alias("known_cluster"))


@query("cluster_meta", "SELECT unnest(range(7))::INTEGER AS cluster, true AS in_taxonomy, true AS placed")
def cluster_meta(spark, sf):
    engine, _ = engine_for(spark, sf)
    known = F.col("t1").isin(*engine.labels.t1) & F.col("t2").isin(*engine.labels.t2)
    placed = ~F.isnan("x") & ~F.isnan("y") & F.col("x").isNotNull()
    return engine.cluster_meta(spark).select("cluster", known.alias("in_taxonomy"), placed.alias("placed"))


@query("engine_metrics", f"""WITH {_CORPUS}, names AS (
  SELECT m AS model, x AS metric FROM (SELECT unnest(['svm_slow', 'svm_fast']) AS m),
         (SELECT unnest(['accuracy', 'precision', 'recall', 'f1_macro', 'n_margin_rows']) AS x) UNION ALL
  SELECT m, x FROM (SELECT unnest(['kmeans_slow', 'kmeans_fast']) AS m), (SELECT unnest(['inertia', 'n_clusters']) AS x))
SELECT model, metric, (SELECT count(*) FROM corpus) AS n, true AS in_range FROM names""")
def metrics_of_engine(spark, sf):
    """Every metric of the four models, each inside its range."""
    engine, vectors = engine_for(spark, sf)
    m = engine_metrics(engine, vectors, "2024-01-01 00:00 UTC")
    share_like = F.col("metric").isin("accuracy", "precision", "recall", "f1_macro")
    fine = (F.when(share_like, F.col("value").between(0.5, 1)).when(F.col("metric") == "n_clusters", F.col("value").between(2, engine.params.clusters))
            .when(F.col("metric") == "n_margin_rows", F.col("value").between(1, F.col("n"))).otherwise(F.col("value") > 0))
    return m.select("model", "metric", "n", fine.alias("in_range"))


_SHIFTED = f"""WITH {R.TAXONOMY_CTE}, {R.CATALOG_CTE}, {R.chunks_cte(45)},
sizes AS (SELECT t1, t1_idx, t2, t2_idx, (SELECT min(least(n, {balance.EVAL_QUOTA})) FROM (
    SELECT count(c.pos) AS n FROM taxonomy t LEFT JOIN catalog g ON g.t2 = t.t2 LEFT JOIN chunks c ON c.source_id = g.source_id GROUP BY t.t2)) AS n
  FROM taxonomy)"""


@query("evaluate_suite", f"""{_SHIFTED}
SELECT m AS model, t1_idx AS label, sum(n)::BIGINT AS support, true AS report_matches FROM sizes, (SELECT unnest(['svm_fast', 'svm_slow', 'mlp_t1']) AS m)
GROUP BY ALL HAVING sum(n) > 0 UNION ALL
SELECT 'mlp_t2', t2_idx, n, true FROM sizes WHERE n > 0""")
def evaluate_suite(spark, sf):
    """Support of every class per model from the confusion counts; their recall equals the report's."""
    engine, _ = engine_for(spark, sf)
    e = evaluate(engine, R.books(spark, sf), share(R.catalog(spark, sf)), R.taxonomy(spark, sf))
    by_class = e.confusion.groupBy("model", F.col("y_true").cast("int").alias("label")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("hit"))
    report = e.report.select("model", F.col("label").try_cast("int").alias("label"), "recall")
    match = F.abs(F.col("recall") - F.col("hit") / F.col("support")) < 1e-4
    return by_class.filter("support > 0").join(report, ["model", "label"], "left").select("model", "label", "support", match.alias("report_matches"))


@query("silhouette_sample", "SELECT 'silhouette_sq' AS metric, true AS in_range")
def silhouette_sample(spark, sf):
    """Silhouette (squared Euclidean) of the clusters of the evaluation windows."""
    engine, _ = engine_for(spark, sf, ("kmeans_slow",))
    raw = share(scored_windows(engine, R.books(spark, sf), share(R.catalog(spark, sf)), R.taxonomy(spark, sf)))
    mean = silhouette_points(raw, engine).agg(F.avg("silhouette").alias("value"))
    return mean.select(F.lit("silhouette_sq").alias("metric"), F.col("value").between(-1, 1).alias("in_range"))


_SCORES = ["svm_slow", "svm_fast", "km_slow", "km_fast", "z1", "z2", "pca_x", "pca_y"]


@query("save_load_roundtrip", f"WITH {_CORPUS} SELECT count(*) AS rows, " + ", ".join(f"0::BIGINT AS diff_{c}" for c in _SCORES) + " FROM corpus")
def save_load_roundtrip(spark, sf):
    """Scores of a saved and loaded engine over all training rows, next to the original's."""
    engine, vectors = engine_for(spark, sf)
    folder = f"{checkpoint_dir(spark)}/engine-{uuid.uuid4().hex}"
    artifacts.save(engine, spark, folder)
    again = artifacts.load(spark, folder)
    rows = vectors.select("chunk_id", "idx", "val")
    a, b = engine.raw_scores(rows).select("chunk_id", *_SCORES), again.raw_scores(rows).select("chunk_id", *_SCORES)
    gap = a.alias("a").join(b.alias("b"), "chunk_id").select(*[(F.col(f"a.{c}") != F.col(f"b.{c}")).alias(c) for c in _SCORES])
    return gap.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(f"diff_{c}") for c in _SCORES])


@query("score_stream", "SELECT doc_id AS id, length(text) >= 20 AS accepted, CASE WHEN length(text) >= 20 THEN true END AS equals_batch FROM documents")
def score_stream(spark, sf):
    """All documents arrive as JSON requests in files and are scored as a stream; rejected ones are kept."""
    engine, _ = engine_for(spark, sf)
    folder = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    requests = C._requests(spark, sf).select(F.col("doc_id").alias("id"), "value")
    # As many files as the requests need, so that a batch of the stream is bounded and its tasks are many.
    requests.repartition("id").write.parquet(f"{folder}/in")
    requests = spark.read.parquet(f"{folder}/in")
    run = scoring.start(scoring.read_requests(spark, f"{folder}/in"), engine, f"{folder}/out", f"{folder}/state", available_now=True)
    run.awaitTermination()
    batch = engine.score(parse_requests(requests)[0], "id", mode_col="speed").select(F.col("id").alias("_id"), F.col("svm_label").alias("_svm"), F.col("cluster").alias("_cluster"))
    out = spark.read.parquet(f"{folder}/out")
    same = (F.col("svm_label") == F.col("_svm")) & (F.col("cluster") == F.col("_cluster"))
    scored = out.join(batch, F.col("id") == F.col("_id"), "left").select("id", F.lit(True).alias("accepted"), same.alias("equals_batch"))
    refused = spark.read.parquet(f"{folder}/out-rejected").select("id", F.lit(False).alias("accepted"), F.lit(None).cast("boolean").alias("equals_batch"))
    return scored.unionByName(refused)
