"""Queries over clusters, subsets, classification metrics and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from windrow.operators import clustering as K
from windrow.operators import metrics as M
from windrow.operators.sampling import fast_subset as subset_of
from windrow.plans import evaluate as E
from windrow.plans import report as P
from windrow.queries import roles as R
from windrow.scale import share

QUERIES, ORACLES = {}, {}
RUN_TS = "2024-01-01 00:00:00"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


_A = f"WITH {R.ASSIGNED_CTE}"
# Per-class counts and scores of cluster (as prediction) against label.
_SCORES = _A + """,
lab AS (SELECT y_true AS label FROM assigned UNION SELECT cluster FROM assigned),
cs AS (SELECT l.label, count(*) FILTER (WHERE y_true = l.label AND cluster = l.label) AS tp,
  count(*) FILTER (WHERE y_true = l.label) AS support, count(*) FILTER (WHERE cluster = l.label) AS said
  FROM lab l, assigned a GROUP BY l.label),
sc AS (SELECT label, tp, support, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
  CASE WHEN said + support > 0 THEN 2 * tp / (said + support) ELSE 0 END AS f1 FROM cs)"""


@query("nearest_centroid", f"{_A} SELECT vec_id, cluster, round(dist2, 6) AS dist2 FROM assigned")
def nearest_centroid(spark, sf):
    return R.assigned(spark, sf).select("vec_id", "cluster", F.round("dist2", 6).alias("dist2"))


@query("inertia", f"{_A} SELECT round(sum(dist2), 4) AS inertia, count(DISTINCT cluster) AS n_clusters FROM assigned")
def inertia(spark, sf):
    return K.inertia(R.assigned(spark, sf)).select(F.round("inertia", 4).alias("inertia"), "n_clusters")


@query("cluster_majority", f"""{_A}, n AS (SELECT cluster, y_true, count(*) AS n FROM assigned GROUP BY ALL)
SELECT cluster, y_true AS majority FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, y_true) AS r FROM n) WHERE r = 1""")
def cluster_majority(spark, sf):
    return K.cluster_majority(R.assigned(spark, sf))


_PAIR_SUMS = """d AS (SELECT a.vec_id, a.cluster AS ca, b.cluster AS cb, sum(power(list_distance(a.e, b.e), 2)) AS s, count(*) AS n
  FROM assigned a, assigned b GROUP BY ALL),
i AS (SELECT vec_id, any_value(s / (n - 1)) AS a, any_value(n) AS n FROM d WHERE ca = cb GROUP BY vec_id),
o AS (SELECT vec_id, min(s / n) AS b FROM d WHERE ca <> cb GROUP BY vec_id)"""


@query("silhouette", f"""{_A},
{_PAIR_SUMS}
SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_sq FROM i JOIN o USING (vec_id)""")
def silhouette(spark, sf):
    value = K.silhouette_squared(R.assigned(spark, sf), "embedding")
    return spark.createDataFrame([(round(value, 6),)], "silhouette_sq double")


@query("silhouette_rows", f"""{_A},
{_PAIR_SUMS}
SELECT vec_id, ca AS cluster, round(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END, 6) AS silhouette
FROM i JOIN o USING (vec_id) JOIN (SELECT vec_id, cluster AS ca FROM assigned) USING (vec_id)""")
def silhouette_rows(spark, sf):
    """Silhouette of every vector under its nearest class mean."""
    rows = share(R.assigned(spark, sf).select("vec_id", "cluster", "embedding"))
    width = rows.select(F.max(F.size("embedding"))).first()[0] or 0
    got = K.silhouette_rows(K.sparse_form(rows, "embedding"), width)
    return got.select("vec_id", "cluster", F.round("silhouette", 6).alias("silhouette"))


@query("homogeneity_completeness", f"""{_A}, t AS (SELECT count(*) AS t FROM assigned),
ck AS (SELECT y_true AS c, cluster AS k, count(*) AS n FROM assigned GROUP BY ALL),
c AS (SELECT c, sum(n) AS nc FROM ck GROUP BY c), k AS (SELECT k, sum(n) AS nk FROM ck GROUP BY k),
h AS (SELECT (SELECT sum(-nc / t * ln(nc / t)) FROM c, t) AS hc, (SELECT sum(-nk / t * ln(nk / t)) FROM k, t) AS hk,
  (SELECT sum(-n / t * ln(n / nk)) FROM ck JOIN k USING (k), t) AS hck,
  (SELECT sum(-n / t * ln(n / nc)) FROM ck JOIN c USING (c), t) AS hkc)
SELECT round(1 - hck / hc, 6) AS homogeneity, round(1 - hkc / hk, 6) AS completeness FROM h""")
def homogeneity_completeness(spark, sf):
    return K.homogeneity_completeness(R.assigned(spark, sf)).select(
        F.round("homogeneity", 6).alias("homogeneity"), F.round("completeness", 6).alias("completeness"))


@query("fast_subset", f"WITH {R.BOTH_CTE} SELECT vec_id FROM subset")
def fast_subset(spark, sf):
    return subset_of(R.embeddings(spark, sf), "vec_id").select("vec_id")


@query("mode_switch", f"""WITH {R.BOTH_CTE}
SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN fast ELSE slow END AS cluster FROM two""")
def mode_switch(spark, sf):
    mode = F.when(F.col("vec_id") % 3 == 0, "fast").when(F.col("vec_id") % 3 == 1, "slow")
    rows = R.assigned_both(spark, sf).withColumn("mode", mode)
    return rows.select("vec_id", P.by_mode("mode", F.col("fast"), F.col("slow")).alias("cluster"))


# ---- classification ---------------------------------------------------------------------------


def _scored(spark, sf):
    return R.assigned(spark, sf).withColumnRenamed("cluster", "y_pred")


@query("confusion_matrix", _A + " SELECT y_true, " + ", ".join(
    f"count(*) FILTER (WHERE cluster = {k}) AS pred_{k}" for k in range(10)) + " FROM assigned GROUP BY y_true")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(_scored(spark, sf), list(range(10)))


@query("confusion_long", _A + " SELECT y_true, cluster AS y_pred, count(*) AS n FROM assigned GROUP BY ALL")
def confusion_long(spark, sf):
    return M.confusion_long(_scored(spark, sf))


@query("classification_report", _SCORES + """,
t AS (SELECT sum(support)::BIGINT AS t, sum(tp) / sum(support) AS acc FROM sc)
SELECT label::VARCHAR AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM sc
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), t FROM t
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), any_value(t) FROM sc, t
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / any_value(t), 6), round(sum(recall * support) / any_value(t), 6),
  round(sum(f1 * support) / any_value(t), 6), any_value(t) FROM sc, t""")
def classification_report(spark, sf):
    r = M.classification_report(_scored(spark, sf))
    return r.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("macro_metrics", _SCORES + """
SELECT round(sum(tp) / sum(support), 4) AS accuracy, round(avg(precision), 4) AS precision,
  round(avg(recall), 4) AS recall, round(avg(f1), 4) AS f1_macro FROM sc""")
def macro_metrics(spark, sf):
    return M.macro_metrics(_scored(spark, sf))


@query("class_weights", """SELECT label AS y_true, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight
FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)""")
def class_weights(spark, sf):
    return M.class_weights(R.embeddings(spark, sf), "y_true").select("y_true", "n", F.round("weight", 6).alias("weight"))


@query("edge_cases", """WITH s AS (
  SELECT doc_id, quality AS y_true, (n_chars > 1000)::INTEGER AS y_pred, text FROM documents JOIN labels USING (doc_id))
SELECT doc_id, 'quality_' || y_true AS true_class, 'quality_' || y_pred AS predicted, substr(text, 1, 300) || '...' AS preview
FROM s WHERE y_true <> y_pred ORDER BY doc_id LIMIT 10""")
def edge_cases(spark, sf):
    docs = R.table(spark, sf, "documents")
    rows = docs.join(R.table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "text", F.col("quality").alias("y_true"), (F.col("n_chars") > 1000).cast("int").alias("y_pred"))
    names = rows.select(
        "*", F.concat(F.lit("quality_"), F.col("y_true").cast("string")).alias("true_class"),
        F.concat(F.lit("quality_"), F.col("y_pred").cast("string")).alias("predicted"))
    return M.edge_cases(names, ["doc_id"])


# ---- composed tables ----------------------------------------------------------------------------


@query("scatter_table", f"""{_A}, n AS (SELECT cluster, y_true, count(*) AS n FROM assigned GROUP BY ALL),
m AS (SELECT cluster, 'class_' || y_true AS name FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, y_true) AS r FROM n) WHERE r = 1)
SELECT 'point' AS kind, vec_id::VARCHAR AS id, cluster, name, round(e[1], 6) AS x, round(e[2], 6) AS y FROM assigned JOIN m USING (cluster)
UNION ALL SELECT 'centroid', cluster::VARCHAR, cluster, coalesce(name, 'Cluster ' || cluster), round(c[1], 6), round(c[2], 6) FROM cent LEFT JOIN m USING (cluster)""")
def scatter_table(spark, sf):
    rows = R.assigned(spark, sf)
    points = rows.select(F.col("vec_id").alias("id"), "cluster", "y_true",
                         F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    spots = spark.createDataFrame([(c, v[0], v[1]) for c, v in R.centers(R.embeddings(spark, sf))],
                                  "cluster int, x double, y double")
    name = F.concat(F.lit("class_"), F.col("majority").cast("string"))
    return E.scatter_table(points, spots, K.cluster_majority(points).select("cluster", name.alias("name"))).select(
        "kind", "id", "cluster", "name", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def _macro_sql(model: str, column: str) -> str:
    return f"""SELECT '{model}' AS model, round(sum(tp) / sum(support), 4) AS accuracy, round(avg(p), 4) AS precision,
  round(avg(r), 4) AS recall, round(avg(f), 4) AS f1_macro FROM (
  SELECT tp, support, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r,
    CASE WHEN said + support > 0 THEN 2 * tp / (said + support) ELSE 0 END AS f FROM (
    SELECT l.label, count(*) FILTER (WHERE y_true = l.label AND {column} = l.label) AS tp,
      count(*) FILTER (WHERE y_true = l.label) AS support, count(*) FILTER (WHERE {column} = l.label) AS said
    FROM (SELECT y_true AS label FROM two UNION SELECT {column} FROM two) l, two GROUP BY l.label))"""


@query("metrics_report", f"""WITH {R.BOTH_CTE},
svm AS ({_macro_sql('svm_slow', 'slow')} UNION ALL {_macro_sql('svm_fast', 'fast')}),
km AS (SELECT 'kmeans_slow' AS model, round(sum(slow_d2), 2) AS inertia, count(DISTINCT slow)::DOUBLE AS n_clusters FROM two UNION ALL
  SELECT 'kmeans_fast', round(sum(fast_d2) FILTER (WHERE in_fast), 2), count(DISTINCT fast)::DOUBLE FROM two),
long AS (
  SELECT model, 'accuracy' AS metric, accuracy AS value FROM svm UNION ALL SELECT model, 'precision', precision FROM svm UNION ALL
  SELECT model, 'recall', recall FROM svm UNION ALL SELECT model, 'f1_macro', f1_macro FROM svm UNION ALL
  SELECT model, 'inertia', inertia FROM km UNION ALL SELECT model, 'n_clusters', n_clusters FROM km)
SELECT model, metric, value, strftime(TIMESTAMP '{RUN_TS}', '%Y-%m-%d %H:%M UTC') AS run_ts, (SELECT count(*) FROM two) AS n FROM long""")
def metrics_report(spark, sf):
    rows = share(R.assigned_both(spark, sf))
    parts = [
        P.classifier_metrics(rows, "y_true", {"svm_slow": "slow", "svm_fast": "fast"}),
        P.cluster_metrics(rows, {"kmeans_slow": ("slow", "slow_d2", None), "kmeans_fast": ("fast", "fast_d2", "in_fast")}),
    ]
    return P.metrics_report(parts, P.run_stamp(datetime.fromisoformat(RUN_TS)),
                            rows.agg(F.count(F.lit(1)).alias("n")).scalar())
