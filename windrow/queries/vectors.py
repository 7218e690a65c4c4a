"""Queries over n-grams, TF-IDF and probability columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from windrow.functions import probs as P
from windrow.functions import text as T
from windrow.operators import metrics as M
from windrow.operators import tfidf as V
from windrow.queries import roles as R
from windrow.scale import share, stored
from windrow.sources.requests import render_responses as render

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# ---- terms and TF-IDF -----------------------------------------------------------------------


@query("tfidf_terms", f"WITH {R.TERMS_CTE} SELECT source_id, pos, array_to_string(t, ' ') AS tokens FROM kept")
def tfidf_terms(spark, sf):
    kept = T.drop_words("tokens", R.STOP_2)
    return R.chunk_tokens(spark, sf).select("source_id", "pos", F.array_join(kept, " ").alias("tokens"))


@query("ngrams", f"""WITH {R.TERMS_CTE}
SELECT source_id, pos, coalesce(string_agg(term, '|' ORDER BY n, k), '') AS terms
FROM chunks LEFT JOIN grams USING (source_id, pos) GROUP BY source_id, pos""")
def ngrams(spark, sf):
    return R.chunk_terms(spark, sf).select("source_id", "pos", F.array_join("terms", "|").alias("terms"))


@query("term_stats", f"WITH {R.TERMS_CTE} SELECT term, df, cf FROM stats")
def term_stats(spark, sf):
    return V.ngram_stats(R.chunk_tokens(spark, sf), stop=R.STOP_2)


def _vocabulary(spark, sf):
    rows = stored(R.chunk_tokens(spark, sf).select("tokens"), "tokens")
    return V.vocabulary(V.pruned_stats(rows, stop=R.STOP_2), rows.count())


@query("vocab_topk", f"WITH {R.TERMS_CTE} SELECT term, df, cf FROM vocab")
def vocab_topk(spark, sf):
    return _vocabulary(spark, sf).select("term", "df", "cf")


@query("tfidf_fit", f"WITH {R.TERMS_CTE} SELECT term, term_idx, df, cf, round(idf, 6) AS idf FROM vocab")
def tfidf_fit(spark, sf):
    return _vocabulary(spark, sf).select("term", "term_idx", "df", "cf", F.round("idf", 6).alias("idf"))


def _fitted(spark, sf):
    rows = stored(R.chunk_tokens(spark, sf), "tokens")
    return V.fit_tfidf(rows, stop=R.STOP_2), rows


@query("tfidf_transform", f"WITH {R.WEIGHTS_CTE} SELECT source_id, pos, term_idx, round(w, 6) AS w FROM weights")
def tfidf_transform(spark, sf):
    model, rows = _fitted(spark, sf)
    cells = model.transform(rows).select("source_id", "pos", F.explode(F.arrays_zip("idx", "val")).alias("c"))
    return cells.select("source_id", "pos", F.col("c.idx").alias("term_idx"), F.round("c.val", 6).alias("w"))


@query("tfidf_transform_join", f"WITH {R.WEIGHTS_CTE} SELECT chunk_id, term_idx, round(w, 6) AS w FROM (SELECT source_id || '-' || pos AS chunk_id, term_idx, w FROM weights)")
def tfidf_transform_join(spark, sf):
    """The same weights through joins, the form for vocabularies too large to broadcast."""
    rows = stored(R.chunk_tokens(spark, sf), "tokens")
    vocab = share(V.vocabulary(V.pruned_stats(rows, stop=R.STOP_2), rows.count()))
    terms = V.with_terms(rows, "tokens", R.STOP_2).select(F.concat_ws("-", "source_id", "pos").alias("chunk_id"), "terms")
    return V.transform_by_join(terms, "chunk_id", "terms", vocab).select(
        "chunk_id", "term_idx", F.round("w", 6).alias("w"))


@query("gamma_scale", f"""WITH {R.WEIGHTS_CTE}, s AS (
  SELECT sum(w) AS s1, sum(w * w) AS s2, (SELECT n FROM size)::DOUBLE AS n, (SELECT count(*) FROM vocab)::DOUBLE AS d FROM weights)
SELECT round(1 / (d * (s2 / (n * d) - power(s1 / (n * d), 2))), 6) AS gamma FROM s""")
def gamma_scale(spark, sf):
    model, rows = _fitted(spark, sf)
    cells = model.transform(rows).select(F.explode_outer("val").alias("w")).filter("w IS NOT NULL")
    return V.gamma_scale(cells, model.n_rows, model.width).select(F.round("gamma", 6).alias("gamma"))


@query("term_label_assoc", f"""WITH {R.TERMS_CTE},
docs AS (SELECT doc_id, {R.T2_SQL} AS t2 FROM documents),
hit AS (SELECT t2, term, count(*) AS n FROM tf JOIN docs ON doc_id = source_id JOIN vocab USING (term) GROUP BY ALL),
per AS (SELECT t2, count(*) AS rows FROM chunks JOIN docs ON doc_id = source_id GROUP BY t2)
SELECT term, t2, round(n / rows, 6) AS share,
  round(n / rows - sum(n) OVER (PARTITION BY term) / (SELECT n FROM size), 6) AS gap FROM hit JOIN per USING (t2)""")
def term_label_assoc(spark, sf):
    labels = R.class_of_source(spark, sf).select(F.col("doc_id").alias("source_id"), "t2")
    model, rows = _fitted(spark, sf)
    known = model.transform(rows).join(labels, "source_id").select("t2", "idx")
    cells = V.term_label_assoc(known, "t2", "idx")
    names = F.broadcast(model.vocab_table(spark).select(F.col("term_idx").alias("term"), F.col("term").alias("name")))
    return cells.join(names, "term").select(
        F.col("name").alias("term"), "t2", F.round("share", 6).alias("share"), F.round("gap", 6).alias("gap"))


# ---- probabilities ----------------------------------------------------------------------------


def _probs(spark, sf):
    z = R.logits(spark, sf)
    p = z.select("vec_id", P.softmax("z1").alias("p1"), P.softmax("z2").alias("p2"))
    return p.select("vec_id", "p1", "p2", P.hierarchical_mask("p1", "p2", R.PARENT).alias("pm"))


def _wide(column: str, n: int, prefix: str):
    return [F.round(F.col(column).getItem(i), 6).alias(f"{prefix}{i}") for i in range(n)]


def _wide_sql(column: str, n: int, prefix: str) -> str:
    return ", ".join(f"round({column}[{i + 1}], 6) AS {prefix}{i}" for i in range(n))


@query("softmax", f"WITH {R.PROBS_CTE} SELECT vec_id, {_wide_sql('p1', 3, 'a')}, {_wide_sql('p2', 7, 'b')} FROM probs")
def softmax(spark, sf):
    return _probs(spark, sf).select("vec_id", *_wide("p1", 3, "a"), *_wide("p2", 7, "b"))


@query("hierarchical_mask", f"WITH {R.PROBS_CTE} SELECT vec_id, {_wide_sql('pm', 7, 'p')} FROM masked")
def hierarchical_mask(spark, sf):
    return _probs(spark, sf).select("vec_id", *_wide("pm", 7, "p"))


@query("argmax", f"""WITH {R.PROBS_CTE} SELECT vec_id, (list_position(p1, list_max(p1)) - 1)::INTEGER AS t1_idx,
  (list_position(pm, list_max(pm)) - 1)::INTEGER AS t2_idx FROM masked""")
def argmax(spark, sf):
    return _probs(spark, sf).select("vec_id", P.argmax("p1").alias("t1_idx"), P.argmax("pm").alias("t2_idx"))


_SCHOOLS = [f"school_{i}" for i in range(7)]
_BRANCHES = [f"branch_{i}" for i in range(3)]


@query("prob_map", f"""WITH {R.PROBS_CTE} SELECT vec_id, 'school_' || (j - 1) AS label, round(pm[j], 6) AS p
FROM masked, unnest(range(1, 8)) AS u(j)""")
def prob_map(spark, sf):
    maps = _probs(spark, sf).select("vec_id", P.prob_map(_SCHOOLS, "pm").alias("m"))
    return maps.select("vec_id", F.explode("m").alias("label", "p")).withColumn("p", F.round("p", 6))


@query("percent_roundtrip", f"""WITH {R.PROBS_CTE} SELECT vec_id, format('{{:.1f}}%', p1[1] * 100) AS shown,
  round(p1[1], 3) AS value FROM masked""")
def percent_roundtrip(spark, sf):
    shown = _probs(spark, sf).select("vec_id", P.percent_text(F.col("p1").getItem(0)).alias("shown"))
    return shown.select("vec_id", "shown", F.round(P.percent_value("shown"), 3).alias("value"))


@query("predict_format", """SELECT vec_id, round(embedding[1]::DOUBLE, 4) AS x, round(embedding[2]::DOUBLE, 4) AS y FROM embeddings""")
def predict_format(spark, sf):
    e = R.embeddings(spark, sf)
    return e.select("vec_id", F.round(F.col("embedding")[0], 4).alias("x"), F.round(F.col("embedding")[1], 4).alias("y"))


@query("ovo_vote", """WITH m AS (SELECT vec_id, embedding[1] > 0 AS a, embedding[2] > 0 AS b, embedding[3] > 0 AS c FROM embeddings),
v AS (SELECT vec_id, [a::INT + b::INT, (NOT a)::INT + c::INT, (NOT b)::INT + (NOT c)::INT] AS t FROM m)
SELECT vec_id, (list_position(t, list_max(t)) - 1)::INTEGER AS label FROM v""")
def ovo_vote(spark, sf):
    """Margins of the pairs (0,1), (0,2), (1,2)."""
    m = R.logits(spark, sf)
    return m.select("vec_id", P.vote("z1", [(0, 1), (0, 2), (1, 2)], 3).alias("label"))


@query("weighted_ce", f"""WITH {R.PROBS_CTE}, t AS (
  SELECT CASE WHEN label % 7 = 5 THEN 1.4 ELSE 1.0 END::DOUBLE AS w, -ln(p2[label % 7 + 1]) AS nll FROM probs JOIN embeddings USING (vec_id))
SELECT round(sum(w * nll) / sum(w), 6) AS loss FROM t""")
def weighted_ce(spark, sf):
    truth = R.embeddings(spark, sf).select("vec_id", (F.col("y_true") % 7).alias("y"))
    rows = _probs(spark, sf).join(truth, "vec_id")
    return M.weighted_cross_entropy(rows, "y", "p2", {5: 1.4}).select(F.round("loss", 6).alias("loss"))


@query("render_responses", f"""WITH {R.ASSIGNED_CTE}, {R.PROBS_CTE}
SELECT vec_id, 'branch_' || (y_true % 3) AS svm_label,
  'branch_' || (list_position(p1, list_max(p1)) - 1) AS t1, 'school_' || (list_position(pm, list_max(pm)) - 1) AS t2,
  round(p1[1], 3) AS p_branch_0, round(pm[1], 3) AS p_school_0, cluster,
  round(e[1], 4) AS pca_x, round(e[2], 4) AS pca_y FROM assigned JOIN masked USING (vec_id)""")
def render_responses(spark, sf):
    """JSON responses are rendered, then read back into columns."""
    rows = R.assigned(spark, sf).join(_probs(spark, sf), "vec_id")
    predictions = rows.select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("branch_"), (F.col("y_true") % 3).cast("string")).alias("svm_label"),
        F.struct(P.label_at(_BRANCHES, P.argmax("p1")).alias("label"),
                 P.prob_map(_BRANCHES, "p1").alias("probabilities")).alias("tier1"),
        F.struct(P.label_at(_SCHOOLS, P.argmax("pm")).alias("label"),
                 P.prob_map(_SCHOOLS, "pm").alias("probabilities")).alias("tier2"),
        "cluster", F.col("embedding")[0].alias("pca_x"), F.col("embedding")[1].alias("pca_y"),
    )
    tier = "struct<label:string,probabilities:map<string,double>>"
    schema = f"svm_label string, nn_tier1 {tier}, nn_tier2 {tier}, kmeans_cluster int, pca_x double, pca_y double"
    back = render(predictions).select("id", F.from_json("value", schema).alias("r"))
    return back.select(
        F.col("id").alias("vec_id"), "r.svm_label", F.col("r.nn_tier1.label").alias("t1"),
        F.col("r.nn_tier2.label").alias("t2"),
        F.col("r.nn_tier1.probabilities")["branch_0"].alias("p_branch_0"),
        F.col("r.nn_tier2.probabilities")["school_0"].alias("p_school_0"),
        F.col("r.kmeans_cluster").alias("cluster"), "r.pca_x", "r.pca_y",
    )
