"""Findings F11 to F13: only the models that are asked for, texts read once for lemmas, n-grams shuffled once per token."""

import random

from pyspark.sql import functions as F

from windrow.models.numeric import packed
from windrow.operators import tfidf as V
from windrow.plans import engine as E
from windrow.queries import corpus as C
from windrow.queries import models as M


def _labelled(spark):
    words = {i: [f"w{chr(97 + i)}{chr(97 + j)}" for j in range(12)] for i in range(2)}
    rng = random.Random(1)
    rows = [(f"{i % 2}-{i}", i % 2, i % 2, " ".join(rng.choices(words[i % 2], k=30))) for i in range(40)]
    corpus = spark.createDataFrame(rows, "chunk_id string, t1_idx int, t2_idx int, text string")
    taxonomy = spark.createDataFrame([(0, "a", 0, "a_0"), (1, "b", 1, "b_0")], "t1_idx int, t1 string, t2_idx int, t2 string")
    return corpus, taxonomy


def test_one_model_is_fitted_alone_and_the_rest_later(spark):
    corpus, taxonomy = _labelled(spark)
    params = E.Params(min_df=1, max_df=1.0, clusters=2, restarts=2, svm_features=16, epochs=2, mlp_partitions=1, pca_max_passes=5)
    engine, x = E.fit_engine(corpus, taxonomy, params, models=("kmeans_slow",))
    assert [m for m in E.MODELS if getattr(engine, m) is not None] == ["kmeans_slow"]
    first = engine.kmeans_slow
    raw = engine.raw_scores(x.select("chunk_id", "idx", "val"))
    got = raw.agg(F.count("km_slow"), F.count("svm_slow"), F.count("km_fast"), F.count("z1"), F.count("pca_x"), F.sum("km_slow_d2")).first()
    assert tuple(got)[:5] == (40, 0, 0, 0, 0) and abs(got[5] - first.cost) < 1e-6
    E.fit_models(engine, x, ("kmeans_slow", "svm_slow"))
    assert engine.kmeans_slow is first and engine.svm_slow is not None and engine.mlp is None
    whole, _ = E.fit_engine(corpus, taxonomy, params)
    assert whole.kmeans_slow.costs == first.costs and (whole.kmeans_slow.centers == first.centers).all()


def test_rows_of_a_fit_have_a_short_plan(spark):
    df = spark.range(50).select("id")
    for _ in range(4):
        df = df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).select("id")
    rows, parts = packed(df, ["id"], 50)
    assert rows.count() == 50 and parts == rows.rdd.getNumPartitions()
    assert "Aggregate" not in rows._jdf.queryExecution().optimizedPlan().toString()
    rows.unpersist()


def test_kmeans_fit_fits_no_other_model(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(M.E, "build", lambda *a, models=None, **k: seen.append(models) or (E.Engine(None, None, None), None))
    monkeypatch.setattr(M.E, "fit_models", lambda *a: seen.append(a[-1]))
    monkeypatch.setattr(M, "_built", {})
    spark.createDataFrame([(1, "a text", "en", "src1", 6)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    M.engine_for(spark, str(tmp_path), ("kmeans_slow",))
    assert seen == [("kmeans_slow",)] * 2


def test_lemmas_take_surfaces_from_the_lexicon(spark, tmp_path):
    rows = [(1, "the cats cat and Boss was his hi"), (2, None), (3, ""), (4, "wolves wolf cats, us u"), (4, "wolves wolf cats, us u")]
    docs = spark.createDataFrame([(i, t, "en", "src1", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    tokens, table = C.lemma_inputs(spark, str(tmp_path))
    assert {tuple(r) for r in table.select("surface", "lemma").collect()} == {("cats", "cat"), ("his", "hi"), ("wolves", "wolf")}
    assert tokens.count() == 5


def test_ngram_counts_equal_plain_counts(spark):
    rng = random.Random(5)
    words = ["a", "ab", "abc", "b", "ba", "stop", "c"]
    rows = [([rng.choice(words) for _ in range(rng.randint(0, 9))],) for _ in range(300)] + [(None,), ([],), (["a"],), (["a", "a"],), (["a"] * 40,)]
    df = spark.createDataFrame(rows, "tokens array<string>").repartition(5)
    for ngrams in ((1, 1), (1, 2), (2, 2), (1, 3), (2, 3), (3, 3), (1, 4)):
        want = sorted(map(tuple, V.term_stats(V.with_terms(df, "tokens", ["stop"], ngrams)).collect()))
        for share in (V.HOT_SHARE, 0.03, 0.0, 1.0):
            assert sorted(map(tuple, V.ngram_stats(df, "tokens", ["stop"], ngrams, share).collect())) == want, (ngrams, share)


def test_longest_ngrams_and_their_heads_share_one_shuffle(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "tokens array<string>")
    plan = V.ngram_stats(df, ngrams=(2, 3), share_of_all=1.0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
