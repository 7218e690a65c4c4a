"""Findings F2 to F5 of the fourth round: rows of the size of the input are stored, not cached."""

import math

import pytest
from pyspark.sql import functions as F

from windrow.operators import tfidf as V
from windrow.queries import vectors


@pytest.fixture
def folder(spark, tmp_path):
    texts = [" ".join(f"w{chr(97 + (i * j) % 7)}{chr(97 + j % 5)}x" for j in range(230)) for i in range(1, 9)]
    rows = [(i % 6, t, "en", f"src{i % 2}", 1) for i, t in enumerate([*texts, *texts[:3], "short", None])] + [(None, texts[0], "de", "src1", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def cached_columns(monkeypatch):
    seen = []
    for module in (V, vectors):
        if hasattr(module, "share"):
            monkeypatch.setattr(module, "share", lambda df, _fn=module.share: seen.append(df.columns) or _fn(df))
    return seen


def assert_tokens_not_cached(spark, folder, monkeypatch, name):
    seen = cached_columns(monkeypatch)
    rows = vectors.QUERIES[name](spark, folder)
    assert rows.collect()
    assert not any("tokens" in columns or "terms" in columns for columns in seen), seen


@pytest.mark.parametrize("name", ["tfidf_transform", "tfidf_fit", "vocab_topk", "term_label_assoc", "gamma_scale"])
def test_tokens_of_a_fit_are_stored(spark, folder, monkeypatch, name):
    assert_tokens_not_cached(spark, folder, monkeypatch, name)


def test_a_fit_keeps_no_copy_of_its_rows(spark, monkeypatch):
    seen = cached_columns(monkeypatch)
    df = spark.createDataFrame([(["aa", "bb", "aa"],), (["aa", "cc"],), (None,)], "tokens array<string>")
    model = V.fit_tfidf(df, min_df=1, max_df=1.0)
    assert model.n_rows == 3 and model.terms == sorted(["aa", "bb", "cc", "aa bb", "bb aa", "aa cc", "aa bb aa"])
    assert all(columns == ["term", "df", "cf"] for columns in seen)


def test_join_query_stores_tokens_and_places_few_ngrams(spark, folder, monkeypatch):
    placed = []
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "repartition", lambda self, *a, _fn=frame.repartition: placed.append(self) or _fn(self, *a))
    assert_tokens_not_cached(spark, folder, monkeypatch, "tfidf_transform_join")
    (terms,) = [df for df in placed if "terms" in df.columns]
    assert {r["t"] for r in terms.select(F.explode_outer("terms").alias("t")).filter("t IS NOT NULL").collect()} == {r["term"] for r in vectors.tfidf_fit(spark, folder).collect()}


def test_join_form_of_odd_rows(spark):
    rows = [("a", ["x", "y", "x", "no", None]), ("a", ["x"]), (None, ["y"]), (None, ["y", "no"]), ("b", None), ("c", []), ("d", ["no"])]
    df = spark.createDataFrame(rows, "id string, terms array<string>")
    vocab = spark.createDataFrame([("x", 0, 1.0), ("y", 1, 2.0)], "term string, term_idx int, idf double")
    got = {(r["id"], r["term_idx"]): round(r["w"], 9) for r in V.transform_by_join(df, "id", "terms", vocab).collect()}
    x, y = 1 + math.log(3), 2.0
    norm = math.hypot(x, y)
    assert got == {("a", 0): round(x / norm, 9), ("a", 1): round(y / norm, 9), (None, 1): 1.0}
    assert V.transform_by_join(df, "id", "terms", vocab.limit(0)).collect() == []
