"""One call trains, records and saves."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from windrow.plans import train as TR
from windrow.queries import models
from windrow.queries import roles as R
from windrow.sources import artifacts, sinks


def test_a_run_repeated_replaces_its_tables(spark, sf, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    params = replace(models.settings(), epochs=2, restarts=1, svm_features=32, kmeans_max_iter=5, pca_max_passes=5)
    books, catalog, taxonomy = R.books(spark, sf), R.catalog(spark, sf), R.taxonomy(spark, sf)
    lost = books.agg(F.min("source_id")).first()[0]
    kept = books.withColumn("text", F.when(F.col("source_id") != lost, F.col("text")))
    for run in ("a", "a", "b"):
        got = TR.train(kept, catalog, taxonomy, path, run, params)
        assert [r["source_id"] for r in got.rejects.collect()] == [lost]
        assert got.metrics.count() == 14 and got.checks.count() == len(got.engine.checks)
        total = got.audit.filter("t2_idx = -1").first()["n"]
        assert total == got.vectors.count() == got.engine.tfidf.n_rows
        got.vectors.unpersist()
    assert spark.read.parquet(f"{path}/metrics").groupBy("run_id").count().orderBy("run_id").collect() == [("a", 14), ("b", 14)]
    before = artifacts.versions(spark, f"{path}/engine")
    assert len(before) == 3 and before[-1][1] == got.version

    def broken(rows, path, run_id):
        raise OSError("disk gone")

    monkeypatch.setattr(sinks, "write_run", broken)
    with pytest.raises(OSError):
        TR.train(kept, catalog, taxonomy, path, "c", params)
    assert artifacts.versions(spark, f"{path}/engine") == before
    artifacts.load(spark, f"{path}/engine")


def test_a_run_written_again_by_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (2, None)], "id int, s string")
    assert sinks.write_run(rows, str(tmp_path / "t"), "r1").count() == 2
    assert sinks.write_run(rows.limit(0), str(tmp_path / "t"), "r1").count() == 0
