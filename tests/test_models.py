import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrow.models import exchange as X
from windrow.models import mlp as N
from windrow.models import pca as PCA
from windrow.models.numeric import Rows, part_rows, reduce_parts
from windrow.models.svm import predict_svm
from windrow.operators import tfidf as V
from windrow.plans.evaluate import evaluate
from windrow.plans.report import engine_metrics
from windrow.queries import roles as R
from windrow.sources import artifacts, sinks
from windrow.streaming import scoring


def sparse(x):
    idx = [np.flatnonzero(r) for r in x]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in idx])])
    return Rows(offsets, np.concatenate(idx).astype(np.int32), np.concatenate([r[i] for r, i in zip(x, idx)]))


def test_sparse_products():
    rng = np.random.RandomState(0)
    x = rng.rand(30, 50) * (rng.rand(30, 50) > 0.8)
    x[4] = 0
    rows, narrow, wide = sparse(x), rng.rand(30, 3), rng.rand(30, 20)
    m = rng.rand(50, 7)
    assert np.allclose(rows.dot(m, rows=8), x @ m)
    assert np.allclose(rows.transposed_dot(narrow, 50), x.T @ narrow)
    assert np.allclose(rows.transposed_dot(wide, 50, rows=8), x.T @ wide)
    assert np.allclose(rows.squared_norms(), (x**2).sum(1))
    order = rng.permutation(30)[:11]
    assert np.allclose(rows.take(order).dot(np.eye(50)), x[order])


def test_erf():
    x = np.linspace(-4, 4, 81)
    assert np.abs(N.erf(x) - [math.erf(v) for v in x]).max() < 2e-7


def test_network_gradient():
    rng = np.random.RandomState(2)
    x = rng.rand(9, 12) * (rng.rand(9, 12) > 0.5)
    w = {k: v.astype(np.float64) for k, v in N.start_weights(12, 2, 3, 0).items()}
    y1, y2, cw = rng.randint(0, 2, 9), rng.randint(0, 3, 9), np.array([1.0, 1.4, 1.0])
    rows = sparse(x)
    _, g = N.loss_and_slopes(w, rows, y1, y2, cw)
    cols, part = g["w1"]
    g["w1"] = np.zeros_like(w["w1"])
    g["w1"][cols] = part
    for k in w:
        at = tuple(rng.randint(0, s) for s in w[k].shape)
        keep, h = w[k][at], 1e-5
        w[k][at] = keep + h
        up = N.loss_and_slopes(w, rows, y1, y2, cw)[0]
        w[k][at] = keep - h
        down = N.loss_and_slopes(w, rows, y1, y2, cw)[0]
        w[k][at] = keep
        assert g[k][at] == pytest.approx((up - down) / (2 * h), rel=1e-3, abs=1e-6)


def test_adamw_against_its_formula():
    rng = np.random.RandomState(4)
    w = {"w1": rng.rand(700, 3), "b1": rng.rand(3)}
    want, m, v = w["w1"].copy(), np.zeros((700, 3)), np.zeros((700, 3))
    opt = N.AdamW({k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0)
    for t in (1, 2, 3):
        cols = np.sort(rng.choice(700, 50, replace=False))
        g = rng.rand(50, 3)
        full = np.zeros((700, 3))
        full[cols] = g
        opt.step(w, {"w1": (cols, g), "b1": np.zeros(3)})
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        want = want * (1 - 5e-4 * 0.02) - 5e-4 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.allclose(w["w1"], want, rtol=1e-10)


def test_many_partials_are_reduced(spark):
    def run(batches):
        for b in batches:
            v = float(b.column(0).to_numpy().sum())
            yield part_rows({"a": np.full(70_000, v), "b": np.array([[v, 1.0]])}, 2.0)

    parts = spark.range(200).repartition(25).mapInArrow(run, "name string, block int, weight double, data binary")
    got = reduce_parts(parts, {"a": (70_000,), "b": (1, 2)}, 25)
    assert got["a"][0] == got["a"][-1] == 19900 and got["b"][0, 0] == 19900


def test_wide_pca_is_the_decomposition(spark):
    rng = np.random.RandomState(3)
    x = rng.rand(300, 40) * (rng.rand(300, 40) > 0.7) * np.linspace(2, 0.2, 40)
    x[5] = 0
    df = spark.createDataFrame(
        [([int(j) for j in np.flatnonzero(r)], [float(v) for v in r[np.flatnonzero(r)]]) for r in x],
        "idx array<int>, val array<double>")
    model = PCA.fit_pca_wide(df, 40, tol=1e-9)
    c = x - x.mean(0)
    values = np.linalg.eigvalsh(c.T @ c / 299)[::-1]
    assert np.allclose(model.variance, values[:2], rtol=1e-6)
    assert np.allclose(model.ratio, values[:2] / values.sum(), rtol=1e-6)
    z = model.project(sparse(x[:5]))
    assert np.allclose(z, c[:5] @ model.components)
    assert np.allclose((c @ model.components).mean(0), 0)


def test_narrow_pca(spark, sf):
    vecs = R.embeddings(spark, sf)
    model = PCA.fit_pca_narrow(vecs, "embedding")
    x = np.array([r["embedding"] for r in vecs.select("embedding").collect()])
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(model.variance, values[:2])
    z = PCA.project(vecs, "embedding", model).agg(F.avg("pca_x"), F.var_samp("pca_x"), F.var_samp("pca_y")).first()
    assert z[0] == pytest.approx(0, abs=1e-9) and z[1] == pytest.approx(values[0]) and z[1] >= z[2]


def test_tfidf_forms_agree_and_rows_are_unit(spark, sf):
    rows = R.chunk_tokens(spark, sf).select(F.concat_ws("-", "source_id", "pos").alias("chunk_id"), "tokens").persist()
    model = V.fit_tfidf(rows, stop=R.STOP_2)
    a = model.transform_long(rows, "chunk_id").select("chunk_id", "term_idx", F.round("w", 9))
    b = V.transform_by_join(V.with_terms(rows, stop=R.STOP_2), "chunk_id", "terms", model.vocab_table(spark)).select(
        "chunk_id", "term_idx", F.round("w", 9))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    norm = F.aggregate("val", F.lit(0.0), lambda s, w: s + w * w)
    off = model.transform(rows).filter((F.size("val") > 0) & (F.abs(norm - 1) > 1e-9))
    assert off.isEmpty()
    unknown = spark.createDataFrame([("u", ["zzzz"])], "chunk_id string, tokens array<string>")
    assert model.transform(unknown).select("idx", "val").first() == ([], [])


def test_vectors_become_ml_vectors(spark):
    df = spark.createDataFrame([([1, 3], [0.5, 2.0]), ([], [])], "idx array<int>, val array<double>")
    got = [r["features"] for r in V.with_vector(df, 5).collect()]
    assert got[0].toArray().tolist() == [0, 0.5, 0, 2.0, 0] and got[1].toArray().tolist() == [0] * 5


def test_classes_are_equal_in_number(engine):
    _, x = engine
    assert {name for name, _, _ in engine[0].checks} >= {"Duplicate Check", "Missing Values", "Data Drift"}
    sizes = {r["count"] for r in x.groupBy("t2_idx").count().collect()}
    assert len(sizes) == 1


def test_svm_learns_and_gamma_is_near_one(engine):
    e, x = engine
    scored = predict_svm(x.withColumnRenamed("t1_idx", "y_true"), e.svm_slow)
    assert scored.agg(F.avg((F.col("y_true") == F.col("y_pred")).cast("int"))).first()[0] > 0.9
    assert 0.8 < e.svm_slow.gamma < 1.5


def test_network_learns(engine):
    losses = engine[0].mlp.losses
    assert losses[-1] < losses[0]


def test_partitioned_training_also_learns(spark, engine):
    e, x = engine
    m = N.fit_mlp(x, e.tfidf.width, len(e.labels.t1), len(e.labels.t2), "chunk_id", epochs=8, partitions=3, batch=8)
    again = N.fit_mlp(x, e.tfidf.width, len(e.labels.t1), len(e.labels.t2), "chunk_id", epochs=8, partitions=3, batch=8)
    assert m.losses[-1] < m.losses[0]
    assert np.allclose(m.losses, again.losses)


def test_one_barrier_stage_gives_the_weights_of_one_job_per_epoch(spark, engine):
    e, x = engine
    fit = lambda **how: N.fit_mlp(x, e.tfidf.width, len(e.labels.t1), len(e.labels.t2), "chunk_id", epochs=4, partitions=3, batch=8, **how)
    spark.sparkContext.setJobGroup("one-stage", "network")
    one = fit(barrier=True)
    ran = spark.sparkContext.statusTracker().getJobIdsForGroup("one-stage")
    spark.sparkContext.setJobGroup("jobs", "network")
    many = fit(barrier=False)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert np.allclose(one.losses, many.losses, rtol=1e-4)
    for k, w in one.weights.items():
        assert np.allclose(w, many.weights[k], atol=2e-4), k
    # Placing the rows, the barrier stage and reading the result may be jobs of their own; there is none per epoch.
    assert len(ran) <= 3
    slow = fit(barrier=True, rate=N.LEARNING_RATE)
    assert len(slow.losses) == 4 and not np.allclose(slow.losses, one.losses)


def test_a_failed_stage_goes_on_after_the_last_round(spark, tmp_path):
    folder, log = X.new_folder(spark, "rounds"), str(tmp_path / "log")

    def run(batches, log=log, folder=folder):
        import os

        import numpy as np
        import pyarrow as pa
        from pyspark import BarrierTaskContext

        from windrow.models.exchange import Exchange, Held

        side = Exchange(folder, BarrierTaskContext.get())
        held = Held(side, batches)
        number, facts, flat = side.resume()
        flat = np.zeros(5, np.float32) if flat is None else flat
        while number < 4:
            number += 1
            with open(f"{log}-{side.part}", "a") as f:
                f.write(f"{number} ")
            if number == 3 and side.part == 1 and not os.path.exists(log):
                open(log, "w").close()
                raise RuntimeError("lost on purpose")
            rows = sum(b.num_rows for b in held)
            flat, told = side.mean(number, flat + np.float32(side.part + 1), rows, [number])
            side.finish(number, {"rows": sum(t[0] for t in told)})
        yield pa.RecordBatch.from_arrays([pa.array([float(x) for x in flat])], names=["x"])

    got = [r["x"] for r in spark.range(0, 30, 1, 3).mapInArrow(run, "x double", barrier=True).repartition(1).collect()]
    # Ten rows a part, so every round adds 2; all three parts end with the same five numbers.
    assert got == [8.0] * 15
    assert (tmp_path / "log-1").read_text().split() == ["1", "2", "3", "3", "4"]
    X.drop_folder(folder)


def test_parts_without_rows_do_not_count(spark, engine):
    e, x = engine
    few = x.limit(2)
    fit = lambda how: N.fit_mlp(few, e.tfidf.width, len(e.labels.t1), len(e.labels.t2), "chunk_id", epochs=2, partitions=6, barrier=how)
    assert np.allclose(fit(True).losses, fit(False).losses, rtol=1e-4)
    none = N.fit_mlp(x.limit(0), e.tfidf.width, len(e.labels.t1), len(e.labels.t2), "chunk_id", epochs=2, barrier=True)
    assert all(np.isfinite(w).all() for w in none.weights.values())


def test_kmeans_cost_is_the_assignments_cost(engine):
    e, x = engine
    raw = e.raw_scores(x.select("chunk_id", "idx", "val"))
    total = raw.agg(F.sum("km_slow_d2")).first()[0]
    assert total == pytest.approx(e.kmeans_slow.cost, rel=1e-4)
    assert e.kmeans_slow.cost == min(e.kmeans_slow.costs)


def test_prediction_rows(spark, sf, engine):
    e, _ = engine
    docs = R.books(spark, sf).withColumn("speed", F.lit("fast"))
    mixed = docs.withColumn("speed", F.when(F.col("source_id") % 3 == 0, "fast").when(F.col("source_id") % 3 == 1, "slow"))
    marked = e.vectors(mixed.select("source_id", "speed", "text")).drop("text")
    whole = e.predictions(e.raw_scores(marked), "source_id", "speed")
    part = e.predictions(e.raw_scores(marked, False, "speed"), "source_id", "speed")
    same = ["id", "svm_label", "cluster", "tier1.label", "tier2.label"]
    assert whole.select(*same).exceptAll(part.select(*same)).isEmpty() and whole.count() == part.count()
    p = e.score(docs, "source_id", mode_col="speed").persist()
    assert p.count() == docs.count()
    total = F.aggregate(F.map_values("tier2.probabilities"), F.lit(0.0), lambda a, x: a + x)
    assert p.filter(F.abs(total - 1) > 1e-6).isEmpty()
    assert {r[0] for r in p.select("svm_label").distinct().collect()} <= set(e.labels.t1)
    meta = e.cluster_meta(spark)
    assert meta.count() == 7 and set(meta.columns) == {"cluster", "x", "y", "t1", "t2"}


def test_save_and_load(spark, engine, tmp_path):
    e, x = engine
    artifacts.save(e, spark, str(tmp_path / "m"))
    again = artifacts.load(spark, str(tmp_path / "m"))
    rows = x.select("chunk_id", "idx", "val")
    assert e.raw_scores(rows).exceptAll(again.raw_scores(rows)).isEmpty()
    text = R.books(spark, "/root/testdata/sf0.001")
    assert e.score(text, "source_id").select("id", "svm_label").exceptAll(
        again.score(text, "source_id").select("id", "svm_label")).isEmpty()
    with pytest.raises(FileNotFoundError):
        artifacts.load(spark, str(tmp_path / "none"))


def test_a_broken_save_leaves_the_last_one_valid(spark, engine, tmp_path, monkeypatch):
    import copy
    e, _ = engine
    path = str(tmp_path / "m")
    first = artifacts.save(e, spark, path)
    other = copy.copy(e)
    other.lemma_map = {"boxes": "box"}

    class Broken:
        def vocab_table(self, spark):
            raise OSError("disk full")

        stop, ngrams, n_rows = (), (1, 3), 0

    broken = copy.copy(other)
    broken.tfidf = Broken()
    with pytest.raises(OSError):
        artifacts.save(broken, spark, path)
    assert artifacts.load(spark, path).lemma_map == e.lemma_map
    second = artifacts.save(other, spark, path)
    assert [f for _, f in artifacts.versions(spark, path)] == [first, second]
    assert artifacts.load(spark, path).lemma_map == {"boxes": "box"} and artifacts.load(spark, path, first).lemma_map == e.lemma_map


def test_stream_equals_batch(spark, sf, engine, tmp_path):
    e, _ = engine
    body = F.to_json(F.struct("text", F.lit("fast").alias("speed")))
    requests = R.books(spark, sf).select(F.col("source_id").alias("id"), body.alias("value"))
    requests.repartition(3, "id").write.parquet(str(tmp_path / "in"))
    run = scoring.start(scoring.read_requests(spark, str(tmp_path / "in"), max_files=1), e,
                        str(tmp_path / "out"), str(tmp_path / "state"), available_now=True, as_json=True)
    run.awaitTermination()
    from windrow.sources.requests import render_responses
    stream = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    refused = spark.read.parquet(str(tmp_path / "out-rejected"))
    assert stream.count() + refused.count() == requests.count()
    batch = render_responses(scoring.score_requests(requests, e))
    assert stream.count() > 0 and stream.exceptAll(batch).isEmpty() and batch.exceptAll(stream).isEmpty()


def test_evaluation_and_reports(spark, sf, engine, tmp_path):
    e, x = engine
    ev = evaluate(e, R.books(spark, sf), R.catalog(spark, sf), R.taxonomy(spark, sf), quota=20)
    assert {r["model"] for r in ev.report.collect()} == {"svm_fast", "svm_slow", "mlp_t1", "mlp_t2"}
    scores = {r["metric"]: r["value"] for r in ev.clusters.collect()}
    assert -1 <= scores["silhouette_sq"] <= 1 and 0 <= scores["homogeneity"] <= 1
    assert ev.scatter.filter("kind = 'centroid'").count() == 7
    assert ev.edge_cases.count() <= 10
    sinks.write_edge_cases(ev.edge_cases, str(tmp_path / "edge"))
    m = engine_metrics(e, x, "2024-01-01 00:00 UTC")
    for run in ("run-1", "run-1", "run-2"):
        sinks.append_metrics(m, str(tmp_path / "metrics"), run)
    kept = spark.read.parquet(str(tmp_path / "metrics")).groupBy("run_id").count().collect()
    assert sorted(map(tuple, kept)) == [("run-1", 14), ("run-2", 14)]


def _lloyd(x, centers, tol=1e-4, most=300):
    for _ in range(most):
        near = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[near == c].mean(0) if (near == c).any() else centers[c] for c in range(len(centers))])
        step, centers = ((moved - centers) ** 2).sum(1).max(), moved
        if step <= tol * tol:
            break
    return ((x[:, None] - centers[None]) ** 2).sum(2).min(1).sum()


def test_every_restart_is_a_plain_lloyd_from_its_seeds(spark):
    from windrow.models import kmeans as K
    from windrow.models.numeric import packed
    rng = np.random.RandomState(3)
    x = np.concatenate([rng.standard_normal((60, 12)) * 0.4 + 3 * rng.standard_normal(12) for _ in range(5)])
    x[rng.random_sample(x.shape) < 0.3] = 0
    rows = [([int(j) for j in np.flatnonzero(r)], [float(v) for v in r[np.flatnonzero(r)]]) for r in x]
    df = spark.createDataFrame(rows, "idx array<int>, val array<double>").repartition(5)
    fit = K.fit_kmeans(df, 12, k=4, restarts=6, seed=9)
    again = K.fit_kmeans(df.repartition(2), 12, k=4, restarts=6, seed=9)
    data, parts = packed(df.withColumn("h", F.xxhash64("idx", "val")), ["idx", "val", "h"], len(x))
    starts = K.seeds(data, parts, 12, 4, 6, 9)
    assert fit.converged and fit.cost == min(fit.costs) and fit.passes <= 60
    assert fit.costs == pytest.approx([_lloyd(x, s) for s in starts])
    assert again.costs == pytest.approx(fit.costs)  # partitions do not matter
    few = K.fit_kmeans(df.limit(2).union(df.limit(2)), 12, k=4, restarts=2)
    assert few.cost == pytest.approx(0) and few.centers.shape == (4, 12)


def test_svm_gap_and_plain_newton(spark, engine):
    e, x = engine
    assert e.svm_slow.converged and e.svm_slow.passes <= 20 and max(e.svm_slow.gaps) <= 1e-6
    from windrow.models import svm as S
    from windrow.models.numeric import Rows
    rng = np.random.RandomState(5)
    dense = np.concatenate([rng.standard_normal((40, 6)) + 2 * c for c in range(3)])
    y = np.repeat([0, 1, 2], 40)
    rows = [(int(c), list(range(6)), [float(v) for v in r]) for c, r in zip(y, dense)]
    df = spark.createDataFrame(rows, "y int, idx array<int>, val array<double>").repartition(3)
    m = S.fit_svm(df, "y", 6, features=32, tol=1e-10)
    offsets = np.arange(0, len(y) * 6 + 1, 6)
    z = S.fourier_map(Rows(offsets, np.tile(np.arange(6), len(y)), dense.ravel()), 6, 32, m.gamma, 42).astype(float)
    z = np.c_[z, np.ones(len(z))]
    for k, (a, b) in enumerate(m.pairs):
        own = np.isin(y, (a, b))
        s, w = np.where(y[own] == a, 1.0, -1.0), np.append(m.coef[k], m.intercept[k])
        miss = np.maximum(0, 1 - s * (z[own] @ w))
        assert np.abs(w - 2 * z[own].T @ (s * miss)).max() < 1e-5  # the gradient vanishes
    assert m.converged and not S.fit_svm(df, "y", 6, features=32, max_iter=1).converged


def test_training_accuracy_flag_on_the_middle_corpus(spark):
    from windrow.queries import models
    row = models.svm_train(spark, "/root/testdata/sf0.01").first()
    assert row["accurate"] and row["some_margin_rows"]


def test_tree_of_factors_is_the_decomposition(spark):
    """Many parts (some without rows), nulls, a large common offset and a nearly flat direction."""
    rng = np.random.RandomState(4)
    x = rng.randn(700, 12) * np.geomspace(30, 1e-5, 12) + 1e4
    table = [(i, r.tolist()) for i, r in enumerate(x)] + [(-1, None)]
    df = spark.createDataFrame(table, "id int, v array<double>")
    want = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    for parts in (1, 3, 23):
        model = PCA.fit_pca_narrow(df.repartition(parts, "id"), "v", k=4)
        assert np.allclose(model.mean, x.mean(axis=0))
        assert np.allclose(model.variance, want[1][:4] ** 2 / 699, rtol=1e-8)
        assert np.allclose(np.abs(np.sum(model.components * want[2][:4].T, axis=0)), 1, atol=1e-9)
        assert np.allclose(model.ratio.sum(), (want[1][:4] ** 2).sum() / (want[1] ** 2).sum())
    few = PCA.fit_pca_narrow(df.filter("id in (1, 2)").coalesce(1), "v", k=3)
    assert few.variance[0] > 0 and few.variance[1] < 1e-9
    with pytest.raises(ValueError):
        PCA.fit_pca_narrow(df.filter("id < 0"), "v")


def test_factor_of_a_single_row():
    one = PCA.Factor.of(np.ones((1, 3)))
    both = one.merged(PCA.Factor.of(np.array([[3.0, 1.0, 1.0]])))
    assert both.n == 2 and np.allclose(both.mean, [2, 1, 1]) and np.allclose(both.r.T @ both.r, np.diag([2.0, 0, 0]))


def _sent_to_driver(spark, monkeypatch, fit) -> int:
    """Bytes of the rows and Arrow tables that a fit collects."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    seen, collect, to_arrow = [0], Frame.collect, Frame.toArrow

    def rows(self):
        got = collect(self)
        seen[0] += sum(len(v) if isinstance(v, bytes | bytearray | str | list) else 8 for r in got for v in r)
        return got

    def table(self):
        got = to_arrow(self)
        seen[0] += got.nbytes
        return got

    monkeypatch.setattr(Frame, "collect", rows)
    monkeypatch.setattr(Frame, "toArrow", table)
    fit()
    monkeypatch.undo()
    return seen[0]


def test_passes_of_the_fits_send_no_model_sized_sums_to_the_driver(spark, monkeypatch):
    from windrow.models.kmeans import fit_kmeans
    from windrow.models.pca import fit_pca_wide
    from windrow.models.svm import fit_svm

    rng = np.random.RandomState(5)
    width, n = 3_000, 240
    rows = [(i % 3, sorted(int(c) for c in rng.choice(width, 20, replace=False)), [float(v) for v in rng.rand(20)]) for i in range(n)]
    df = spark.createDataFrame(rows, "y int, idx array<int>, val array<double>").repartition(6).cache()
    monkeypatch.setattr("windrow.models.kmeans.PASS_ROWS", 32)
    monkeypatch.setattr("windrow.models.svm.PASS_ROWS", 32)
    for fit, one in ((lambda: fit_kmeans(df, width, k=4, restarts=3), 4 * 3 * width * 8), (lambda: fit_svm(df, "y", width, 128), 3 * 129 * 130 // 2 * 8)):
        fits = []
        assert _sent_to_driver(spark, monkeypatch, lambda: fits.append(fit())) < one  # not even one pass of one task
        monkeypatch.setattr("windrow.models.kmeans.PASS_ROWS", 32)
        monkeypatch.setattr("windrow.models.svm.PASS_ROWS", 32)
        assert fits[0].passes > 1 and fits[0].converged
    parts = spark.range(6, numPartitions=6).mapInArrow(lambda bs: (part_rows({"a": np.ones(90_000)}, 1.0) for b in bs if b.num_rows), "name string, block int, weight double, data binary")
    sums = []
    assert _sent_to_driver(spark, monkeypatch, lambda: sums.append(reduce_parts(parts, {"a": (90_000,)}, 6))) < 1.5 * 90_000 * 8
    assert (sums[0]["a"] == 6).all()
    df.unpersist()


def test_one_job_per_epoch_keeps_the_weights_from_the_driver(spark, engine, monkeypatch):
    e, vectors = engine
    args = (vectors, e.tfidf.width, len(e.labels.t1), len(e.labels.t2), "chunk_id")
    fits = []
    sent = _sent_to_driver(spark, monkeypatch, lambda: fits.append(N.fit_mlp(*args, epochs=2, partitions=2, barrier=False)))
    assert sent < fits[0].weights["w1"].nbytes
    monkeypatch.setattr(N.Shelf, "new", classmethod(lambda cls, spark, name, dtype: cls(None, dtype)))
    other = N.fit_mlp(*args, epochs=2, partitions=2, barrier=False)
    assert all(np.allclose(fits[0].weights[k], other.weights[k], atol=1e-6) for k in other.weights)


def test_wide_products_gather_one_row_at_a_time():
    import tracemalloc

    rng = np.random.RandomState(3)
    rows = sparse(rng.rand(256, 400))
    dense = rng.rand(400, 512).astype(np.float32)
    tracemalloc.start()
    got = rows.dot(dense)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * dense.nbytes and np.allclose(got[7], rows.take([7]).dot(dense)[0])


def test_join_query_counts_only_frequent_terms(spark, sf, monkeypatch):
    from windrow.queries import vectors

    monkeypatch.setattr(vectors.V, "pruned_stats", lambda *a, _fn=V.pruned_stats, **k: seen.append(1) or _fn(*a, **k))
    seen = []
    rows = vectors.tfidf_transform_join(spark, sf)
    assert seen and rows.columns == ["chunk_id", "term_idx", "w"] and rows.limit(1).count() == 1
