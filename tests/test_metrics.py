import numpy as np
import pytest
from pyspark.sql import functions as F

from windrow.operators import clustering as K
from windrow.operators import metrics as M
from windrow.operators.tfidf import with_vector


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "y_true int, y_pred int")


def test_class_never_predicted_and_label_only_predicted(spark):
    df = scored(spark, [(0, 0), (0, 0), (1, 0), (1, 2)])
    r = M.macro_metrics(df).first()
    # Labels 0, 1, 2: precision 2/3, 0, 0; recall 1, 0, 0.
    assert r["accuracy"] == 0.5
    assert r["precision"] == pytest.approx(round(2 / 9, 4))
    assert r["recall"] == pytest.approx(round(1 / 3, 4))
    assert r["f1_macro"] == pytest.approx(round(0.8 / 3, 4))
    m = {x["y_true"]: x for x in M.confusion_matrix(df, [0, 1, 2]).collect()}
    assert m[2].asDict() == {"y_true": 2, "pred_0": 0, "pred_1": 0, "pred_2": 0}
    assert m[1]["pred_2"] == 1


def test_entropy_scores_at_the_edges(spark):
    one_class = spark.createDataFrame([(0, 0), (0, 1)], "y_true int, cluster int")
    assert K.homogeneity_completeness(one_class).first()["homogeneity"] == 1.0
    one_cluster = spark.createDataFrame([(0, 0), (1, 0)], "y_true int, cluster int")
    r = K.homogeneity_completeness(one_cluster).first()
    assert r["completeness"] == 1.0 and r["homogeneity"] == pytest.approx(0.0)


def test_majority_tie_takes_lowest_code(spark):
    df = spark.createDataFrame([(0, 5), (0, 2), (0, 5), (0, 2), (1, 3)], "cluster int, y_true int")
    assert {r["cluster"]: r["majority"] for r in K.cluster_majority(df).collect()} == {0: 2, 1: 3}


def brute_silhouette(x, k, squared):
    return float(np.mean(brute_silhouettes(x, k, squared)))


def brute_silhouettes(x, k, squared):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    d = d if squared else np.sqrt(d)
    out = []
    for i in range(len(x)):
        own = k == k[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, k == c].mean() for c in set(k) - {k[i]})
        out.append((b - a) / max(a, b))
    return out


def test_silhouettes_against_brute_force(spark):
    rng = np.random.RandomState(1)
    x = rng.rand(40, 6) * (rng.rand(40, 6) > 0.4)
    k = np.array([0] * 15 + [1] * 14 + [2] * 10 + [3])
    dense = spark.createDataFrame([(x[i].tolist(), int(k[i])) for i in range(40)], "v array<double>, cluster int")
    assert K.silhouette_squared(dense, "v") == pytest.approx(brute_silhouette(x, k, True))
    sparse = spark.createDataFrame(
        [([int(j) for j in np.flatnonzero(r)], [float(z) for z in r[np.flatnonzero(r)]], int(c)) for r, c in zip(x, k)],
        "idx array<int>, val array<double>, cluster int")
    for rows in (sparse, K.sparse_form(dense, "v")):
        per_row = K.silhouette_rows(rows.withColumn("id", F.monotonically_increasing_id()), 6)
        got = [r["silhouette"] for r in per_row.orderBy("id").collect()]
        assert got == pytest.approx(brute_silhouettes(x, k, True))
    odd = sparse.limit(3).unionByName(spark.createDataFrame([(None, None, 1), ([0], [1.0], None)], sparse.schema))
    assert sorted(str(r["silhouette"]) for r in K.silhouette_rows(odd, 6).collect()) == ["0.0"] * 3 + ["None"] * 2  # one cluster only
    assert K.silhouette_rows(sparse.limit(0), 6).count() == 0
    vectors = with_vector(sparse, 6)
    assert K.silhouette_squared(vectors, "features") == pytest.approx(brute_silhouette(x, k, True))


def test_weighted_loss(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5]), (1, [0.9, 0.1])], "y int, p array<double>")
    want = (np.log(2) + 1.4 * -np.log(0.1)) / 2.4
    assert M.weighted_cross_entropy(df, "y", "p", {1: 1.4}).first()["loss"] == pytest.approx(want)
