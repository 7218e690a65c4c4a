from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from windrow import taxonomy as X
from windrow.operators import balance, integrity, ordering
from windrow.operators.sampling import fast_subset
from windrow.sources import catalog as C

HIERARCHY = [("A", ["a1", "a2"]), ("B", ["b1"])]


def make(spark, sizes, order=None):
    """Books of the given window counts per class, in catalogue order."""
    books, catalog, sid = [], [], 0
    for t2, counts in sizes.items():
        for seq, n in enumerate(counts, 1):
            text = None if n is None else " ".join(f"{t2}.{sid}.{i}" for i in range(n * 3 + 1))
            books.append((sid, text))
            catalog.append((t2, seq, sid))
            sid += 1
    return (spark.createDataFrame(books, "source_id bigint, text string"),
            spark.createDataFrame(catalog, "t2 string, seq bigint, source_id bigint"),
            X.taxonomy_table(spark, HIERARCHY))


def brute(sizes, quota):
    pools = {}
    sid = 0
    for t2, counts in sizes.items():
        pool = []
        for n in counts:
            pool += [(sid, i) for i in range(n or 0)][: max(0, quota - len(pool))]
            sid += 1
        pools[t2] = pool
    return pools


SIZES = [
    {"a1": [3, None, 4, 2], "a2": [1, 1, 1, 9], "b1": [20]},
    {"a1": [0, 0, 5], "a2": [2], "b1": [1] * 12},
    {"a1": [5], "a2": [], "b1": [5]},
]


@pytest.mark.parametrize("sizes", SIZES)
@pytest.mark.parametrize("quota", [1, 5, 100])
def test_fill_and_parity(spark, monkeypatch, sizes, quota):
    monkeypatch.setattr(ordering, "RANGE_ROWS", 2)
    books, catalog, tax = make(spark, sizes)
    counts = balance.source_counts(books, catalog, size=3)
    pools = brute(sizes, quota)
    least = min(len(pools[t]) for t in ("a1", "a2", "b1"))

    def rows(df):
        out = defaultdict(list)
        for r in df.orderBy("t2_idx", "seq", "pos").collect():
            out[["a1", "a2", "b1"][r["t2_idx"]]].append((r["source_id"], r["pos"]))
            assert len(r["text"].split()) == 3
        return out

    got = rows(balance.quota_fill(books, counts, tax, quota, size=3))
    assert {k: got[k] for k in pools} == pools
    early = balance.counts_until_full(books, catalog, quota, size=3, first=1, growth=2)
    got = rows(balance.quota_fill(books, early, tax, quota, size=3))
    assert {k: got[k] for k in pools} == pools
    even = rows(balance.balanced(books, counts, tax, quota, size=3))
    assert {k: even[k] for k in pools} == {k: v[:least] for k, v in pools.items()}
    audit = {r["t2"]: r for r in balance.audit_table(balance.pool_sizes(counts, tax, quota), quota).collect()}
    assert audit["TOTAL"]["n"] == 3 * least == audit["TOTAL"]["expected"]
    assert audit["a1"]["note"] == (f"DEGRADED to {least}" if least < quota else f"TARGET MET: {least}")


def test_a_small_quota_reads_few_sources(spark):
    books, catalog, tax = make(spark, {"a1": [1] * 50, "a2": [3] * 50, "b1": [0, 2] * 25})
    counts = balance.counts_until_full(books, catalog, 2, size=3, first=2, growth=2)
    assert {r["t2"]: r["count"] for r in counts.groupBy("t2").count().collect()} == {"a1": 2, "a2": 2, "b1": 2}
    plan = balance.quota_fill(books, counts, tax, 2, size=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "source_id" in plan and ">=" in plan and "<=" in plan


def test_numbering_of_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGE_ROWS", 16)
    rows = [("hot", i * i) for i in range(400)] + [("cold", i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, k bigint").repartition(7)
    got = ordering.number_in_group(df, "g", "k").collect()
    assert {(r["g"], r["k"]): r["seq"] for r in got} == {
        **{("hot", i * i): i + 1 for i in range(400)}, **{("cold", i): i + 1 for i in range(5)}}


def test_catalog_keeps_empty_classes(spark):
    _, catalog, tax = make(spark, SIZES[2])
    got = {(r["t2"], r["source_id"]) for r in C.scan(catalog, tax).collect()}
    assert got == {("a1", 0), ("b1", 1), ("a2", None)}


def test_default_taxonomy(spark):
    lab = X.labels_of(X.taxonomy_table(spark))
    assert lab.parent == (0, 0, 1, 1, 2, 2, 2) and lab.t2[5] == "Nihilism"
    assert X.catalog_table(spark).groupBy("t2").count().filter("count <> 10").isEmpty()


def test_fast_subset_is_exact_and_stable(spark):
    df = spark.range(1003).repartition(5)
    a = {r["id"] for r in fast_subset(df, "id", 7).collect()}
    b = {r["id"] for r in fast_subset(df.repartition(3), "id", 7).collect()}
    assert a == b and len(a) == 250
    assert len(fast_subset(spark.range(2), "id").collect()) == 1
    assert fast_subset(spark.range(0), "id").isEmpty()


def test_integrity(spark):
    rows = [(0, 0, "x")] * 4 + [(0, 1, " ")] + [(1, 2, None)]
    corpus = spark.createDataFrame(rows, "t1_idx int, t2_idx int, text string")
    got = {r["name"]: (r["status"], r["detail"]) for r in integrity.integrity_report(corpus).collect()}
    assert got["Duplicate Check"] == ("WARNING", "3 exact duplicates found")
    assert got["Missing Values"] == ("WARNING", "2 null/empty samples")
    assert got["Class Imbalance (T1)"] == ("WARNING", "Ratio max/min = 5.0")
    assert got["Data Drift"][0] == "SKIPPED"
    again = {r["name"]: r["status"] for r in integrity.integrity_report(corpus, corpus).collect()}
    assert again["Data Drift"] == "PASSED"
    report = integrity.integrity_report(corpus)
    assert integrity.integrity_verdict(report) and not integrity.integrity_verdict(report, strict=True)


def test_numbering_of_very_large_groups(spark, monkeypatch):
    """A group of more than GRID * RANGE_ROWS rows is cut in several levels."""
    monkeypatch.setattr(ordering, "RANGE_ROWS", 8)
    monkeypatch.setattr(ordering, "GRID", 4)
    df = spark.range(700).select((F.col("id") % 7 == 0).cast("int").alias("g"), (F.col("id") * 37 % 701).alias("k"))
    got = ordering.number_in_group(df, "g", "k")
    assert got.columns == ["g", "k", "seq"]
    for g in (0, 1):
        rows = sorted((r["k"], r["seq"]) for r in got.filter(F.col("g") == g).collect())
        assert [s for _, s in rows] == list(range(1, len(rows) + 1))
