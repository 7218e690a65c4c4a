"""The pipeline's stages on the small corpus: every decision takes effect, nothing else is lost."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.test_operators import CLASH, ODD, cut_by_force, groups_by_force
from windrow.llm import langid, registered
from windrow.llm.shared import table, written


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    start, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), name)
        assert docs.columns == start
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] > 0.97 * sizes[0]  # clean documents stay
    assert sizes[1] >= sizes[2] >= sizes[3] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
    assert packed.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").count() == 0


def test_each_stage_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    stages = dict(corpus_pipeline.STAGES)
    known = written(stages["language_id"](spark, docs, sf), "t1")
    sure = {r["doc_id"] for r in langid.languages(docs).collect() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert {r["doc_id"] for r in known.collect()} == sure

    data = [(r["doc_id"], r["text"]) for r in known.collect()]
    cut = cut_by_force(data, 50)
    left = {}
    for key in data:
        lines = [x for i, x in enumerate(key[1].split("\n")) if i not in cut[key]]
        if lines:
            left[key[0]] = "\n".join(lines)
    lines = written(stages["line_dedup"](spark, known, sf), "t2")
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == left

    first = {d for d, _, component in groups_by_force(list(left.items()), 80) if d == component}
    near = written(stages["near_dedup"](spark, lines, sf), "t3")
    assert {r["doc_id"]: r["text"] for r in near.collect()} == {d: left[d] for d in first}


def test_empty_corpus(spark, sf):
    docs = table(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_all_operators_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in registered.QUERIES) == list(range(1, 14))


def test_stages_in_a_row_on_odd_rows(spark, sf):
    """Null, empty and very long texts, repeated rows, null ids and sources, extra columns with clashing names."""
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string").repartition(3)
    docs = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH)))
    columns, texts = docs.columns, {(d, t) for d, t, *_ in ODD}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), name)
        assert docs.columns == columns
        now = {(r["doc_id"], r["text"]) for r in docs.collect()}
        assert now <= texts and not any(t is None or not t.strip() for _, t in now)  # short lines repeat here, so no text is cut
        texts = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r["doc_id"] for r in packed} == {d for d, _ in texts} and all(0 < r["length"] <= 2048 for r in packed)
