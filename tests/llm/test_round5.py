"""Findings of the fourth round on the training-data operators."""

from windrow.llm import variants


def test_variants_broadcast_no_neighbourhoods_words_or_roots(spark):
    words = [chr(97 + i) * 3 + chr(97 + j) * 4 for i in range(6) for j in range(6)] + ["x" * 12 + chr(97 + i) for i in range(4)]
    docs = spark.createDataFrame([(i, " ".join(words[: 6 + i])) for i in range(60)], "doc_id long, text string").repartition(3)
    for s in (variants.Settings(carried=9), variants.Settings(crowd=0, carried=9)):
        vocab = variants.written(variants.vocabulary(docs, s), "vocabulary")
        for frame in (variants.near_words(vocab, s), variants.variants(docs, s)):
            assert frame.collect()
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
