"""Fixed-size word windows over documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions import text as T


def chunk_count(words: Column, size: int) -> Column:
    return F.floor(F.coalesce(F.size(words), F.lit(0)) / size).cast("int")


def window_at(words: Column, index: Column, size: int) -> Column:
    return F.array_join(F.slice(words, index * size + 1, F.lit(size)), " ")


def chunk_fixed(
    docs: DataFrame,
    id_col: str = "source_id",
    text_col: str = "text",
    size: int = T.CHUNK_WORDS,
    offset: int = 0,
) -> DataFrame:
    """``(source_id, pos, text)``: consecutive windows of exactly ``size`` words.

    A shorter tail is dropped. ``offset`` leaves out that many leading words of every
    document that has more. Other columns of ``docs`` are kept.
    """
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    cut = docs.select(
        F.col(id_col).alias("source_id"), *rest, T.shifted(T.words(text_col), offset).alias("_w")
    )
    # No filter on the word count: it would be pushed below and split every text twice.
    windows = F.when(F.size("_w") >= size, F.transform(
        F.sequence(F.lit(0), chunk_count(F.col("_w"), size) - 1),
        lambda i: window_at(F.col("_w"), i, size),
    ))
    return cut.select("source_id", *rest, F.posexplode(windows).alias("pos", "text"))


def chunk_counts(
    docs: DataFrame,
    id_col: str = "source_id",
    text_col: str = "text",
    size: int = T.CHUNK_WORDS,
    offset: int = 0,
) -> DataFrame:
    """``(source_id, n)`` without building any window text; unreadable sources are skipped."""
    return docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("source_id"),
        chunk_count(T.shifted(T.words(text_col), offset), size).alias("n"),
    )
