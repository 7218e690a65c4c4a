"""Reading labelled source texts: files, candidate copies, byte decoding, rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from windrow.functions import text as T


def read_books(spark: SparkSession, path: str, pattern: str = r"(\d+)[^/]*$") -> DataFrame:
    """``books(source_id, text)``: one whole text file per row, id taken from the file name."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).cast("bigint").alias("source_id"),
        F.col("value").alias("text"),
    )


def read_book_bytes(spark: SparkSession, path: str, pattern: str = r"(\d+)[^/]*$") -> DataFrame:
    """``books(source_id, content binary)``, for sources whose encoding must be found out."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.regexp_extract("path", pattern, 1).cast("bigint").alias("source_id"), "content"
    )


def decode_fallback(content, min_chars: int = T.MIN_SOURCE_CHARS) -> Column:
    """UTF-8 when valid and longer than ``min_chars`` characters, else Latin-1 when the bytes
    are more than that, else null. A short valid UTF-8 text with enough bytes therefore comes
    back as Latin-1: Latin-1 accepts every byte string.
    """
    c = F.col(content) if isinstance(content, str) else content
    raw = c.cast("string")
    return (
        F.when(F.is_valid_utf8(raw) & (F.length(raw) > min_chars), raw)
        .when(F.length(c) > min_chars, F.decode(c, "ISO-8859-1"))
    )


def first_valid_candidate(
    candidates: DataFrame, key: str, rank: str, content: str, valid: Column
) -> DataFrame:
    """``(key, content)``: the best-ranked valid copy of every source, null if none is valid.

    The best rank is a narrow aggregation, reduced map-side; contents are then looked up by key
    and rank, so no content is sorted or carried through the aggregation. Ranks are unique within a
    key.
    """
    best = candidates.groupBy(key).agg(F.min(F.when(valid, F.col(rank))).alias("_rank"))
    copies = candidates.filter(valid).select(F.col(key).alias("_key"), F.col(rank).alias("_own"), content)
    met = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_rank") == F.col("_own"))
    found = best.hint("shuffle_hash").join(copies, met, "left")
    return found.select(key, content)


def ingest(books: DataFrame, content: str = "text") -> DataFrame:
    """``books`` with boilerplate stripped from every text; unreadable sources go.

    Bytes are decoded first. Candidate copies are reduced by :func:`first_valid_candidate` before.
    """
    return stripped(decoded(books, content), content)


def decoded(books: DataFrame, content: str = "text", min_chars: int = T.MIN_SOURCE_CHARS) -> DataFrame:
    """``books`` with bytes as text, null where there is none; text stays as it is."""
    if isinstance(books.schema[content].dataType, BinaryType):
        return books.withColumn(content, decode_fallback(content, min_chars))
    return books


def stripped(books: DataFrame, content: str = "text") -> DataFrame:
    """The readable rows, without boilerplate."""
    return readable(books, content).withColumn(content, T.strip_boilerplate(content))


def readable(books: DataFrame, content: str = "text") -> DataFrame:
    return books.filter(F.col(content).isNotNull())


def rejects(books: DataFrame, content: str = "text") -> DataFrame:
    return books.filter(F.col(content).isNull()).drop(content)
