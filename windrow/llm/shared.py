"""What the operators share: written tables, byte words, word ids, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.scale import checkpoint_dir, ship

# Words of all word-based operators are runs of anything but space and \t \n \v \f \r.
WORD = r"[^ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/windrow-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folded(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and one struct of all others, so that their names clash with none."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in keep]
    return docs.select(*keep, (F.struct(*others) if others else F.lit(None).cast("int")).alias("_others"))


def unfolded(docs: DataFrame, names: list[str], *keep: str) -> DataFrame:
    """The original columns of a folded frame, in the order ``names``."""
    return docs.select(*(F.col(c) if c in keep else F.col("_others").getField(c).alias(c) for c in names))


def small(side: DataFrame, rows: int, most: int = 100_000) -> DataFrame:
    """Broadcast a join side of a known number of rows if that is at most ``most``; else Spark decides."""
    return F.broadcast(side) if rows <= most else side


def word_count(col) -> F.Column:
    """Words of a text column as a long; null text has none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("bigint")


def pieces(batch: pa.RecordBatch, rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """A batch in slices of ``rows`` rows, so that only few texts are Python objects at a time."""
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def per_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with one function per task; ``make`` runs in the task."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield from map(step, pieces(batch))

    return df.mapInArrow(run, schema)


_BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def bound_batches(spark: SparkSession) -> dict[str, str]:
    """Send texts to Python workers in batches of at most 1,000 rows and about 4 MB, where the session
    has larger ones; an executor holds several batches at a time. Returns the settings before."""
    before = {key: spark.conf.get(key) for key in _BATCH_LIMITS}
    for key, most in _BATCH_LIMITS.items():
        if not (before[key].isdigit() and 0 < int(before[key]) <= most):
            spark.conf.set(key, most)
    return before


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """``bound_batches`` for the jobs inside; the settings come back afterwards."""
    before = bound_batches(spark)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The text column as UTF-8 bytes; a null text is empty."""
    col = column(batch, name)
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [t or b"" for t in col.cast(kind).to_pylist()]


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column as strings; a null text is empty."""
    return [t.decode("utf-8", "replace") for t in text_bytes(batch, name)]


def word_ids(words: list[bytes]) -> np.ndarray:
    """A 64-bit id of each word; hashing is cheaper than looking up a large dictionary."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (wraps on purpose)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """Rolling 64-bit hashes of every n consecutive ids (none if there are fewer)."""
    count = len(ids) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = total * _MULTIPLY + ids[k : k + count]
    return mixed(total)
