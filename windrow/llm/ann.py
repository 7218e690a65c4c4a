"""Nearest vectors by a block matrix join with int8 tiles and error bounds.

Queries and candidates are dealt into blocks; a task multiplies one query block with one
candidate block. Vectors are scaled to length one and rounded to int8 with a scale each; the
length of the rounding error is known exactly, so every product comes with a bound. Pairs whose
upper bound reaches the k-th lower bound of their query survive and are computed anew in double
precision; each tile hands on k pairs a query, and heaps merge the tiles' lists. The result is
exact. Products of int8 values are summed in single-precision matrix products, which are exact
up to 1,000 dimensions; longer vectors are summed in double precision.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows without an id; vectors of different lengths are never compared. A repeated candidate row is
a candidate of its own; of repeated query ids the smallest vector asks. Ties go to the smaller
id. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.scale import ship

_FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    sound = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    some = F.exists("embedding", lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").filter(F.col("vec_id").isNotNull() & sound & some)


def unit_scale(v: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two (exact) so that squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(v).max(1))
    return np.ldexp(v, -exponent[:, None])


class Rounded:
    """int8 form of unit vectors with the length of the rounding error."""

    def __init__(self, v: np.ndarray):
        self.norm = np.sqrt(np.einsum("ij,ij->i", v, v))
        unit = v / self.norm[:, None]
        self.scale = np.abs(unit).max(1) / 127
        self.codes = np.rint(unit / self.scale[:, None]).astype(np.int8)
        back = self.codes * self.scale[:, None]
        self.error = np.sqrt(((unit - back) ** 2).sum(1))
        self.length = np.sqrt((back**2).sum(1))

    def values(self) -> np.ndarray:
        return self.codes.astype(np.float32 if self.codes.shape[1] <= 1000 else np.float64)


def tile(q_ids, q, c_ids, c, k: int, step: int = 128, pairs: int = 32_768) -> tuple[np.ndarray, ...]:
    """The k nearest of the candidate block for every query of the query block."""
    left, right = Rounded(q), Rounded(c)
    codes = np.ascontiguousarray(right.values().T)
    out: list[tuple[np.ndarray, ...]] = []
    for a in range(0, len(q), step):
        own = slice(a, a + step)
        near = (left.values()[own] @ codes).astype(np.float64) * left.scale[own, None] * right.scale
        slack = left.length[own, None] * right.error + left.error[own, None] + 1e-9
        itself = q_ids[own, None] == c_ids
        low = np.where(itself, -np.inf, near - slack)
        keep = min(k, low.shape[1])
        cut = np.partition(low, low.shape[1] - keep, axis=1)[:, low.shape[1] - keep]
        rows, cols = np.nonzero((near + slack >= cut[:, None]) & ~itself)
        score = np.empty(len(rows))
        for b in range(0, len(rows), pairs):
            i, j = rows[b : b + pairs] + a, cols[b : b + pairs]
            score[b : b + pairs] = np.einsum("ij,ij->i", q[i], c[j]) / (left.norm[i] * right.norm[j])
        order = np.lexsort((c_ids[cols], -score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        first = np.searchsorted(rows, rows, side="left")
        best = np.arange(len(rows)) - first < k
        out.append((q_ids[own][rows[best]], c_ids[cols[best]], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _search_tile(k: int):
    def run(table):
        asks = np.array(table.column("asks").to_pylist(), bool)
        ids = table.column("vec_id").to_numpy().astype(np.int64)
        lists = table.column("embedding").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        width = int(sizes[0])
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
        flat = unit_scale(flat)
        if asks.any() and not asks.all():
            found = tile(ids[asks], flat[asks], ids[~asks], flat[~asks], k)
        else:
            found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    return run


def _merge(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for query, vec, score in zip(*(batch.column(i).to_pylist() for i in range(3))):
                heap = heaps.setdefault(query, [])
                if len(heap) < k:
                    heapq.heappush(heap, (score, -vec))
                else:
                    heapq.heappushpop(heap, (score, -vec))
        rows = [(q, r, -v, s) for q, heap in heaps.items() for r, (s, v) in enumerate(sorted(heap, reverse=True), 1)]
        cols = list(zip(*rows)) or [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["query_id", "rank", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, asks: Column, k: int = 5, block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest cosines of every row for which ``asks`` holds,
    against all other rows. ``block`` is the number of rows of a block on either side."""
    ship(vectors.sparkSession)
    sound = usable(vectors)
    n, q = sound.agg(F.count(F.lit(1)), F.count(F.when(asks, 1))).first()
    groups, parts = max(1, -(-n // block)), max(1, -(-q // block))
    place = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    width = F.size("embedding").alias("width")
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    queries = sound.filter(asks).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    left = queries.select(F.lit(True).alias("asks"), "vec_id", "embedding", width, place(parts).alias("part"), spread(groups).alias("grp"))
    right = sound.select(F.lit(False).alias("asks"), "vec_id", "embedding", width, spread(parts).alias("part"), place(groups).alias("grp"))
    tiles = left.unionByName(right).groupBy("grp", "part", "width").applyInArrow(_search_tile(k), _FOUND)
    return tiles.repartition("query_id").mapInArrow(_merge(k), "query_id bigint, rank int, vec_id bigint, score double")
