"""Projection on the top principal components, for narrow and for wide sparse rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.models.numeric import Rows, packed, sum_over_rows
from windrow.scale import ship

COMPONENTS = 2


@dataclass
class PcaModel:
    mean: np.ndarray
    components: np.ndarray
    variance: np.ndarray
    ratio: np.ndarray
    converged: bool = True

    def project(self, rows: Rows) -> np.ndarray:
        """Centred projection; a row without known terms lands on minus the projected mean."""
        return rows.dot(self.components) - self.mean @ self.components

    def project_dense(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components


def _fix_signs(v: np.ndarray) -> np.ndarray:
    """The largest loading of every component is made positive."""
    top = np.abs(v).argmax(axis=0)
    return v * np.where(v[top, np.arange(v.shape[1])] < 0, -1.0, 1.0)


def fit_pca_wide(df: DataFrame, width: int, k: int = COMPONENTS, extra: int = 4, max_passes: int = 100,
                 tol: float = 1e-4, seed: int = 42) -> PcaModel:
    """Block Krylov iteration (Musco and Musco, 2015) on the centred rows.

    A pass sends a width x (k + extra) block to the tasks and gets the covariance applied to it
    back; rows are never centred or made dense, and no width x width matrix exists anywhere.
    """
    spark = df.sparkSession
    data, tasks = packed(df, ["idx", "val"], df.count())
    first = sum_over_rows(
        data, ["idx", "val"],
        lambda b: _moments(Rows.from_arrow(b), width), {"sum": (width,), "facts": (2,)}, tasks,
    )
    n, squares = first["facts"]
    mean = first["sum"] / n
    total = squares / n - mean @ mean
    block = min(k + extra, width)
    rng = np.random.RandomState(seed)
    basis, images, found, converged = [], [], None, False
    v = np.linalg.qr(rng.standard_normal((width, block)))[0]
    for _ in range(max_passes):
        shared = spark.sparkContext.broadcast(v)

        def apply(b, shared=shared):
            rows, x = Rows.from_arrow(b), shared.value
            return {"y": rows.transposed_dot(rows.dot(x), width)}

        got = sum_over_rows(data, ["idx", "val"], apply, {"y": (width, v.shape[1])}, tasks)
        shared.unpersist()
        image = got["y"] / n - np.outer(mean, mean @ v)
        basis.append(v)
        images.append(image)
        q, aq = np.hstack(basis), np.hstack(images)
        small = q.T @ aq
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
        found = (values, q @ vectors)
        miss = np.linalg.norm(aq @ vectors - found[1] * values, axis=0)
        left = width - q.shape[1]
        if (miss <= tol * np.maximum(values, 1e-30)).all() or left <= 0:
            converged = True
            break
        image = image[:, :left]
        fresh = image - q @ (q.T @ image)
        fresh -= q @ (q.T @ fresh)
        v = np.linalg.qr(fresh)[0]
        v -= q @ (q.T @ v)
        v = np.linalg.qr(v)[0]
    data.unpersist()
    values, components = found
    return PcaModel(mean, _fix_signs(components), values * n / max(n - 1, 1), values / total, converged)


def _moments(rows: Rows, width: int):
    return {"sum": np.bincount(rows.idx, weights=rows.val, minlength=width),
            "facts": np.array([len(rows), float((rows.val * rows.val).sum())])}


# Partial factors that one task of the tree merges, and rows that are factored together.
FAN = 4
STRIP_ROWS = 2048
_FACTOR = "part bigint, n bigint, width int, data binary"


@dataclass
class Factor:
    """Row count, mean and triangular factor R of centred rows: R'R is their scatter matrix."""

    n: int
    mean: np.ndarray
    r: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Factor:
        mean = x.mean(axis=0)
        return cls(len(x), mean, np.linalg.qr(x - mean, mode="r"))

    def merged(self, other: Factor) -> Factor:
        """The factor of both row sets: the step between the means is one more row."""
        n = self.n + other.n
        step = other.mean - self.mean
        bridge = step * np.sqrt(self.n * other.n / n)
        r = np.linalg.qr(np.vstack([self.r, other.r, bridge]), mode="r")
        return Factor(n, self.mean + step * (other.n / n), r)

    def packed(self) -> bytes:
        return np.vstack([self.mean, self.r]).tobytes()

    @classmethod
    def unpacked(cls, n: int, width: int, data: bytes) -> Factor:
        both = np.frombuffer(data, dtype=np.float64).reshape(-1, width)
        return cls(int(n), both[0], both[1:])


def _strips(batches, rows: int):
    """Dense matrices of about ``rows`` rows out of Arrow batches with one list column."""
    held, size = [], 0
    for b in batches:
        lists = b.column(0).drop_null()
        if not len(lists):
            continue
        flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
        for a in range(0, len(flat), rows):
            held.append(flat[a : a + rows])
            size += len(held[-1])
            if size >= rows:
                yield np.vstack(held)
                held, size = [], 0
    if held:
        yield np.vstack(held)


def _factors(batches):
    from pyspark import TaskContext

    total = None
    for x in _strips(batches, STRIP_ROWS):
        total = Factor.of(x) if total is None else total.merged(Factor.of(x))
    if total is not None:
        yield pa.RecordBatch.from_pydict(
            {"part": [TaskContext.get().partitionId()], "n": [total.n], "width": [len(total.mean)], "data": [total.packed()]},
            schema=pa.schema([("part", pa.int64()), ("n", pa.int64()), ("width", pa.int32()), ("data", pa.binary())]))


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("n", kind="stable")
    total = None
    for n, width, data in zip(pdf["n"], pdf["width"], pdf["data"]):
        f = Factor.unpacked(n, width, data)
        total = f if total is None else total.merged(f)
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "n": [total.n], "width": [len(total.mean)], "data": [total.packed()]})


def fit_pca_narrow(df: DataFrame, vec: str, k: int = COMPONENTS) -> PcaModel:
    """PCA of dense vectors of up to some thousand dimensions by a tree of QR factors.

    Every task factors its rows strip by strip; the triangular factors are merged ``FAN`` at a time
    and the last one is decomposed in a task, so no width x width matrix reaches the driver and the
    condition is that of the rows, not of their covariance. Null vectors take no part; an empty table
    raises ``ValueError``.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(vec).cast("array<double>").alias("v"))
    parts, left = rows.mapInArrow(_factors, _FACTOR), rows.rdd.getNumPartitions()
    while left > 1:
        left = -(-left // FAN)
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("part").applyInPandas(_merge, _FACTOR)

    def decompose(batches):
        for b in batches:
            for n, width, data in zip(*(b.column(c).to_pylist() for c in ("n", "width", "data"))):
                f = Factor.unpacked(n, width, data)
                _, size, right = np.linalg.svd(f.r, full_matrices=False)
                found = np.zeros((width, k))
                variance = np.zeros(k)
                got = min(k, len(size))
                found[:, :got], variance[:got] = right[:got].T, size[:got] ** 2 / max(n - 1, 1)
                out = [f.mean.tolist(), found.ravel().tolist(), variance.tolist(), float((size**2).sum() / max(n - 1, 1))]
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in out], names=["mean", "components", "variance", "total"])

    last = parts.mapInArrow(decompose, "mean array<double>, components array<double>, variance array<double>, total double").first()
    if last is None:
        raise ValueError("no vectors to decompose")
    variance = np.array(last["variance"])
    components = _fix_signs(np.array(last["components"]).reshape(-1, k))
    return PcaModel(np.array(last["mean"]), components, variance, variance / (last["total"] or 1.0))


def project(df: DataFrame, vec: str, model: PcaModel) -> DataFrame:
    """Add ``pca_x`` and ``pca_y`` of a dense vector column, inside the JVM."""
    shift = model.mean @ model.components

    def axis(j: int):
        load = F.array(*[F.lit(float(x)) for x in model.components[:, j]])
        terms = F.zip_with(F.col(vec), load, lambda a, b: a.cast("double") * b)
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) - F.lit(float(shift[j]))

    return df.select("*", axis(0).alias("pca_x"), axis(1).alias("pca_y"))
