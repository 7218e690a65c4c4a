"""Array helpers that run inside tasks, and the distributed sums of partial arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.scale import checkpoint_dir, share, ship

# Values of a partial array that travel in one row of the reduction.
BLOCK = 1 << 16
# Number of partials, and bytes of all of them, that are simply added after collecting them.
FEW_PARTS = 8
FEW_BYTES = 1 << 18
# Rows that a task of an iterative fit should at least hold.
TASK_ROWS = 4096
PART_SCHEMA = "name string, block int, weight double, data binary"


def packed(df: DataFrame, columns: list[str], n_rows: int, task_rows: int = TASK_ROWS) -> tuple[DataFrame, int]:
    """Shared training rows in no more partitions than pay off, and that number.

    Iterative fits run many short jobs, so tasks with a handful of rows cost more than they
    do. Coalescing never adds partitions: large inputs keep theirs. The rows are written to the shared
    folder first: every job of a fit would otherwise plan all that made them again, which took
    longer than its tasks.
    """
    checkpoint_dir(df.sparkSession)
    rows = share(df.select(*columns).coalesce(max(1, -(-n_rows // task_rows))).checkpoint())
    return rows, rows.rdd.getNumPartitions()


class Rows:
    """Sparse rows of one Arrow batch: offsets, column indices, values."""

    def __init__(self, offsets, idx, val):
        self.offsets, self.idx, self.val = offsets, idx, val

    @classmethod
    def from_arrow(cls, batch: pa.RecordBatch, idx="idx", val="val") -> "Rows":
        i = batch.column(batch.schema.get_field_index(idx))
        v = batch.column(batch.schema.get_field_index(val))
        offsets = i.offsets.to_numpy() - i.offsets[0].as_py() if len(i) else np.zeros(1, np.int32)
        return cls(offsets, i.flatten().to_numpy(), v.flatten().to_numpy(zero_copy_only=False))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, order) -> "Rows":
        starts, sizes = self.offsets[:-1][order], np.diff(self.offsets)[order]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        pick = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
        return Rows(offsets, self.idx[pick], self.val[pick])

    def parts(self, rows: int):
        for a in range(0, len(self), rows):
            b = min(a + rows, len(self))
            lo, hi = self.offsets[a], self.offsets[b]
            yield a, Rows(self.offsets[a : b + 1] - lo, self.idx[lo:hi], self.val[lo:hi])

    def row_ids(self):
        return np.repeat(np.arange(len(self)), np.diff(self.offsets))

    def dot(self, dense: np.ndarray, rows: int = 256) -> np.ndarray:
        """Sparse rows times a dense matrix.

        With few columns in strips, so the gathered values stay small; with many row by row, so they stay
        in the processor's cache.
        """
        out = np.zeros((len(self), dense.shape[1]), dtype=dense.dtype)
        if dense.shape[1] > 16:
            val = self.val.astype(dense.dtype, copy=False)
            for i in np.flatnonzero(np.diff(self.offsets)):
                a, b = self.offsets[i], self.offsets[i + 1]
                np.einsum("i,ij->j", val[a:b], dense.take(self.idx[a:b], 0), out=out[i])
            return out
        for a, part in self.parts(rows):
            if len(part.idx) == 0:
                continue
            gathered = dense[part.idx] * part.val[:, None].astype(dense.dtype)
            full = np.flatnonzero(np.diff(part.offsets))
            out[a + full] = np.add.reduceat(gathered, part.offsets[:-1][full], axis=0)
        return out

    def transposed_dot(self, dense: np.ndarray, width: int, rows: int = 256) -> np.ndarray:
        """Transpose of the sparse rows times a dense matrix with one row per sparse row.

        A few columns are binned one by one; many columns are cheaper as matrix products of
        dense strips of at most ``rows`` rows.
        """
        if dense.shape[1] <= 16:
            at = self.row_ids()
            cols = [np.bincount(self.idx, weights=self.val * dense[at, j], minlength=width)
                    for j in range(dense.shape[1])]
            return np.stack(cols, axis=1)
        out = np.zeros((width, dense.shape[1]), dtype=dense.dtype)
        for a, part in self.parts(rows):
            strip = np.zeros((len(part), width), dtype=dense.dtype)
            strip[part.row_ids(), part.idx] = part.val
            out += strip.T @ dense[a : a + len(part)]
        return out

    def compact(self, dtype) -> tuple[np.ndarray, np.ndarray]:
        """The columns that occur and the rows as a dense matrix over just those; for small batches."""
        cols, at = np.unique(self.idx, return_inverse=True)
        dense = np.zeros((len(self), len(cols)), dtype=dtype)
        dense[self.row_ids(), at] = self.val
        return cols, dense

    def squared_norms(self) -> np.ndarray:
        return np.bincount(self.row_ids(), weights=self.val * self.val, minlength=len(self))


def part_rows(arrays: dict[str, np.ndarray], weight: float, dtype=np.float64):
    """Cut arrays into blocks for :func:`reduce_parts`, carried as ``dtype``."""
    names, blocks, data = [], [], []
    for name, array in arrays.items():
        flat = np.ascontiguousarray(array, dtype=dtype).ravel()
        for b in range(0, max(1, len(flat)), BLOCK):
            names.append(name)
            blocks.append(b // BLOCK)
            data.append(flat[b : b + BLOCK].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array(blocks, pa.int32()),
         pa.array([float(weight)] * len(names)), pa.array(data, pa.binary())],
        names=["name", "block", "weight", "data"],
    )


def reduce_parts(
    parts: DataFrame, shapes: dict[str, tuple], partitions: int, mean: bool = False, dtype=np.float64
) -> dict[str, np.ndarray]:
    """Sum (or weighted mean) of the partial arrays that ``partitions`` tasks emit.

    Partials are added per block in two rounds, so a task sees about the square root of the
    partition count in blocks; only one array of each name is collected. A few small partials are
    added where they are collected.
    """
    fan = max(1, int(partitions**0.5))
    size = partitions * sum(int(np.prod(shape)) for shape in shapes.values()) * np.dtype(dtype).itemsize

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total, weight = None, 0.0
        for d, w in zip(pdf["data"], pdf["weight"]):
            x = np.frombuffer(d, dtype=dtype)
            total = x.copy() if total is None else total + x
            weight += w
        head = pdf.iloc[0]
        return pd.DataFrame({"name": [head["name"]], "block": [head["block"]], "weight": [weight],
                             "data": [total.tobytes()]})

    if partitions <= FEW_PARTS and (partitions == 1 or size <= FEW_BYTES):
        return _assemble(_add_rows(parts.toArrow(), dtype), shapes, mean)
    if fan > 2:
        keyed = parts.withColumn("fan", F.pmod(F.xxhash64("name", "block", "weight", "data"), F.lit(fan)))
        parts = keyed.groupBy("name", "block", "fan").applyInPandas(add, PART_SCHEMA)
    done = parts.groupBy("name", "block").applyInPandas(add, PART_SCHEMA).toArrow()
    return _assemble(_add_rows(done, dtype), shapes, mean)


def _add_rows(table: pa.Table, dtype) -> dict[tuple, list]:
    out: dict[tuple, list] = {}
    for name, block, weight, data in zip(*(table.column(c) for c in ("name", "block", "weight", "data"))):
        x, key, w = np.frombuffer(data.as_buffer(), dtype=dtype), (name.as_py(), block.as_py()), weight.as_py()
        if key in out:
            out[key] = [out[key][0] + x, out[key][1] + w]
        else:
            out[key] = [x, w]
    return out


def _assemble(blocks: dict[tuple, list], shapes, mean: bool) -> dict[str, np.ndarray]:
    out = {}
    for name, shape in shapes.items():
        mine = [blocks[k] for k in sorted(k for k in blocks if k[0] == name)]
        flat = np.concatenate([x for x, _ in mine]) if mine else np.zeros(int(np.prod(shape)))
        if mean and mine:
            flat = flat / mine[0][1]
        out[name] = flat.reshape(shape)
    return out


def sum_over_rows(
    df: DataFrame, columns: list[str], fn, shapes: dict[str, tuple], partitions: int
) -> dict[str, np.ndarray]:
    """Sum of ``fn(batch) -> {name: array}`` over all Arrow batches of ``df``.

    Each task adds its batches up and emits one partial; partials are reduced on the executors.
    """
    ship(df.sparkSession)

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            got = fn(batch)
            if total is None:
                total = {k: np.asarray(v, dtype=np.float64) for k, v in got.items()}
            else:
                for k, v in got.items():
                    total[k] = total[k] + v
        if total is not None:
            yield part_rows(total, 1.0)

    return reduce_parts(df.select(*columns).mapInArrow(run, PART_SCHEMA), shapes, partitions)


NAMED_SCHEMA = "name string, weight double, data binary"


def named_rows(arrays: dict[str, tuple[float, np.ndarray]], dtype=np.float64) -> pa.RecordBatch:
    """One row per named ``(weight, array)``, for :func:`sums_by_name`."""
    return pa.RecordBatch.from_arrays(
        [pa.array(list(arrays), pa.string()), pa.array([float(w) for w, _ in arrays.values()], pa.float64()),
         pa.array([np.ascontiguousarray(a, dtype=dtype).tobytes() for _, a in arrays.values()], pa.binary())],
        names=["name", "weight", "data"])


def sums_by_name(parts: DataFrame, partitions: int, finish, schema: str, dtype=np.float64) -> list:
    """Collects ``finish(name, weight, array) -> row`` of the summed weights and arrays of every name.

    ``parts`` has rows of :func:`named_rows`. A sum is finished in the task that has added it up, so the
    driver sees the rows of ``schema`` and none of the arrays.
    """
    fan = max(1, int(partitions**0.5))

    def total(pdf: pd.DataFrame) -> tuple[str, float, np.ndarray]:
        out = None
        for d in pdf["data"]:
            x = np.frombuffer(d, dtype=dtype)
            out = x.copy() if out is None else np.add(out, x, out=out)
        return pdf["name"].iloc[0], float(pdf["weight"].sum()), out

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        name, weight, array = total(pdf)
        return pd.DataFrame({"name": [name], "weight": [weight], "data": [array.tobytes()]})

    columns = [part.split()[0] for part in schema.split(", ")]

    def end(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([finish(*total(pdf))], columns=columns)

    if fan > 2:
        keyed = parts.withColumn("fan", F.pmod(F.xxhash64("name", "weight", "data"), F.lit(fan)))
        parts = keyed.groupBy("name", "fan").applyInPandas(add, NAMED_SCHEMA)
    return parts.groupBy("name").applyInPandas(end, schema).collect()


def named_sums(df: DataFrame, columns: list[str], fn, finish, schema: str, partitions: int) -> list:
    """:func:`sums_by_name` of ``fn(batch) -> {name: (weight, array)}`` over all Arrow batches of ``df``."""
    ship(df.sparkSession)

    def run(batches):
        held: dict[str, list] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for name, (weight, array) in fn(batch).items():
                if name in held:
                    held[name][0] += weight
                    held[name][1] += array
                else:
                    held[name] = [weight, np.array(array, dtype=np.float64)]
        if held:
            yield named_rows(held)

    return sums_by_name(df.select(*columns).mapInArrow(run, NAMED_SCHEMA), partitions, finish, schema)
