"""Kernel SVM for the branch label: random Fourier features and one linear SVM per class pair.

The kernel exp(-gamma |x-y|^2) is approximated by ``features`` random cosines (Rahimi and
Recht, 2007), so training is linear in rows. Classes are balanced by row weights; prediction
is a one-vs-one vote, the lowest code winning ties.

All pairs are fitted together by Newton steps on the squared hinge: in one pass a task adds up, for
every pair, the loss, the gradient and the Hessian of the rows inside the margin; the task that has added
up a pair's sums solves its system, and the driver sees the next weights. The same sums give the dual value of the margin violations, so the
gap between primal and dual says how far each pair is from its optimum.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.models.numeric import Rows, named_sums, packed
from windrow.operators.metrics import class_weights
from windrow.scale import ship

# Fixed value: penalty of a margin violation.
PENALTY = 1.0
FEATURES = 512
# Rows that a task of a pass should at least hold; every row costs features x features per pair.
PASS_ROWS = 1024


@lru_cache(maxsize=4)
def fourier_basis(width: int, features: int, gamma: float, seed: int):
    """Frequencies and phases; drawn again from the seed on every worker, never shipped."""
    rng = np.random.RandomState(seed)
    w = rng.standard_normal((width, features)).astype(np.float32) * np.float32(np.sqrt(2 * gamma))
    return w, rng.uniform(0, 2 * np.pi, features).astype(np.float32)


def fourier_map(rows: Rows, width: int, features: int, gamma: float, seed: int) -> np.ndarray:
    w, phase = fourier_basis(width, features, gamma, seed)
    return np.sqrt(2.0 / features) * np.cos(rows.dot(w) + phase)


@dataclass
class SvmModel:
    width: int
    features: int
    gamma: float
    seed: int
    classes: list[int]
    pairs: list[tuple[int, int]]
    coef: np.ndarray
    intercept: np.ndarray
    # Relative distance from the optimum of every pair, the limit it was fitted to, and passes over the rows.
    gaps: list[float] = field(default_factory=list)
    tol: float = 0.0
    passes: int = 0

    @property
    def converged(self) -> bool:
        return all(g <= self.tol for g in self.gaps)

    def margins(self, rows: Rows) -> np.ndarray:
        """One column per class pair; positive speaks for the pair's first class."""
        z = fourier_map(rows, self.width, self.features, self.gamma, self.seed)
        return z @ self.coef.T + self.intercept

    def vote(self, margins: np.ndarray) -> np.ndarray:
        position = {c: i for i, c in enumerate(self.classes)}
        votes = np.zeros((len(margins), len(self.classes)), dtype=np.int32)
        for k, (a, b) in enumerate(self.pairs):
            first = margins[:, k] > 0
            votes[:, position[a]] += first
            votes[:, position[b]] += ~first
        return np.array(self.classes, dtype=np.int32)[votes.argmax(axis=1)]


def scale_gamma(df: DataFrame, width: int) -> float:
    """1 / (width * variance of all matrix entries), zeros included."""
    one = F.aggregate("val", F.lit(0.0), lambda a, w: a + w)
    two = F.aggregate("val", F.lit(0.0), lambda a, w: a + w * w)
    r = df.agg(F.sum(one).alias("s1"), F.sum(two).alias("s2"), F.count(F.lit(1)).alias("n")).first()
    cells = float(r["n"]) * width
    variance = r["s2"] / cells - (r["s1"] / cells) ** 2
    return 1.0 / (width * variance) if variance > 0 else 1.0


def fit_svm(
    df: DataFrame, label: str, width: int, features: int = FEATURES, seed: int = 42,
    penalty: float = PENALTY, max_iter: int = 100, tol: float = 1e-6,
) -> SvmModel:
    """Fit on rows with ``idx``, ``val`` and a label code, until every pair's gap is at most ``tol``.

    Minimises |w|^2 / 2 + penalty * sum(weight * max(0, 1 - margin)^2), the intercept being the
    weight of a constant feature. A step that does not lower a pair's value is halved.
    """
    ship(df.sparkSession)
    gamma = scale_gamma(df, width)
    weights = {r[label]: (r["n"], r["weight"]) for r in class_weights(df, label).collect()}
    classes = sorted(weights)
    pairs = list(combinations(classes, 2))
    data, parts = packed(df.select(F.col(label).cast("int").alias("y"), "idx", "val"), ["y", "idx", "val"], sum(n for n, _ in weights.values()), PASS_ROWS)
    size, lower = features + 1, np.tril_indices(features + 1)

    def steps(at: np.ndarray, open_: list[int]) -> dict[int, tuple[float, float, np.ndarray]]:
        """Primal and dual value of the open pairs at their weights ``at``, and where Newton's step leads."""
        shared = data.sparkSession.sparkContext.broadcast(at)

        def add(batch):
            w, y = shared.value, batch.column(batch.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
            got = np.zeros((len(open_), 2 + 2 * size + len(lower[0])))
            for first, part in Rows.from_arrow(batch).parts(2048):
                z = fourier_map(part, width, features, gamma, seed).astype(np.float64)
                z = np.concatenate([z, np.ones((len(z), 1))], 1)
                own = y[first : first + len(z)]
                for i, k in enumerate(open_):
                    p, q = pairs[k]
                    side = np.where(own == p, 1.0, np.where(own == q, -1.0, 0.0))
                    miss = np.where(side != 0, 1 - side * (z @ w[i]), 0.0)
                    inside = np.flatnonzero(miss > 0)
                    x, s, m = z[inside], side[inside], miss[inside]
                    c = np.where(s > 0, weights[p][1], weights[q][1])
                    got[i, 0] += c @ (m * m)
                    got[i, 1] += c @ m
                    got[i, 2 : 2 + size] += x.T @ (c * s)
                    got[i, 2 + size : 2 + 2 * size] += x.T @ (c * s * m)
                    got[i, 2 + 2 * size :] += ((x * c[:, None]).T @ x)[lower]
            return {str(i): (0.0, got[i]) for i in range(len(open_))}

        def solve(name, _, got):
            w, c, (loss, miss), (pull, lean) = shared.value[int(name)], penalty, got[:2], got[2 : 2 + 2 * size].reshape(2, size)
            primal = w @ w / 2 + c * loss
            # The violations, times 2 c, are a feasible point of the dual.
            v = 2 * c * lean
            dual = 2 * c * miss - v @ v / 2 - c * loss
            hess = np.zeros((size, size))
            hess[lower] = 2 * c * got[2 + 2 * size :]
            hess += np.tril(hess, -1).T
            return name, float(primal), float(dual), np.linalg.solve(hess + np.eye(size), 2 * c * pull).tobytes()

        try:
            rows = named_sums(data, ["y", "idx", "val"], add, solve, "name string, primal double, dual double, data binary", parts)
        finally:
            shared.destroy()
        return {open_[int(r["name"])]: (r["primal"], r["dual"], np.frombuffer(r["data"])) for r in rows}

    best = np.zeros((len(pairs), size))
    value, gaps = np.full(len(pairs), np.inf), [np.inf] * len(pairs)
    trial, passes = best.copy(), 0
    while passes < max_iter and any(g > tol for g in gaps):
        open_ = [k for k in range(len(pairs)) if gaps[k] > tol]
        got = steps(trial[open_], open_)
        passes += 1
        for k, (primal, dual, ahead) in got.items():
            w = trial[k].copy()
            if primal > value[k] * (1 + 1e-12):
                trial[k] = (best[k] + w) / 2
                continue
            best[k], value[k] = w, primal
            gaps[k] = float((primal - dual) / max(primal, 1e-300))
            trial[k] = ahead
    data.unpersist()
    return SvmModel(width, features, gamma, seed, classes, pairs, best[:, :features].copy(), best[:, features].copy(), gaps, tol, passes)


def predict_svm(df: DataFrame, model: SvmModel, out: str = "y_pred") -> DataFrame:
    """Append the voted class and ``margin_row``: true when a training pair's margin is at most 1.

    ``margin_row`` needs a ``y_true`` column; without it the column is null.
    """
    ship(df.sparkSession)
    schema = df.schema
    has_truth = "y_true" in df.columns

    def run(batches):
        for b in batches:
            m = model.margins(Rows.from_arrow(b))
            label = model.vote(m)
            support = pa.nulls(len(m), pa.bool_())
            if has_truth:
                y = b.column(b.schema.get_field_index("y_true")).to_numpy(zero_copy_only=False)
                near = np.zeros(len(m), dtype=bool)
                for k, (p, q) in enumerate(model.pairs):
                    side = np.where(y == p, 1.0, np.where(y == q, -1.0, np.nan))
                    near |= side * m[:, k] <= 1
                support = pa.array(near)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(label, pa.int32()), support], names=[*b.schema.names, out, "margin_row"])

    from pyspark.sql.types import BooleanType, IntegerType, StructType
    target = StructType([*schema.fields]).add(out, IntegerType()).add("margin_row", BooleanType())
    return df.mapInArrow(run, target)
