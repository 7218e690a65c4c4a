"""K-Means: all seeded restarts run together, the one with the smallest cost is kept.

Every pass over the sparse rows serves all restarts: their centres are one matrix, a task adds up
one partial per centre, and a restart that has settled takes no part in further passes. A centre moves in the
task that adds up its partials and is put into the shared folder, where the next pass reads it: the driver
sees how far it moved. Centres
start from a few rounds of distance-weighted draws (k-means||, Bahmani and others, 2012) that are
narrowed to k on the driver. A draw needs one pass: a row's key is log(u) / distance with u from a
hash of row, seed and round, and the largest keys win, so partitions do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windrow.models.exchange import Shelf
from windrow.models.numeric import Rows, named_sums, packed, sum_over_rows
from windrow.scale import ship

# Clusters, restarts, first seed.
CLUSTERS = 7
RESTARTS = 10
SEED = 42
# Rounds of draws before the centres are narrowed, and rows drawn in each, as a multiple of k.
ROUNDS, DRAWS = 2, 2
# Rows that a task of a pass should at least hold; every row meets the centres of all restarts.
PASS_ROWS = 1024


@dataclass
class KMeansFit:
    centers: np.ndarray
    cost: float
    costs: list[float]
    converged: bool = True
    passes: int = 0

    def distances(self, rows: Rows) -> np.ndarray:
        """Squared distance of every sparse row to every centre."""
        return distances(rows, self.centers)


def distances(rows: Rows, centers: np.ndarray) -> np.ndarray:
    d = rows.squared_norms()[:, None] - 2.0 * rows.dot(np.ascontiguousarray(centers.T)) + (centers**2).sum(1)
    return np.maximum(d, 0.0)


def fit_kmeans(
    df: DataFrame, width: int, k: int = CLUSTERS, restarts: int = RESTARTS, seed: int = SEED,
    max_iter: int = 300, tol: float = 1e-4,
) -> KMeansFit:
    """Fit on rows with ``idx`` and ``val``; a restart has settled once no centre moves by more than ``tol``."""
    ship(df.sparkSession)
    rows = df.select("idx", "val", F.xxhash64("idx", "val").alias("h"))
    data, parts = packed(rows, ["idx", "val", "h"], df.count(), PASS_ROWS)
    centers = np.stack(seeds(data, parts, width, k, restarts, seed))
    shelf = Shelf.new(df.sparkSession, "centres")
    try:
        places = {(r, c): shelf.put(centers[r, c]) for r in range(restarts) for c in range(k)}
        active, passes = list(range(restarts)), 0
        while active and passes < max_iter:
            steps = _step(data, parts, {at: places[at] for at in places if at[0] in active}, width, k, shelf)
            passes += 1
            far = dict.fromkeys(active, 0.0)
            for (r, c), (place, moved) in steps.items():
                shelf.drop([places[r, c]])
                places[r, c], far[r] = place, max(far[r], moved)
            active = [r for r in active if far[r] > tol * tol]
        centers = np.stack(shelf.take([places[at] for at in sorted(places)])).reshape(restarts, k, width)
    finally:
        shelf.close()
    costs = _pass(data, parts, centers, width, "cost").tolist()
    data.unpersist()
    best = min(range(restarts), key=lambda r: (costs[r], r))
    return KMeansFit(centers[best], costs[best], costs, not active, passes)


def _step(data: DataFrame, parts: int, places: dict[tuple[int, int], bytes], width: int, k: int, shelf: Shelf) -> dict[tuple[int, int], tuple[bytes, float]]:
    """One Lloyd step of the restarts in ``places``: the new place of every centre with rows, and how far it moved, squared.

    A centre without rows stays where it is and is not in the result.
    """
    runs = sorted({r for r, _ in places})
    shared = data.sparkSession.sparkContext.broadcast(places)
    loaded: list[np.ndarray] = []

    def add(batch):
        if not loaded:  # once per task
            loaded.append(np.stack(shelf.take([shared.value[r, c] for r in runs for c in range(k)])))
        rows = Rows.from_arrow(batch)
        near, at = distances(rows, loaded[0]).reshape(len(rows), len(runs), k).argmin(2), rows.row_ids()
        out = {}
        for i, r in enumerate(runs):
            counts = np.bincount(near[:, i], minlength=k)
            sums = np.bincount(near[at, i] * width + rows.idx, rows.val, k * width).reshape(k, width)
            out |= {f"{r}-{c}": (counts[c], sums[c]) for c in range(k) if counts[c]}
        return out

    def move(name, n, total):
        before, after = shelf.take([shared.value[tuple(map(int, name.split("-")))]])[0], total / n
        return name, shelf.put(after), float(((after - before) ** 2).sum())

    try:
        got = named_sums(data, ["idx", "val"], add, move, "name string, place binary, moved double", parts)
    finally:
        shared.destroy()
    return {tuple(map(int, g["name"].split("-"))): (bytes(g["place"]), g["moved"]) for g in got}


def _pass(data: DataFrame, parts: int, centers: np.ndarray, width: int, wanted: str) -> np.ndarray:
    """One pass for all ``centers`` (restart, centre, column): ``counts`` of every centre's rows, or the ``cost``
    of every restart."""
    runs, k, _ = centers.shape
    shared = data.sparkSession.sparkContext.broadcast(centers.reshape(runs * k, width))

    def add(batch):
        rows = Rows.from_arrow(batch)
        d = distances(rows, shared.value).reshape(len(rows), runs, k)
        near = d.argmin(2)
        if wanted == "cost":
            return {"cost": np.take_along_axis(d, near[:, :, None], 2)[:, :, 0].sum(0)}
        return {"counts": np.stack([np.bincount(near[:, r], minlength=k) for r in range(runs)])}

    try:
        return sum_over_rows(data, ["idx", "val"], add, {wanted: {"cost": (runs,), "counts": (runs, k)}[wanted]}, parts)[wanted]
    finally:
        shared.destroy()


def _uniform(h: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """Numbers in (0, 1) from row hashes, a seed and a round."""
    x = h.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53) + 2.0**-54


def _draw(data: DataFrame, found: list[np.ndarray], width: int, count: int, seed: int, turn: int) -> list[np.ndarray]:
    """``count`` rows per restart, drawn by squared distance from the rows found so far (evenly at first)."""
    sizes = [len(f) for f in found]
    ends = np.cumsum(sizes)
    shared = data.sparkSession.sparkContext.broadcast(np.concatenate(found))

    def best(batches):
        for batch in batches:
            rows = Rows.from_arrow(batch)
            h = batch.column(batch.schema.get_field_index("h")).to_numpy(zero_copy_only=False)
            d = distances(rows, shared.value) if len(shared.value) else None
            for r, end in enumerate(ends):
                own = d[:, end - sizes[r] : end].min(1) if d is not None else np.ones(len(rows))
                key = np.where(own > 1e-12, np.log(_uniform(h, seed + r, turn)) / np.maximum(own, 1e-12), -np.inf)
                top = np.argsort(-key, kind="stable")[:count]
                top = top[np.isfinite(key[top])]
                pick = batch.take(pa.array(top))
                yield pa.RecordBatch.from_arrays([pa.array([r] * len(top), pa.int32()), pa.array(key[top]), *(pick.column(pick.schema.get_field_index(c)) for c in ("h", "idx", "val"))],
                                                 names=["run", "key", "h", "idx", "val"])

    drawn = data.mapInArrow(best, "run int, key double, h bigint, idx array<int>, val array<double>")
    # Equal rows have equal keys: one of them is enough.
    order = Window.partitionBy("run").orderBy(F.desc("key"), "h")
    top = drawn.groupBy("run", "key", "h").agg(F.min(F.struct("idx", "val")).alias("row")).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= count)
    out: list[list[np.ndarray]] = [[] for _ in found]
    for r in sorted(top.select("run", "nth", "row.idx", "row.val").collect(), key=lambda r: (r["run"], r["nth"])):
        dense = np.zeros(width)
        dense[r["idx"]] = r["val"]
        out[r["run"]].append(dense)
    shared.destroy()
    return [np.array(o).reshape(len(o), width) for o in out]


def seeds(data: DataFrame, parts: int, width: int, k: int, restarts: int, seed: int) -> list[np.ndarray]:
    """First centres of every restart: rows drawn in rounds, weighted by the rows near them, narrowed to k."""
    found = [np.zeros((0, width)) for _ in range(restarts)]
    for turn in range(ROUNDS + 1):
        drawn = _draw(data, found, width, DRAWS * k if turn else 1, seed, turn)
        found = [np.concatenate([f, d]) for f, d in zip(found, drawn)]
    most = max(1, max(map(len, found)))
    # Shorter lists are filled up with their first row, which then is never nearest a second time.
    full = np.stack([np.concatenate([f, np.repeat(f[:1] if len(f) else np.zeros((1, width)), most - len(f), 0)]) for f in found])
    weights = _pass(data, parts, full, width, "counts")
    return [narrowed(full[r], weights[r], k, seed + r) for r in range(restarts)]


def narrowed(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted k-means++ and some Lloyd steps over the few drawn rows."""
    rng = np.random.RandomState(seed)
    pick = [min(int(np.searchsorted(np.cumsum(weights), rng.random_sample() * weights.sum(), "right")), len(points) - 1)]
    while len(pick) < k:
        far = np.min([((points - points[c]) ** 2).sum(1) for c in pick], 0)
        mass = np.cumsum(far * weights)
        pick.append(min(int(np.searchsorted(mass, rng.random_sample() * mass[-1], "right")), len(points) - 1) if mass[-1] > 0 else pick[0])
    centers = points[pick].copy()
    for _ in range(30):
        near = (((points**2).sum(1)[:, None] - 2 * points @ centers.T) + (centers**2).sum(1)).argmin(1)
        for c in range(k):
            own = near == c
            if weights[own].sum() > 0:
                centers[c] = np.average(points[own], 0, weights[own])
    return centers
