"""Two-head network over sparse rows: width -> 128 -> 32 -> {branches, schools}.

Every partition starts from the shared weights, runs mini-batch AdamW on its own rows, and the
weights are averaged by row count after every epoch (Zinkevich et al., 2010). Where all partitions
run at the same time, a fit is one job: a barrier stage whose tasks keep weights and moments and
exchange them among themselves (``exchange.py``); the driver sees the losses and the final weights.
Elsewhere there is one job per epoch: the task that averages an array puts it into the shared folder, where
the next epoch reads it. Both give the same weights but for rounding.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.models.exchange import Exchange, Held, Shelf, drop_folder, new_folder, room_for
from windrow.models.numeric import NAMED_SCHEMA, PART_SCHEMA, Rows, named_rows, part_rows, reduce_parts, sums_by_name
from windrow.scale import share, ship

# Layer sizes, dropout, optimiser settings, batch size, stop rule.
HIDDEN = (128, 32)
DROPOUT = 0.6
LEARNING_RATE = 5e-4
WEIGHT_DECAY = 0.02
BATCH = 64
EPOCHS = 50
STOP_LOSS = 0.05
# Rows that are shuffled together; rows come in hash order, so any window is a fair mix.
MIX_ROWS = 8192


def erf(x: np.ndarray) -> np.ndarray:
    """Published polynomial (Abramowitz and Stegun 7.1.26), error below 2e-7."""
    a = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    t = 1.0 / (1.0 + 0.3275911 * np.abs(x))
    poly = t * (a[0] + t * (a[1] + t * (a[2] + t * (a[3] + t * a[4]))))
    return np.sign(x) * (1.0 - poly * np.exp(-x * x))


def gelu(x):
    return 0.5 * x * (1.0 + erf(x / np.sqrt(2.0)))


def gelu_slope(x):
    return 0.5 * (1.0 + erf(x / np.sqrt(2.0))) + x * np.exp(-0.5 * x * x) / np.sqrt(2 * np.pi)


def shapes(width: int, n1: int, n2: int) -> dict[str, tuple]:
    h1, h2 = HIDDEN
    return {"w1": (width, h1), "b1": (h1,), "w2": (h1, h2), "b2": (h2,),
            "wa": (h2, n1), "ba": (n1,), "wb": (h2, n2), "bb": (n2,)}


def start_weights(width: int, n1: int, n2: int, seed: int) -> dict[str, np.ndarray]:
    """Uniform within 1/sqrt(inputs) of each layer."""
    rng = np.random.RandomState(seed)
    fan = {"1": width, "2": HIDDEN[0], "a": HIDDEN[1], "b": HIDDEN[1]}
    return {k: rng.uniform(-1, 1, s).astype(np.float32) / np.float32(np.sqrt(fan[k[1]]))
            for k, s in shapes(width, n1, n2).items()}


def forward(w: dict, first: np.ndarray, masks=None):
    """Both heads' logits from ``first`` = rows times the first layer's weights."""
    a1 = first + w["b1"]
    h1 = gelu(a1)
    if masks:
        h1 = h1 * masks[0]
    a2 = h1 @ w["w2"] + w["b2"]
    h2 = gelu(a2)
    if masks:
        h2 = h2 * masks[1]
    return (a1, h1, a2, h2), h2 @ w["wa"] + w["ba"], h2 @ w["wb"] + w["bb"]


def softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def loss_and_slopes(w, rows: Rows, y1, y2, class_w, masks=None):
    """Cross-entropy of both heads (the second class-weighted) and its gradient.

    The first layer's gradient is nonzero only for columns that occur in the batch and is
    returned as the pair (columns, their gradient rows).
    """
    cols, x = rows.compact(w["w1"].dtype)
    (a1, h1, a2, h2), z1, z2 = forward(w, x @ w["w1"][cols], masks)
    p1, p2, at = softmax(z1), softmax(z2), np.arange(len(y1))
    cw = class_w[y2]
    loss = -np.log(p1[at, y1] + 1e-12).mean() - (cw * np.log(p2[at, y2] + 1e-12)).sum() / cw.sum()
    d1, d2 = p1, p2
    d1[at, y1] -= 1.0
    d1 /= len(y1)
    d2[at, y2] -= 1.0
    d2 *= (cw / cw.sum())[:, None]
    g = {"wa": h2.T @ d1, "ba": d1.sum(0), "wb": h2.T @ d2, "bb": d2.sum(0)}
    dh2 = d1 @ w["wa"].T + d2 @ w["wb"].T
    if masks:
        dh2 = dh2 * masks[1]
    da2 = dh2 * gelu_slope(a2)
    g["w2"], g["b2"] = h1.T @ da2, da2.sum(0)
    dh1 = da2 @ w["w2"].T
    if masks:
        dh1 = dh1 * masks[0]
    da1 = dh1 * gelu_slope(a1)
    g["w1"], g["b1"] = (cols, x.T @ da1), da1.sum(0)
    return loss, g


class AdamW:
    """Adam with decoupled weight decay; the moments travel with the weights."""

    def __init__(self, m: dict, v: dict, steps: int, lr=LEARNING_RATE, decay=WEIGHT_DECAY):
        self.m, self.v, self.t, self.lr, self.decay = m, v, steps, lr, decay

    def step(self, w: dict, g: dict) -> None:
        self.t += 1
        c1, c2 = 1 - 0.9**self.t, 1 - 0.999**self.t
        rate, eps, shrink = self.lr * np.sqrt(c2) / c1, 1e-8 * np.sqrt(c2), 1 - self.lr * self.decay
        for k, grad in g.items():
            at, grad = grad if isinstance(grad, tuple) else (slice(None), grad)
            m, v = self.m[k], self.v[k]
            # A moment shrinks before the gradient is added; columns that are absent only shrink.
            m[at] += grad * (0.1 / 0.9)
            v[at] += grad * grad * (0.001 / 0.999)
            # In blocks that stay in the processor's cache, with one scratch block.
            rows, scratch = 256, np.empty_like(w[k][:256])
            for a in range(0, len(m), rows):
                mp, vp, wp = m[a : a + rows], v[a : a + rows], w[k][a : a + rows]
                tmp = scratch[: len(mp)]
                mp *= 0.9
                vp *= 0.999
                np.sqrt(vp, out=tmp)
                tmp += eps
                np.divide(mp, tmp, out=tmp)
                tmp *= rate
                wp *= shrink
                wp -= tmp


@dataclass
class MlpModel:
    width: int
    n1: int
    n2: int
    weights: dict[str, np.ndarray]
    losses: list[float] = field(default_factory=list)

    def logits(self, rows: Rows):
        _, z1, z2 = forward(self.weights, rows.dot(self.weights["w1"]))
        return z1.astype(np.float64), z2.astype(np.float64)


def mixed_windows(batches, size: int = MIX_ROWS):
    """Arrow batches of whatever size as tables of ``size`` rows (the last one shorter)."""
    held, rows = [], 0
    for b in batches:
        while b.num_rows:
            take = min(size - rows, b.num_rows)
            held.append(b.slice(0, take))
            rows += take
            b = b.slice(take)
            if rows == size:
                yield pa.concat_batches(held)
                held, rows = [], 0
    if held:
        yield pa.concat_batches(held)


def train_batch(w: dict, opt: AdamW, rows: Rows, y1, y2, class_w, batch: int, rng) -> float:
    """Mini-batch steps over the shuffled rows of one window; returns the summed loss."""
    order, total, keep = rng.permutation(len(rows)), 0.0, 1.0 - DROPOUT
    for a in range(0, len(order), batch):
        pick = order[a : a + batch]
        masks = [(rng.random_sample((len(pick), h)) < keep).astype(np.float32) / np.float32(keep) for h in HIDDEN]
        loss, g = loss_and_slopes(w, rows.take(pick), y1[pick], y2[pick], class_w, masks)
        opt.step(w, g)
        total += loss * len(pick)
    return total


@dataclass
class Epochs:
    """What a task needs to know of a fit."""

    start: dict[str, np.ndarray]
    class_w: np.ndarray
    epochs: int
    batch: int
    rate: float
    stop_loss: float
    seed: int

    def run(self, w: dict, opt: AdamW, batches, epoch: int, part: int) -> tuple[int, float]:
        """One epoch over a partition's windows of rows; returns its rows and summed loss."""
        rng = np.random.RandomState((self.seed * 100003 + epoch * 1009 + part) % (1 << 32))
        n, total = 0, 0.0
        for b in batches:
            data = Rows.from_arrow(b)
            data.val = data.val.astype(np.float32)
            total += train_batch(w, opt, data, b.column(0).to_numpy(), b.column(1).to_numpy(), self.class_w, self.batch, rng)
            n += len(data)
        return n, total


def fit_mlp(
    df: DataFrame, width: int, n1: int, n2: int, id_col: str, t1="t1_idx", t2="t2_idx",
    epochs: int = EPOCHS, batch: int = BATCH, class_weights: dict[int, float] | None = None,
    stop_loss: float = STOP_LOSS, partitions: int = 4, seed: int = 42,
    rate: float | None = None, barrier: bool | None = None,
) -> MlpModel:
    """Train on rows with ``idx``, ``val`` and both label codes.

    ``partitions`` is a parameter of the model, like the batch size: neither cores, rows nor the
    size of Arrow batches change the result. Rows are placed and ordered by a seeded hash of
    their id. Moments travel with the weights. Without a ``rate`` the step grows with the number of
    partitions, because averaging makes each partition's steps count by its share. ``barrier`` asks
    for one job with a barrier stage, or for one job per epoch; by default the cores decide.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(id_col), F.col(t1).cast("int").alias("y1"), F.col(t2).cast("int").alias("y2"), "idx", "val")
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), id_col))
    placed = rows.repartition(partitions, "_h").sortWithinPartitions("_h", id_col).drop("_h", id_col)
    cw = np.ones(n2, dtype=np.float32)
    for k, v in (class_weights or {}).items():
        if k < n2:
            cw[k] = v
    plan = Epochs(start_weights(width, n1, n2, seed), cw, epochs, batch, LEARNING_RATE * partitions if rate is None else rate, stop_loss, seed)
    folder = new_folder(spark, "network") if (room_for(spark, partitions) if barrier is None else barrier) else None
    if folder is None:
        weights, losses = _by_jobs(placed, plan, partitions)
    else:
        try:
            weights, losses = _in_one_stage(placed, plan, folder)
        finally:
            drop_folder(folder)
    return MlpModel(width, n1, n2, weights, losses)


def _in_one_stage(placed: DataFrame, plan: Epochs, folder: str) -> tuple[dict[str, np.ndarray], list[float]]:
    """All epochs in the tasks of one barrier stage. The first task hands the final weights out."""
    shared = placed.sparkSession.sparkContext.broadcast(plan)

    def run(batches):
        from pyspark import BarrierTaskContext

        fit, exchange = shared.value, Exchange(folder, BarrierTaskContext.get())
        keys, held = list(fit.start), Held(exchange, mixed_windows(batches))
        sizes = [fit.start[k].size for k in keys] * 3

        def split(flat):
            parts = np.split(flat, np.cumsum(sizes)[:-1])
            named = [{k: x.reshape(fit.start[k].shape) for k, x in zip(keys, parts[a : a + len(keys)])} for a in range(0, len(parts), len(keys))]
            return named[0], named[1], named[2]

        epoch, facts, flat = exchange.resume()
        losses, steps = facts.get("losses", []), facts.get("steps", 0)
        if flat is None:
            first = np.concatenate([fit.start[k].ravel() for k in keys])
            flat = np.concatenate([first, np.zeros(2 * len(first), np.float32)])
        while epoch < fit.epochs and not (losses and losses[-1] < fit.stop_loss):
            epoch += 1
            flat = flat.copy()
            w, m, v = split(flat)
            opt = AdamW(m, v, steps, fit.rate)
            n, total = fit.run(w, opt, held, epoch, exchange.part)
            flat, told = exchange.mean(epoch, flat, n, [total, opt.t])
            seen = sum(t[0] for t in told) or 1
            steps = int(round(sum(t[0] * t[2] for t in told) / seen))
            losses.append(sum(t[1] for t in told) / seen)
            exchange.finish(epoch, {"losses": losses, "steps": steps})
        if exchange.part == 0:
            told = np.full(fit.epochs, np.nan, np.float32)
            told[: len(losses)] = losses
            yield part_rows({**split(flat)[0], "losses": told}, 1.0, np.float32)

    shape = {k: v.shape for k, v in plan.start.items()} | {"losses": (plan.epochs,)}
    # Spark runs a failed barrier stage again only if a shuffle follows it; here it carries one model.
    trained = placed.mapInArrow(run, PART_SCHEMA, barrier=True).repartition(1)
    got = reduce_parts(trained, shape, 1, dtype=np.float32)
    shared.unpersist()
    return {k: got[k].astype(np.float32) for k in plan.start}, [float(x) for x in got["losses"] if not np.isnan(x)]


def _by_jobs(placed: DataFrame, plan: Epochs, partitions: int) -> tuple[dict[str, np.ndarray], list[float]]:
    """One job per epoch; the averaged weights and moments go through the shared folder if there is one."""
    spark, placed = placed.sparkSession, share(placed)
    shelf = Shelf.new(spark, "network", np.float32)
    places: dict[str, bytes] = {}
    losses: list[float] = []
    steps, shape = 0, {k: v.shape for k, v in plan.start.items()}
    try:
        for epoch in range(1, plan.epochs + 1):
            shared = spark.sparkContext.broadcast((plan, places, steps))

            def run(batches, shared=shared, epoch=epoch):
                from pyspark import TaskContext

                fit, at, seen = shared.value
                held = {n: x.reshape(shape[n[2:]]).copy() for n, x in zip(at, shelf.take(list(at.values())))}
                w = {k: held.get(f"w.{k}", v).copy() for k, v in fit.start.items()}
                m, v = ({k: held.get(f"{p}.{k}", np.zeros_like(x)) for k, x in w.items()} for p in "mv")
                opt = AdamW(m, v, seen, fit.rate)
                n, total = fit.run(w, opt, mixed_windows(batches), epoch, TaskContext.get().partitionId())
                if n:
                    out = {f"{p}.{k}": (n, x * n) for p, d in (("w", w), ("m", opt.m), ("v", opt.v)) for k, x in d.items()}
                    yield named_rows(out | {"facts": (n, np.array([total, opt.t * n]))}, np.float32)

            def mean(name, n, total):
                total = total / np.float32(n)
                return (name, total.tobytes()) if name == "facts" else (name, shelf.put(total))

            got = {r["name"]: bytes(r["place"]) for r in sums_by_name(placed.mapInArrow(run, NAMED_SCHEMA), partitions, mean, "name string, place binary", np.float32)}
            loss, done = np.frombuffer(got.pop("facts"), np.float32) if got else (0.0, 0.0)  # without rows nothing is trained
            shelf.drop(list(places.values()))
            places, steps = got, int(round(float(done)))
            losses.append(float(loss))
            shared.unpersist()
            if losses[-1] < plan.stop_loss:
                break
        found = dict(zip(places, shelf.take(list(places.values()))))
        weights = {k: found[f"w.{k}"].reshape(shape[k]).copy() if f"w.{k}" in found else v for k, v in plan.start.items()}
    finally:
        shelf.close()
    placed.unpersist()
    return weights, losses
