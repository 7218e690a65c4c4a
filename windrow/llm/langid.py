"""Language identification by a byte convolutional network, trained and applied in numpy.

The network reads fixed-length windows of UTF-8 bytes: filters of several widths over one-hot
bytes, a rectifier, max pooling over the window, and a softmax over the learned languages. A
filter over one-hot bytes is a sum of table rows, one table per offset; for prediction, tables of
neighbouring offsets are merged into byte-pair tables. A text's windows cover it whole, and the
mean of their probabilities, weighted by letters, decides.

Fitting reads a bounded, hash-chosen sample: at most ``Settings.sample_rows`` labelled rows and
``Settings.windows`` windows of each. Counting the labels covers all rows.

Text that is null or has no letter: ``und``, score 0. No labelled row at all: every prediction
is ``und``. Null or repeated ``doc_id``: rows stay; a null id is never learned from and counts
as held out. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.shared import column, per_batch, small, text_bytes

UNKNOWN = "und"


@dataclass
class Settings:
    window: int = 192
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    sample_rows: int = 4_000
    windows: int = 3
    epochs: int = 6
    batch: int = 128
    rate: float = 0.01
    seed: int = 7


def prepared(text: bytes) -> bytes:
    return text.lower()


def windows_of(text: bytes, size: int) -> np.ndarray:
    """The whole text as rows of ``size`` bytes; the last row is filled up with spaces."""
    rows = max(1, -(-len(text) // size))
    return np.frombuffer(text.ljust(rows * size), np.uint8).reshape(rows, size)


class Network:
    """Tables[w][j] is 256 x filters: what byte b adds at offset j of a filter of width w."""

    def __init__(self, tables: list[np.ndarray], bias: np.ndarray, dense: np.ndarray, last: np.ndarray, labels: list[str]):
        self.tables, self.bias, self.dense, self.last, self.labels = tables, bias, dense, last, labels

    @classmethod
    def drawn(cls, labels: list[str], s: Settings) -> Network:
        rng = np.random.default_rng(s.seed)
        tables = [rng.normal(0, 0.3 / np.sqrt(w), (w, 256, s.filters)).astype(np.float32) for w in s.widths]
        units = s.filters * len(s.widths)
        return cls(tables, np.zeros(units, np.float32), rng.normal(0, 0.1, (units, len(labels))).astype(np.float32),
                   np.zeros(len(labels), np.float32), labels)

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of every filter in every window, and where it is."""
        best, where = [], []
        for table in self.tables:
            width, span = len(table), rows.shape[1] - len(table) + 1
            total = table[0][rows[:, :span]]
            for j in range(1, width):
                total += table[j][rows[:, j : j + span]]
            at = total.argmax(1)
            best.append(np.take_along_axis(total, at[:, None, :], 1)[:, 0])
            where.append(at)
        return np.concatenate(best, 1) + self.bias, np.concatenate(where, 1)

    def merged(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width: (offset, table) parts, byte-pair tables first, one byte table if odd."""
        parts = []
        for table in self.tables:
            width = len(table)
            own = [(j, (table[j][:, None] + table[j + 1][None]).reshape(65536, -1)) for j in range(0, width - 1, 2)]
            parts.append(own + ([(width - 1, table[width - 1])] if width % 2 else []))
        return parts

    def probabilities(self, hidden: np.ndarray) -> np.ndarray:
        z = np.maximum(hidden, 0) @ self.dense + self.last
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train(rows: np.ndarray, truth: np.ndarray, labels: list[str], s: Settings) -> Network:
    """Adam on mini-batches; only the pooled positions of a filter receive its gradient."""
    net, rng = Network.drawn(labels, s), np.random.default_rng(s.seed + 1)
    values = [*net.tables, net.bias, net.dense, net.last]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    weight = len(truth) / (len(labels) * np.maximum(1, np.bincount(truth, minlength=len(labels))))
    for _ in range(s.epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), s.batch):
            pick = order[k : k + s.batch]
            x, y = rows[pick], truth[pick]
            hidden, where = net.pooled(x)
            d = net.probabilities(hidden)
            d[np.arange(len(y)), y] -= 1
            d *= (weight[y] / len(y))[:, None].astype(np.float32)
            back = (d @ net.dense.T) * (hidden > 0)
            slopes = []
            for i, table in enumerate(net.tables):
                slope, own = np.zeros_like(table), slice(i * s.filters, (i + 1) * s.filters)
                for j in range(len(table)):
                    seen = np.take_along_axis(x, where[:, own] + j, 1)
                    np.add.at(slope[j], (seen, np.arange(s.filters)[None]), back[:, own])
                slopes.append(slope)
            slopes += [back.sum(0), np.maximum(hidden, 0).T @ d, d.sum(0)]
            step += 1
            for v, g, a, b in zip(values, slopes, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= s.rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def learnable() -> F.Column:
    """Rows the network may learn from, by the id's checksum."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2, F.lit(False))


def fit(docs: DataFrame, s: Settings | None = None) -> Network | None:
    """A network from the learnable labelled rows of ``docs``; None if there are none."""
    s = s or Settings()
    rows = docs.select("doc_id", "text", "lang").filter(learnable() & F.col("lang").isNotNull() & F.col("text").rlike("[a-zA-Z\\u0080-\\uffff]"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    labels = sorted(r["lang"] for r in counts.collect())
    if not labels:
        return None
    each = max(1, s.sample_rows // len(labels))
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = rows.join(small(counts, len(labels)), "lang").withColumn("h", chance).filter(F.col("h") * F.col("n") < F.lit(1.1 * each))
    size, length = F.lit(s.window), F.length("text")
    cuts = [F.substring("text", (F.greatest(length - size, F.lit(0)) * k / max(1, s.windows - 1)).cast("int") + 1, size) for k in range(s.windows)]
    sample = picked.select("lang", "h", F.array_distinct(F.array(*cuts)).alias("cuts")).orderBy("h", "lang", "cuts").limit(2 * s.sample_rows).collect()
    code = {name: i for i, name in enumerate(labels)}
    pairs = [(windows_of(prepared(cut.encode())[: s.window], s.window)[0], code[r["lang"]]) for r in sample for cut in r["cuts"]]
    return train(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), labels, s)


_LETTERS = np.zeros(256, np.float32)
_LETTERS[[*range(65, 91), *range(97, 123), *range(0xC3, 0x100)]] = 1


def has_letter(text: bytes) -> bool:
    if any(65 <= b <= 90 or 97 <= b <= 122 for b in text[:64]):
        return True
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


class Reader:
    """Applies a network to many texts, some windows at a time."""

    def __init__(self, net: Network, window: int, chunk: int = 256):
        self.net, self.window, self.chunk, self.parts = net, window, chunk, net.merged()

    def hidden(self, rows: np.ndarray) -> np.ndarray:
        pairs = (rows[:, :-1].astype(np.uint16) << 8) | rows[:, 1:]
        best = []
        for table, parts in zip(self.net.tables, self.parts):
            span = self.window - len(table) + 1
            total = None
            for offset, part in parts:
                codes = pairs if len(part) > 256 else rows
                got = part.take(codes[:, offset : offset + span], axis=0)
                total = got if total is None else np.add(total, got, out=total)
            best.append(total.max(1))
        return np.concatenate(best, 1) + self.net.bias

    def predict(self, data: list[bytes]) -> list[tuple[str, float]]:
        known = [i for i, t in enumerate(data) if t and has_letter(t)]
        sums = np.zeros((len(data), len(self.net.labels)))
        weights = np.zeros(len(data))
        held: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        size = 0

        def flush():
            rows, who = np.concatenate(held), np.concatenate(owner)
            for k in range(0, len(rows), self.chunk):
                part = rows[k : k + self.chunk]
                weight = _LETTERS[part].sum(1) + 0.001
                p = self.net.probabilities(self.hidden(part)) * weight[:, None]
                np.add.at(sums, who[k : k + self.chunk], p)
                np.add.at(weights, who[k : k + self.chunk], weight)
            held.clear()
            owner.clear()

        for i in known:
            rows = windows_of(prepared(data[i]), self.window)
            held.append(rows)
            owner.append(np.full(len(rows), i))
            size += len(rows)
            if size >= 16 * self.chunk:
                flush()
                size = 0
        if held:
            flush()
        out = [(UNKNOWN, 0.0)] * len(data)
        for i in known:
            best = int(sums[i].argmax())
            out[i] = self.net.labels[best], float(min(1.0, sums[i, best] / weights[i]))
        return out


def identify(docs: DataFrame, net: Network | None, s: Settings | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; only the text enters the prediction."""
    s = s or Settings()
    docs = docs.select("doc_id", "text", (~learnable()).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        reader = Reader(shared.value, s.window) if shared.value else None

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data = text_bytes(batch)
            found = reader.predict(data) if reader else [(UNKNOWN, 0.0)] * len(data)
            made = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "held_out"), *made],
                                              names=["doc_id", "held_out", "lang_pred", "score"])

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs, make, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """Fit on the learnable rows of ``docs`` and predict for all of its rows."""
    return identify(docs, fit(docs, s), s)


def accepted(docs: DataFrame, least: float = 0.5, s: Settings | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a score of ``least`` or more."""
    s = s or Settings()
    net = fit(docs, s)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        reader = Reader(shared.value, s.window) if shared.value else None

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            data = text_bytes(batch)
            found = reader.predict(data) if reader else [(UNKNOWN, 0.0)] * len(data)
            return batch.filter(pa.array([name != UNKNOWN and score >= least for name, score in found], pa.bool_()))

        return step

    return per_batch(docs, make, docs.schema)
