"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the weighted mean of the vectors of its character n-grams (with word borders) and of the
whole word, all hashed into one table; a passage is the mean of its words, and a linear softmax
over that mean tells clean from toxic. The first column of the table starts from the log odds of
each part (small ones cut to 0); then table and softmax are trained together. A misspelling that
was never seen shares most vectors with the word it hides. The softmax is linear in the mean: for
scoring, every word has one number (kept in a bounded worker cache) and a passage has their mean.

A text is scored in passages of ``Settings.passage`` words that cover it whole, neighbours
overlapping by half; the highest score counts, so a long text cannot hide a short insult.

Fitting reads a bounded, hash-chosen sample: at most ``Settings.sample_rows`` labelled rows, half
of each label if there are enough, of texts of at most ``Settings.sample_chars`` characters.

Null or empty text and text without a word: the score of the bias alone. No labelled row: every
score is 0. One label only: every score is that label's. Null ``doc_id``: never learned from,
held out. Repeated rows: scored each on its own. Labels that are repeated: the larger counts; null
labels count for nothing. Very long texts are scored whole. Ties at a border of the sample go by
``doc_id``; of a repeated id the smallest text is learned. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import collections
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.shared import column, mixed, per_batch, texts

_TERM = re.compile(r"\w+")


@dataclass
class Settings:
    buckets: int = 1 << 18
    dim: int = 4
    grams: tuple[int, ...] = (3, 4, 5)
    whole: float = 0.35
    passage: int = 200
    longest: int = 40
    sample_rows: int = 2_000
    sample_chars: int = 20_000
    prior: float = 0.5
    cut: float = 1.5
    gain: float = 40.0
    steps: int = 60
    batch: int = 128
    rate: float = 0.005
    floor: float = 1e-3
    cache_words: int = 400_000
    seed: int = 11


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def features(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words' parts, one word after the other (the whole word comes first),
    and where each word starts.

    Parts are the word itself and its n-grams over ``<word>``. Of a word longer than ``longest``
    both ends count, half of that length each.
    """
    cut = [w if len(w) <= s.longest else w[: s.longest // 2] + w[-s.longest // 2 :] for w in words]
    joined = "".join(f"<{w}>" for w in cut)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in cut), np.int64, len(cut))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(cut) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(cut)), lengths)
    scrambled = mixed(points + np.uint64(1))
    # Whole words: the sum of position-tagged letters.
    place = (np.arange(len(points)) - np.repeat(starts, lengths)).astype(np.uint64)
    whole = np.add.reduceat(mixed(scrambled ^ mixed(place)), starts) if len(cut) else np.empty(0, np.uint64)
    hashes, owners = [whole], [np.arange(len(cut))]
    for n in s.grams:
        count = len(points) - n + 1
        if count <= 0:
            continue
        total = np.full(count, n, np.uint64)
        for k in range(n):
            total = total * np.uint64(0x9E3779B97F4A7C15) + scrambled[k : k + count]
        same = owner[:count] == owner[n - 1 :]
        hashes.append(mixed(total[same]))
        owners.append(owner[:count][same])
    who = np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    ids = (np.concatenate(hashes)[order] % np.uint64(s.buckets)).astype(np.int64)
    return ids, np.searchsorted(who[order], np.arange(len(cut)))


def spans(count: int, size: int) -> list[tuple[int, int]]:
    """Passages over ``count`` words: ``size`` words each, the next starts half a passage later."""
    if count <= size:
        return [(0, count)]
    starts = list(range(0, count - size, size // 2)) + [count - size]
    return [(a, a + size) for a in starts]


def parts_weight(starts: np.ndarray, total: int, whole: float) -> np.ndarray:
    """Weight of every part in its word: ``whole`` for the word itself, the rest for its n-grams evenly."""
    sizes = np.diff(np.append(starts, total))
    weight = np.repeat((1 - whole) / np.maximum(1, sizes - 1), sizes)
    weight[starts] = whole
    return weight.astype(np.float32)


class Network:
    """``table`` holds the vectors of the buckets, ``dense`` and ``last`` the softmax (clean, toxic)."""

    def __init__(self, table: np.ndarray, dense: np.ndarray, last: np.ndarray, s: Settings):
        self.table, self.dense, self.last, self.s = table, dense, last, s

    def word_values(self, words: list[str]) -> np.ndarray:
        """What each word adds to the toxic margin when it is the whole passage."""
        ids, starts = features(words, self.s)
        value = self.table @ (self.dense[:, 1] - self.dense[:, 0])
        return np.add.reduceat(value[ids] * parts_weight(starts, len(ids), self.s.whole), starts)

    @property
    def bias(self) -> float:
        return float(self.last[1] - self.last[0])


def constant(share: float | None, s: Settings) -> Network:
    """The network of a table with no label or with one label only."""
    margin = -np.inf if not share else np.inf
    return Network(np.zeros((s.buckets, s.dim), np.float32), np.zeros((s.dim, 2), np.float32), np.array([0, margin]), s)


def train(data: list[str], truth: np.ndarray, s: Settings) -> Network:
    """Adam on mini-batches of texts, a quarter of them toxic. A text's mean is a sparse row
    over the buckets, so table and softmax get their slopes from the same few products."""
    rng = np.random.default_rng(s.seed)
    net = Network(rng.normal(0, 0.1, (s.buckets, s.dim)).astype(np.float32), rng.normal(0, 0.5, (s.dim, 2)).astype(np.float32), np.zeros(2, np.float32), s)
    known: dict[str, int] = {}
    counted = [collections.Counter(known.setdefault(w, len(known)) for w in terms(t)) for t in data]
    if not known:
        return constant(None, s)
    ids, starts = features(list(known), s)
    sizes, share = np.diff(np.append(starts, len(ids))), parts_weight(starts, len(ids), s.whole)
    rows = []
    for words in counted:
        own, times = np.fromiter(words.keys(), np.int64, len(words)), np.fromiter(words.values(), np.float32, len(words))
        n = sizes[own]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[own], n)
        rows.append((ids[at].astype(np.int32), (np.repeat(times / max(1, times.sum()), n) * share[at]).astype(np.float32)))
    groups = [np.flatnonzero((truth == label) & np.array([len(r[0]) > 0 for r in rows])) for label in (0, 1)]
    if not all(map(len, groups)):
        return constant(None, s)
    # Start from how much oftener toxic texts have a part, so that training only has to refine it.
    shares = [np.bincount(np.concatenate([np.unique(rows[i][0]) for i in g]), minlength=s.buckets) / len(g) for g in groups]
    odds = np.log((shares[1] + s.prior / len(groups[1])) / (shares[0] + s.prior / len(groups[1])))
    net.table *= 0.02
    net.table[:, 0] = np.sign(odds) * np.maximum(0, np.abs(odds) - s.cut)
    net.dense[0] = [-s.gain, s.gain]
    margins = np.array([net.table[r[0], 0] @ r[1] if len(r[0]) else 0 for r in rows]) * 2 * s.gain
    net.last[:] = 0, -(np.median(margins[groups[0]]) + np.median(margins[groups[1]])) / 2
    values = [net.table, net.dense, net.last]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    turns = [_turns(g, n, rng) for g, n in zip(groups, (s.batch - s.batch // 4, s.batch // 4))]
    for step in range(1, s.steps + 1):
        pick = np.concatenate([next(t) for t in turns])
        parts, weight = (np.concatenate([rows[i][k] for i in pick]) for k in (0, 1))
        lengths = np.array([len(rows[i][0]) for i in pick])
        mean = np.add.reduceat(net.table[parts] * weight[:, None], np.cumsum(lengths) - lengths)
        z = mean @ net.dense + net.last
        z = np.exp(z - z.max(1, keepdims=True))
        d = z / z.sum(1, keepdims=True)
        d[np.arange(len(pick)), truth[pick]] -= 1
        d /= len(pick)
        back = np.repeat(d @ net.dense.T, lengths, 0) * weight[:, None]
        slope = np.stack([np.bincount(parts, back[:, j], s.buckets) for j in range(s.dim)], 1)
        slopes = [slope, mean.T @ d, d.sum(0)]
        for v, g, a, b in zip(values, slopes, first, second):
            a += 0.1 * (g.astype(np.float32) - a)
            b += 0.01 * (g.astype(np.float32) ** 2 - b)
            v -= s.rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + s.floor)
    return net


def _turns(group: np.ndarray, size: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Without end: ``size`` members at a time, shuffled anew when all had their turn."""
    queue = np.empty(0, np.int64)
    while True:
        while len(queue) < size:
            queue = np.append(queue, rng.permutation(group))
        yield queue[:size]
        queue = queue[size:]


def learnable() -> F.Column:
    """Rows whose label may be learned, by the id's checksum."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, s: Settings | None = None) -> Network:
    """A network from the learnable rows of ``docs`` that ``labels`` (doc_id, toxic) marks."""
    s = s or Settings()
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(learnable() & F.col("toxic").isNotNull())
    marked = marked.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marked = marked.withColumn("h", F.xxhash64(F.lit(s.seed), "doc_id"))
    half = s.sample_rows // 2
    # Twice as many ids as needed are drawn, as some texts may be missing or too long.
    drawn = [marked.filter(F.col("toxic") == label).orderBy("h", "doc_id").limit(2 * half) for label in (0, 1)]
    usable = docs.select("doc_id", "text").filter(F.length("text") <= s.sample_chars)
    usable = usable.join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id").groupBy("doc_id", "toxic", "h").agg(F.min("text").alias("text"))
    rows = [r for label in (0, 1) for r in usable.filter(F.col("toxic") == label).orderBy("h", "doc_id").limit(half).collect()]
    clean = sum(r["toxic"] == 0 for r in rows)
    truth = np.array([0] * clean + [1] * (len(rows) - clean), np.int64)
    if clean in (0, len(rows)):
        return constant(1.0 if rows and not clean else None, s)
    return train([r["text"] for r in rows], truth, s)


class Reader:
    """Scores texts with one number per word; the numbers of at most ``cache_words`` words are kept."""

    def __init__(self, net: Network):
        self.net, self.known = net, {}

    def values(self, words: list[str]) -> np.ndarray:
        known = self.known
        fresh = [w for w in set(words) if w not in known]
        if len(known) + len(fresh) > self.net.s.cache_words:
            known.clear()
            fresh = list(set(words))
        for k in range(0, len(fresh), 50_000):
            part = fresh[k : k + 50_000]
            known.update(zip(part, self.net.word_values(part).tolist()))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))

    def margin(self, text: str) -> float:
        words = terms(text)
        if not words or not np.isfinite(self.net.bias):
            return self.net.bias
        sums = np.concatenate(([0.0], np.cumsum(self.values(words))))
        cuts = np.array(spans(len(words), self.net.s.passage))
        return self.net.bias + float(((sums[cuts[:, 1]] - sums[cuts[:, 0]]) / (cuts[:, 1] - cuts[:, 0])).max())


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; only the text is read for it."""
    docs = docs.select("doc_id", "text", (~learnable()).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        reader = Reader(shared.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            margins = np.array([reader.margin(t) for t in texts(batch)], np.float64)
            score = 1 / (1 + np.exp(-np.clip(margins, -700, 700)))
            score = np.where(np.isneginf(margins), 0.0, np.where(np.isposinf(margins), 1.0, score))
            made = [pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())]
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "held_out"), *made],
                                              names=["doc_id", "held_out", "score", "predicted"])

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs, make, f"doc_id {kind}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, s: Settings | None = None) -> DataFrame:
    """Fit on the learnable labelled rows and score every row of ``docs``."""
    return scored(docs, fit(docs, labels, s))
