"""Spelling variants by reduced-alphabet generation.

Letters are hashed to a few symbols. Two words that differ by one edit have reduced words that
differ by one edit at most, so every word generates the full one-edit neighbourhood of its reduced
word (itself, every deletion, replacement and insertion of a symbol), and joining that with the
reduced vocabulary finds all candidates; the edit distance of the words themselves decides.
Reduced words are 64-bit polynomial hashes, so numpy makes the neighbourhoods of many words of one
length at once, from running sums. Keys that no word of the vocabulary can have are dropped where
they are made, by a bitmap of fixed size that is broadcast.

A reduced word that more than ``Settings.crowd`` words share is not joined: its words generate their
neighbourhood over the whole alphabet instead, where only true neighbours meet, and the links they
find to words that are not crowded count in both directions. So no group is paired with itself, and
no link is lost.

Null text: no words. Texts are read whole; words of any length count, those over ``Settings.carried``
code points travel as ids and meet again for the check. Repeated rows count again. Null ``doc_id``
has an empty text as id. Ties between forms of equal count go to the smaller word by code point.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import collections
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.shared import column, mixed, pieces, text_bytes, written
from windrow.scale import ship


@dataclass
class Settings:
    damage: int = 199
    shortest: int = 6
    occurrences: int = 5
    symbols: int = 8
    crowd: int = 64
    carried: int = 256
    bits: int = 27
    ratio: int = 5


# A-Z become a-z; letters of the range stay; every other byte ends a word.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters, one byte per code point (Latin-1)."""
    return text.encode("latin-1", "replace").translate(_FOLD).split(b" ")


def counted_words(texts: list[str], ids: list, s: Settings, into: collections.Counter) -> None:
    """Add the words of some texts, after the seeded deletions, to a counter."""
    for text, ident in zip(texts, ids):
        own = collections.Counter(runs(text))
        start = zlib.crc32(f"{'' if ident is None else ident}:".encode())
        for word, n in own.items():
            if len(word) < s.shortest:
                continue
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
            if h % s.damage == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < s.shortest:
                    continue
            into[word] += n


def vocabulary(docs: DataFrame, s: Settings, room: int = 200_000) -> DataFrame:
    """(word, n) of all words that are long and frequent enough; tasks hand on partial counts."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: collections.Counter = collections.Counter()

        def flush():
            words = pa.array([w.decode("latin-1") for w in counts], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for part in pieces(batch, 200):
                data = [t.decode("utf-8", "replace") for t in text_bytes(part)]
                counted_words(data, column(part, "doc_id").to_pylist(), s, counts)
                if len(counts) > room:
                    yield flush()
        yield flush()

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= s.occurrences)


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def symbols_of(letters: np.ndarray, symbols: int) -> np.ndarray:
    """Letters (Latin-1 codes) as symbols 0 ... symbols - 1."""
    return (mixed(letters.astype(np.uint64) + np.uint64(77)) >> np.uint64(20)) % np.uint64(symbols)


def _values(symbols: np.ndarray) -> np.ndarray:
    return mixed(symbols + np.uint64(1))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


class Keys:
    """Hashes of reduced words: the sum of symbol value times base to the place, scrambled with the length."""

    def __init__(self, words: list[bytes], symbols: int):
        letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        self.length = letters.shape[1]
        self.symbols = symbols_of(letters, symbols) if symbols < 256 else letters.astype(np.uint64)
        self.values = _values(self.symbols)
        self.each = _values(np.arange(symbols, dtype=np.uint64) if symbols < 256 else _ALPHABET)
        self.power = _powers(_BASE, self.length + 1)
        terms = self.values * self.power[: self.length]
        self.upto = np.concatenate([np.zeros((len(words), 1), np.uint64), np.cumsum(terms, 1, dtype=np.uint64)], 1)
        self.total = self.upto[:, -1]

    def sealed(self, sums: np.ndarray, length: int) -> np.ndarray:
        return mixed(sums ^ mixed(np.full(1, length, np.uint64)))

    def own(self) -> np.ndarray:
        return self.sealed(self.total, self.length)

    def neighbourhood(self, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, key) arrays that together hold every reduced word within one edit."""
        count, n = self.values.shape
        rows = np.arange(count)
        yield rows, self.own()
        back = np.uint64(_BACK)
        step = max(1, most // (max(1, count) * len(self.each)))
        for a in range(0, n + 1, step):
            places = slice(a, min(n, a + step))
            before, after = self.upto[:, places], self.total[:, None] - self.upto[:, 1:][:, places]
            if before.shape[1]:
                yield np.repeat(rows, before.shape[1]), self.sealed(before + after * back, n - 1).ravel()
                others = (before + after)[:, :, None] + self.each * self.power[:n][places][:, None]
                yield np.repeat(rows, before.shape[1] * len(self.each)), self.sealed(others, n).ravel()
            gaps = slice(a, min(n + 1, a + step))
            left = self.upto[:, gaps]
            wider = left + (self.total[:, None] - left) * np.uint64(_BASE)
            wider = wider[:, :, None] + self.each * self.power[gaps][:, None]
            yield np.repeat(rows, left.shape[1] * len(self.each)), self.sealed(wider, n + 1).ravel()


_ALPHABET = np.array([*range(97, 123), *range(0xC0, 0x100)], np.uint64)


def _by_length(words: list[bytes], most: int = 1 << 16) -> Iterator[np.ndarray]:
    """Row numbers of words of equal length, a bounded number of letters at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        step = max(1, most // max(1, int(n)))
        yield from (rows[k : k + step] for k in range(0, len(rows), step))


def _latin(batch: pa.RecordBatch) -> list[bytes]:
    return [w.encode("latin-1") for w in column(batch, "word").to_pylist()]


def with_keys(vocab: DataFrame, s: Settings) -> DataFrame:
    """Add to (word, n) the keys of the reduced word (coarse) and of the word itself (fine)."""
    ship(vocab.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _latin(batch)
            coarse, fine = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
            for rows in _by_length(words):
                part = [words[i] for i in rows]
                coarse[rows], fine[rows] = Keys(part, s.symbols).own(), Keys(part, 256).own()
            yield pa.RecordBatch.from_arrays([column(batch, "word"), column(batch, "n"), pa.array(coarse.view(np.int64)), pa.array(fine.view(np.int64))],
                                             names=["word", "n", "coarse", "fine"])

    return vocab.mapInArrow(run, "word string, n bigint, coarse bigint, fine bigint")


_CELL = 32_768


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Two places of each key in the bitmap; the SQL form of the same places is in ``bitmap``."""
    k = keys.view(np.uint64)
    return (k >> np.uint64(1)) & np.uint64((1 << bits) - 1), (k >> np.uint64(33)) & np.uint64((1 << bits) - 1)


def bitmap(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """A bit for each of two places of every key: at most 2 ** ``bits`` / 8 bytes come to the driver."""
    mask = F.lit((1 << bits) - 1)
    places = F.explode(F.array(F.shiftrightunsigned(key, 1).bitwiseAND(mask), F.shiftrightunsigned(key, 33).bitwiseAND(mask)))
    cells = keys.select(places.alias("p")).groupBy((F.col("p") / _CELL).cast("int").alias("cell"))
    found = cells.agg(F.bitmap_construct_agg((F.col("p") % _CELL).cast("bigint")).alias("bits"))
    out = np.zeros(((1 << bits) + 7) // 8, np.uint8)
    width = min(len(out), _CELL // 8)
    for r in found.toLocalIterator():
        out[r["cell"] * width : (r["cell"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)[:width]
    return out


def _bits_for(rows: int, most: int) -> int:
    """Bits of a bitmap with 16 places or more per row, up to ``most``; beyond that it lets more through."""
    return min(most, max(15, (16 * rows).bit_length()))


def neighbours(words: DataFrame, seen: np.ndarray, bits: int, symbols: int, s: Settings) -> DataFrame:
    """(key, word, n, id) for every neighbourhood key of ``words`` that the bitmap does not rule out."""
    shared = words.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitset = shared.value
        for batch in batches:
            words = _latin(batch)
            for rows in _by_length(words):
                keys = Keys([words[i] for i in rows], symbols)
                who, found = [], []
                for row, key in keys.neighbourhood():
                    one, two = _places(key, bits)
                    there = (bitset[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8)) & (bitset[two >> np.uint64(3)] >> (two & np.uint64(7)).astype(np.uint8)) & 1
                    there = np.flatnonzero(there)
                    who.append(row[there])
                    found.append(key[there])
                pairs = np.unique(np.stack([np.concatenate(who).astype(np.uint64), np.concatenate(found)], 1), axis=0)
                own = pa.array(rows[pairs[:, 0].astype(np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1].copy().view(np.int64)), *(column(batch, c).take(own) for c in ("word", "n", "id"))],
                                                 names=["key", "word", "n", "id"])

    slim = words.select("word", "n", F.xxhash64("word").alias("id"))
    made = slim.mapInArrow(run, "key bigint, word string, n bigint, id bigint")
    # Of very long words only the id travels with the keys.
    return made.withColumn("word", F.when(F.length("word") <= s.carried, F.col("word")))


def _near(left: str, right: str):
    return (F.col(left) != F.col(right)) & (F.levenshtein(left, right, 1) == 1)


def _merged(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of sides that grow with the vocabulary, never a broadcast.

    Spark sizes neighbourhoods as the words they are made from, and written words by their compressed files;
    both are far too low.
    """
    return left.join(right.hint("merge"), key, how)


def _meet(generated: DataFrame, words: DataFrame, key: str, s: Settings, *keep: str) -> DataFrame:
    """(word, n, near, near_n) for generated keys that meet a word of the vocabulary one edit away."""
    other = words.select(F.col(key).alias("key"), F.when(F.length("word") <= s.carried, F.col("word")).alias("near"), F.col("n").alias("near_n"),
                         F.xxhash64("word").alias("near_id"), *keep)
    met = _merged(generated, other, "key")
    short = met.filter(_near("word", "near"))
    long = met.filter("word is null or near is null")
    ids = words.filter(F.length("word") >= s.carried).select("word", F.xxhash64("word").alias("id"))
    long = _merged(long.drop("word", "near"), ids, "id")
    long = _merged(long, ids.select(F.col("word").alias("near"), F.col("id").alias("near_id")), "near_id").filter(_near("word", "near"))
    cols = ["word", "n", "near", "near_n", *keep]
    return short.select(*cols).unionByName(long.select(*cols).distinct())


def near_words(vocab: DataFrame, s: Settings | None = None) -> DataFrame:
    """(word, n, near, near_n): every pair of vocabulary words that are one edit apart, both ways."""
    s = s or Settings()
    keyed = written(with_keys(vocab, s), "words")
    bits = _bits_for(keyed.count(), s.bits)
    crowded = keyed.groupBy("coarse").agg(F.count(F.lit(1)).alias("same")).filter(F.col("same") > s.crowd).select("coarse", F.lit(True).alias("crowded"))
    words = written(keyed.join(crowded, "coarse", "left").fillna(False, ["crowded"]), "words-crowded")
    sparse, dense = words.filter("not crowded"), words.filter("crowded")
    made = neighbours(sparse, bitmap(sparse, "coarse", bits), bits, s.symbols, s)
    links = _meet(made, sparse, "coarse", s)
    if not dense.take(1):
        return links
    made = neighbours(dense, bitmap(words, "fine", bits), bits, 256, s)
    found = written(_meet(made, words, "fine", s, "crowded"), "links-crowded")
    back = found.filter("not crowded").select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return links.unionByName(found.drop("crowded")).unionByName(back)


def variants(docs: DataFrame, s: Settings | None = None) -> DataFrame:
    """One row per word of the vocabulary of ``docs`` (doc_id, text): word, form, root, n, n_near, form_n."""
    s = s or Settings()
    vocab = written(vocabulary(docs, s), "vocabulary")
    links = near_words(vocab, s)
    # Largest count first, then the smaller word: the least struct of (-count, word).
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    rows = _merged(vocab, near, "word", "left")
    fits = -F.col("best.less") >= s.ratio * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.near")).alias("form"),
                       F.when(fits, -F.col("best.less")).cast("bigint").alias("form_n"))
    rows = written(rows, "forms")
    roots = _roots(rows.filter("form is not null").select("word", "form"))
    return _merged(rows, roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): pointers double each round; counts grow along them, so there are few rounds."""
    at = written(forms.select("word", F.col("form").alias("root"), F.lit(False).alias("moved")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = written(_merged(at, ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not at.filter("moved").take(1):
            return at.drop("moved")
