"""Near-duplicate documents by circulant MinHash, banding, and exact Jaccard verification.

One permutation scatters shingles over a circle of places, a second gives every place its value;
signature coordinate k reads the second permutation shifted by k, so the values one shingle adds
to all coordinates lie side by side. Signatures are cut into bands, equal bands make buckets.

Documents with equal shingle sets form a class first, whatever their number, and only classes go
on. In a bucket every member is held against one pivot, and linked classes get a common label.
Buckets whose other members still carry different labels are then compared as tiles: members are
dealt into blocks of bounded size, each pair of blocks is one task's group, which returns a
spanning forest of its links and never pairs. So no bucket is one task's work, a hot bucket adds
rows in proportion to its blocks, and every candidate pair is verified or already connected.
Verification always counts common shingles of whole sets (64-bit hashes of five words).

With bands of 8 coordinates and 40 bands, a pair at similarity 0.85 is missed with a chance of
3 in a million, at 0.9 with less than 1 in 10 billion. ``representatives`` links from 0.8 and takes
52 bands of 7: at 0.8 a pair is missed with a chance of 5 in a million.

Null or empty text, or one without words: size 0, linked with nothing. Fewer words than a
shingle: the whole sequence is one shingle. Repeated rows are in one class. Rows with equal ids
and different texts stay apart unless linked. A null id never names a component unless it is
alone there. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.components import components
from windrow.llm.shared import column, folded, grams, mixed, per_batch, text_bytes, unfolded, word_ids, written

PLACES = 1 << 18


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of n-word shingles; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(grams(word_ids(words), min(n, len(words))))


def digest(found: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(found.tobytes())
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


class Circulant:
    """Signatures from two permutations, the second read with a circular shift per coordinate."""

    def __init__(self, bands: int, rows: int, seed: int):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, self.size = bands, rows, bands * rows
        self.salt = np.uint64(rng.integers(1 << 62))
        values = rng.permutation(PLACES).astype(np.uint32)
        self.shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[: self.size]]), self.size)
        self.factors = rng.integers(1, 1 << 62, rows).astype(np.uint64) | np.uint64(1)

    def bands_of(self, found: np.ndarray, chunk: int = 512) -> np.ndarray:
        at = (mixed(found ^ self.salt) >> np.uint64(64 - 18)).astype(np.int64)
        best = self.shifted[at[:chunk]].min(0)
        for k in range(chunk, len(at), chunk):
            np.minimum(best, self.shifted[at[k : k + chunk]].min(0), out=best)
        cells = best.reshape(self.bands, self.rows).astype(np.uint64)
        keys = mixed((cells * self.factors).sum(1, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64))
        return keys.view(np.int64)


def signatures(docs: DataFrame, words: int, bands: int, rows: int, seed: int) -> DataFrame:
    def make():
        hasher = Circulant(bands, rows, seed)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, first, second, keys = [], [], [], []
            for text in text_bytes(batch):
                found = shingles(text, words)
                d = digest(found)
                sizes.append(len(found))
                first.append(d[0])
                second.append(d[1])
                keys.append(hasher.bands_of(found) if len(found) else None)
            made = [pa.array(x, pa.int64()) for x in (sizes, first, second)] + [pa.array(keys, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), *made], names=["doc_id", "n", "d1", "d2", "bands"])

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs, make, f"doc_id {kind}, n bigint, d1 bigint, d2 bigint, bands array<bigint>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(d1, d2, found): the whole sets, for the documents that have a candidate."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(text, words) for text in text_bytes(batch)]
            ids = [digest(s) for s in sets]
            made = [pa.array([d[0] for d in ids], pa.int64()), pa.array([d[1] for d in ids], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(made, names=["d1", "d2", "found"])

        return step

    return per_batch(docs.select("text"), make, "d1 bigint, d2 bigint, found array<bigint>")


def compatible(a, b, percent: int):
    """Sizes that still allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def forest(nodes: np.ndarray, labels: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int, wide: int = 8192) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks (or inside one), by counting common
    shingles in a matrix product over slices of the shared shingles."""
    m = len(nodes)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    values, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen > 1
    code = (np.cumsum(shared) - 1)[code] if shared.any() else code
    keep = shared[np.searchsorted(values, np.concatenate(sets))]
    owner, code = owner[keep], code[keep]
    common = np.zeros((m, m), np.float64)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for low in range(0, int(shared.sum()), wide):
        a, b = np.searchsorted(code, [low, low + wide])
        block = np.zeros((m, wide), np.float32)
        block[owner[a:b], code[a:b] - low] = 1
        common += block @ block.T
    union = sizes[:, None] + sizes - common
    linked = (100 * common >= percent * union) & (labels[:, None] != labels)
    if len(set(sides.tolist())) > 1:
        linked &= sides[:, None] != sides
    parent = list(range(m))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        a, b = root(int(i)), root(int(j))
        if a != b:
            parent[b] = a
            edges.append((int(nodes[i]), int(nodes[j])))
    return edges


def _tile_links(percent: int):
    def run(table):
        nodes = table.column("node").to_numpy()
        labels = table.column("label").to_numpy()
        sides = table.column("side").to_numpy()
        sets = [np.asarray(s, np.int64) for s in table.column("found").to_pylist()]
        edges = forest(nodes, labels, sides, sets, percent) if len(nodes) > 1 else []
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 85, bands: int = 40, rows: int = 8, seed: int = 3,
                    tile_members: int = 256, tile_values: int = 400_000) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Links: ``100 * common >= percent * union``. A tile's side holds about ``tile_members`` sets or
    ``tile_values`` shingles, whichever is less.
    """
    docs = docs.select("doc_id", "text")
    signed = written(signatures(docs, words, bands, rows, seed), "signatures")
    held = signed.filter("n > 0")
    one = F.min("doc_id").alias("rep")
    # The class table: its written node numbers are stable. min() keeps one band array per class.
    classes = held.groupBy("n", "d1", "d2").agg(one, F.min("bands").alias("bands")).withColumn("node", F.monotonically_increasing_id())
    classes = written(classes, "classes")
    keyed = classes.select("node", "n", F.explode("bands").alias("key"))
    mark = F.xxhash64("node")
    buckets = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("values"), F.min(F.struct("node", "n")).alias("pivot"),
        F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(mark)).alias("y")).filter("size > 1")
    # The same members meet in many bands: one bucket for each set of members.
    buckets = buckets.groupBy("size", "values", "pivot", "x", "y").agg(F.min("key").alias("key")).drop("x", "y")
    members = written(keyed.join(buckets, "key").select("key", "size", "values", "pivot", "node", "n"), "members")

    pairs = members.filter(F.col("node") != F.col("pivot.node")).filter(compatible(F.col("n"), F.col("pivot.n"), percent))
    pairs = pairs.select(F.col("pivot.node").alias("a"), F.col("node").alias("b"), F.col("pivot.n").alias("na"), F.col("n").alias("nb")).distinct()
    needed = members.select("node").distinct().join(classes.select("node", "rep", "d1", "d2"), "node")
    wanted = needed.select(F.col("rep").alias("wanted")).distinct()
    chosen = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["wanted"]), "left_semi")
    found = shingle_sets(chosen, words).dropDuplicates(["d1", "d2"])
    sets = written(needed.select("node", "d1", "d2").join(found, ["d1", "d2"]).select("node", "found"), "sets")

    left = sets.select(F.col("node").alias("a"), F.col("found").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("found").alias("right"))
    common = F.size(F.array_intersect("left", "right"))
    star = pairs.join(right, "b").join(left, "a").withColumn("common", common)
    star = written(star.filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b"), "links")
    labels = components(star)

    # Buckets in which members other than the pivot still differ.
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    others = F.col("node") != F.col("pivot.node")
    open_ = (labelled.filter(others).groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .filter("lo <> hi").select("key"))
    left_over = labelled.filter(others).join(open_, "key")
    blocks = F.greatest(F.ceil(F.col("size") / tile_members), F.ceil(F.col("values") / tile_values)).cast("int")
    dealt = left_over.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("key", "node", "label", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), F.col("mine").alias("side"))
    # Inside one block the two sides are the same; a member is there once.
    met = tiles.join(sets, "node").groupBy("key", "i", "j").applyInArrow(_tile_links(percent), "a bigint, b bigint")
    rest = written(met, "rest")
    if rest.take(1):
        labels = components(star.unionByName(rest))
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = written(named.select("n", "d1", "d2", "rep", "label"), "named")
    smallest = named.groupBy("label").agg(F.min("rep").alias("component"))
    final = named.join(smallest, "label").select("n", "d1", "d2", "component")
    out = signed.drop("bands").join(final, ["n", "d1", "d2"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def representatives(docs: DataFrame, percent: int = 80, bands: int = 52, rows: int = 7, **settings) -> DataFrame:
    """``docs``, all columns, with one document of each near-duplicate group: the one with the
    smallest id. Rows with the same id and text are one document."""
    found = near_duplicates(docs, percent=percent, bands=bands, rows=rows, **settings)
    stay = found.filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    kept = folded(docs, "doc_id", "text").join(stay, F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")
    kept = kept.withColumn("_text_id", F.xxhash64("text")).dropDuplicates(["doc_id", "_text_id"])
    return unfolded(kept, docs.columns, "doc_id", "text")
