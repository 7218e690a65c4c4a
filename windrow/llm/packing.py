"""Best-fit packing with a fixed number of open bins, bin lookup by a bitset of free space.

Every task packs its own documents online: a piece goes to the open bin that it fills most
(smallest free space that is large enough, found in a bitset keyed by free space); when too many
bins are open, the fullest closes first. Bins still open at the end of a task are packed once
more: groups of tasks hand their leftovers to one task, level by level, so that the waste does
not grow with the number of tasks. A group holds at most ``fan_in`` tasks' open bins.

Null text: empty, one piece with the closing id alone. Repeated rows are packed each on its own.
Null ids stay. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from windrow.llm.shared import column, pieces, small_batches, text_bytes, written
from windrow.llm.tokencount import load
from windrow.scale import ship

_PIECE_FIELDS = "piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


class Bins:
    """Open bins keyed by free space. ``put`` places a piece and returns the rows of a closed bin."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.count, self.bits = size, most, 0, 0
        self.by_free: dict[int, list[list]] = {}

    def _take(self, free: int) -> list:
        group = self.by_free[free]
        rows = group.pop()
        if not group:
            del self.by_free[free]
            self.bits ^= 1 << free
        self.count -= 1
        return rows

    def put(self, length: int, row: tuple) -> list | None:
        fit = self.bits >> length
        free = length + (fit & -fit).bit_length() - 1 if fit else self.size
        rows = self._take(free) if fit else []
        rows.append((row, self.size - free))
        free -= length
        if not free:
            return rows
        self.by_free.setdefault(free, []).append(rows)
        self.bits |= 1 << free
        self.count += 1
        if self.count > self.most:
            return self._take((self.bits & -self.bits).bit_length() - 1)
        return None

    def rest(self) -> Iterator[list]:
        for free in sorted(self.by_free):
            yield from self.by_free[free]


class WordCodes(dict):
    """Word (bytes) -> its token ids as little-endian 32-bit bytes. Keeps the first ``most`` words that
    were unknown twice; a bitmap of hashes marks those unknown once, most of which never come back."""

    _MARKS = b".,!?;:"

    def __init__(self, tokenizer, most: int, longest: int = 48):
        super().__init__()
        self.tokenizer, self.most, self.longest = tokenizer, most, longest
        self.marks: dict[bytes, bytes] = {}
        self.once = bytearray(1 << 22)

    def _again(self, word: bytes) -> bool:
        at = hash(word) & (8 * len(self.once) - 1)
        old, bit = self.once[at >> 3], 1 << (at & 7)
        self.once[at >> 3] = old | bit
        return bool(old & bit)

    def _encode(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        for i in range(0, len(words), 4096):
            part = words[i : i + 4096]
            found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
            yield from ((w, _code(e.ids)) for w, e in zip(part, found))

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Codes of words not yet known. Marks after a letter or digit are a token run of their
        own, so ``word,`` is ``word`` and ``,``: most unseen words need no encoding."""
        split: dict[bytes, tuple[bytes, bytes]] = {}
        for w in words:
            base = w.rstrip(self._MARKS)
            if len(base) < len(w) and base[-1:].isalnum() and len(w) <= self.longest:
                split[w] = base, w[len(base) :]
        fresh = {b for b, _ in split.values() if b not in self} | (words - split.keys())
        ours = dict(self._encode(list(fresh)))
        self.marks.update(self._encode(list({m for _, m in split.values() if m not in self.marks})))
        room = self.most - len(self)
        self.update(islice(((w, c) for w, c in ours.items() if len(w) <= self.longest and self._again(w)), max(0, room)))
        for w, (base, mark) in split.items():
            ours[w] = (ours[base] if base in ours else self[base]) + self.marks[mark]
        return ours


def _code(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_coders: dict = {}


def _coder(path: str, most: int) -> WordCodes:
    if (path, most) not in _coders:
        _coders.clear()
        _coders[path, most] = WordCodes(load(path), most)
    return _coders[path, most]


def encoded(data: list[bytes], coder: WordCodes) -> Iterator[bytes]:
    """Token ids of each text, as bytes. Words are separated by white space, which has no token;
    the tokenizer lowers letters itself, so texts without special strings are lowered before."""
    for text in data:
        words = (text if b"<|" in text else text.lower()).split()
        got = list(map(coder.get, words))
        if None in got:
            ours = coder.learn({w for w, c in zip(words, got) if c is None})
            got = [ours[w] if c is None else c for w, c in zip(words, got)]
        yield b"".join(got)


def pack(docs: DataFrame, tokenizer_file: str, size: int = 2048, end_id: int = 0, open_bins: int = 256,
         fan_in: int = 16, cache_words: int = 1_200_000) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their place: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. ``end_id`` follows each document's ids; longer documents are cut."""
    docs = docs.select("doc_id", "text")
    ship(docs.sparkSession)
    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_PIECE_FIELDS}, task int"
    end = _code([end_id])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        coder, bins, out = _coder(tokenizer_file, cache_words), Bins(size, open_bins), _Rows(schema, kind, task)
        for batch in chain.from_iterable(map(pieces, batches)):
            data = text_bytes(batch)
            for doc, ids in zip(column(batch, "doc_id").to_pylist(), encoded(data, coder)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    n = len(part) // 4
                    done = bins.put(n, (doc, piece, at // 4, n, zlib.crc32(part)))
                    if done:
                        out.add(done, None)
            if out.full():
                yield out.flush()
        for rows in bins.rest():
            out.add(rows, task)
        yield out.flush()

    with small_batches(docs.sparkSession):
        placed = written(docs.mapInArrow(first, schema), "packed")
    settled, left = placed.filter("task is null"), placed.filter("task is not null")
    tasks = (left.agg(F.max("task")).first()[0] or 0) + 1
    level = 0
    while tasks > 1:
        tasks, level = -(-tasks // fan_in), level + 1

        grouped = left.withColumn("group", F.floor(F.col("task") / fan_in).cast("int")).groupBy("group")
        placed = written(grouped.applyInArrow(_repacker(schema, kind, size, open_bins, level), schema), f"packed-{level}")
        settled, left = settled.unionByName(placed.filter("task is null")), placed.filter("task is not null")
    return settled.unionByName(left).drop("task")


def _repacker(schema: str, kind: pa.DataType, size: int, open_bins: int, level: int):
    """Packs one group's leftovers anew, the longest piece first."""

    def again(key, rows):
        group = key[0].as_py()
        bins, out = Bins(size, open_bins), _Rows(schema, kind, group | level << 22)
        ordered = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        for row in zip(*(ordered.column(c).to_pylist() for c in ("doc_id", "piece", "start", "length", "ids_crc32"))):
            done = bins.put(row[3], row)
            if done:
                out.add(done, None)
        for rest in bins.rest():
            out.add(rest, group)
        return pa.Table.from_batches([out.flush()])

    return again


class _Rows:
    """Gathers placed pieces as columns; sequence numbers are unique by task and level."""

    def __init__(self, schema: str, kind: pa.DataType, task: int):
        self.names = [f.split()[0] for f in schema.split(", ")]
        self.prefix, self.sequences, self.rows, self.kind = task << 36, 0, [], kind

    def add(self, placed: list, task: int | None) -> None:
        number = self.prefix | self.sequences
        self.sequences += 1
        self.rows += [(*row, number, offset, task) for row, offset in placed]

    def full(self) -> bool:
        return len(self.rows) >= 20_000

    def flush(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [()] * len(self.names)
        kinds = [self.kind, pa.int32(), *[pa.int64()] * 5, pa.int32()]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=self.names)
