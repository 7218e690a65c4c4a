"""Repetition coverage: characters inside repeated word n-grams and repeated lines, per text.

Rolling hashes of several n-gram lengths are made in numpy from the ids of a text's words. A
word counts as covered when it lies in an n-gram that occurs at an earlier place as well as
here; the covered characters of each length, and those in lines equal to an earlier line, are
held against a limit each. One text is one unit of work: nothing is shuffled.

Null or empty text: all counts 0, failed. Null or repeated ``doc_id``: rows stay as they are.
Other columns are ignored. An empty table gives an empty result. Very long texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from windrow.llm.shared import column, grams, per_batch, text_bytes, word_ids

_SPACES = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"


@dataclass
class Limits:
    """Most characters, as a share of all word characters, that may be repetition.

    The limits of usual repetition filters. Two equal copies of a passage fail the base rule, which
    counts the first one too, only when a quarter of the text is in the later one."""

    ngrams: dict[int, float] = field(default_factory=lambda: {5: 0.15, 6: 0.14, 8: 0.12, 10: 0.10})
    lines: float = 0.20
    min_words: int = 50
    repeat_percent: int = 50


def points(data: bytes) -> int:
    """Code points of UTF-8 bytes: all bytes but continuation bytes."""
    raw = np.frombuffer(data, np.uint8)
    return len(raw) - int(np.count_nonzero((raw & 0xC0) == 0x80))


_CONTINUED = bytes(range(0x80, 0xC0))


def leading(data: bytes) -> bytes:
    """One byte for each code point: its first."""
    return data if data.isascii() else data.translate(None, _CONTINUED)


def covered(keys: np.ndarray, n: int, words: int, later_only: bool) -> np.ndarray:
    """Words inside n-grams found twice or more (``later_only``: without first occurrences)."""
    edge = np.zeros(words + 1, np.int32)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        if not later_only:
            twice[order[:-1][same]] = True
        at = np.flatnonzero(twice)
        edge[at] += 1
        np.subtract.at(edge, at + n, 1)
    return np.cumsum(edge[:-1]) > 0


def measures(data: bytes, limits: Limits) -> tuple:
    words = data.split()
    n = len(words)
    symbols = sum(map(data.count, [bytes([s]) for s in _SYMBOLS]))
    lines = [line for line in data.split(b"\n") if line.strip(_SPACES)]
    unique = set(lines)
    dup_lines = len(lines) - len(unique)
    size = points(data) - sum(map(data.count, [bytes([s]) for s in _SPACES]))
    if not n:
        return 0, 0, symbols, 0, 0, 0.0, 0.0, True, False
    seq = word_ids(words)
    lengths = np.fromiter(map(len, leading(data).split()), np.int64, n)
    repeat = int(np.count_nonzero(covered(grams(seq, 3), 3, n, False)))
    failed = n < limits.min_words or 100 * repeat > limits.repeat_percent * n
    total, worst, within = int(lengths.sum()), 0.0, True
    for k, most in limits.ngrams.items():
        share = int(lengths[covered(grams(seq, k), k, n, True)].sum()) / total
        worst, within = max(worst, share), within and share <= most
    in_lines = 0.0
    if dup_lines:
        seen: set[bytes] = set()
        for line in lines:
            if line in seen:
                in_lines += sum(map(len, leading(line).split()))
            seen.add(line)
        in_lines /= total
    return n, size, symbols, dup_lines, repeat, worst, in_lines, failed, not failed and within and in_lines <= limits.lines


_FIELDS = (
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("ngram_cover", pa.float64()), ("line_cover", pa.float64()),
    ("base_failed", pa.bool_()), ("kept", pa.bool_()))


def repetition(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (doc_id, text)."""
    docs, limits = docs.select("doc_id", "text"), limits or Limits()

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [measures(data, limits) for data in text_bytes(batch)]
            made = [pa.array(c, kind) for c, (_, kind) in zip(zip(*found), _FIELDS)]
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), *made], names=["doc_id", *(n for n, _ in _FIELDS)])

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs, make, f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                     "n_repeat_words bigint, ngram_cover double, line_cover double, base_failed boolean, kept boolean")
