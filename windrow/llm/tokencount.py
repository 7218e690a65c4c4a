"""Token counts by a two-tier table of pre-token lengths; no pre-token is ever shuffled.

A text falls into pieces that the tokenizer never joins: a run of characters that are not
white space with at most one space before it, or white space. Tier one is a compact table
(piece -> number of tokens) of the pieces that are frequent in a bounded sample; it is
broadcast, its size is a parameter, and it changes only the speed. Tier two is a cache in each
Python worker; what neither knows is encoded by the tokenizer itself, in batches. Every text
is counted whole, very long ones slice by slice.

Null text: empty, 0 bytes, 0 tokens. Null or repeated ``doc_id``: rows stay as they are. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from windrow.llm.shared import column, per_batch, texts
from windrow.scale import ship

# White space as the tokenizer's own pattern sees it (fixed values).
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")
_CUT = re.compile(f"(?<=[^{_WS}]) (?=[^{_WS}])")


def slices(text: str, size: int = 1 << 20) -> Iterator[str]:
    """Cut a long text before single spaces between words, where no token can span."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Lengths(dict):
    """Piece -> tokens. ``late`` gathers unknown pieces until the batch is encoded."""

    def __init__(self, tokenizer, known: dict[str, int], most: int, longest: int = 48):
        super().__init__(known)
        self.tokenizer, self.known, self.most, self.longest = tokenizer, known, most, longest
        self.late: list[tuple[int, str]] = []
        self.row = 0

    def __missing__(self, piece: str) -> int:
        self.late.append((self.row, piece))
        return 0

    def settle(self, counts: list[int]) -> None:
        """Encode the gathered pieces and add their tokens to the rows they came from.

        Marks after a letter or digit are a token run of their own, so ``word,`` is counted as
        ``word`` and ``,``: most unseen pieces need no encoding."""
        late = {p for _, p in self.late}
        split: dict[str, tuple[str, str]] = {}
        for piece in late:
            base = piece.rstrip(".,!?;:")
            if len(base) < len(piece) <= self.longest and base[-1:].isascii() and base[-1:].isalnum():
                split[piece] = base, piece[len(base) :]
        fresh = {p for pair in split.values() for p in pair if p not in self} | (late - split.keys())
        ours: dict[str, int] = {}
        for i in range(0, len(fresh := list(fresh)), 4096):
            part = fresh[i : i + 4096]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            ours.update(zip(part, map(len, encoded)))
        parts = {p: sum(ours[x] if x in ours else self[x] for x in pair) for p, pair in split.items()}
        for row, piece in self.late:
            counts[row] += parts[piece] if piece in parts else ours[piece]
        self.late.clear()
        room = self.most + len(self.known) - len(self)
        self.update(islice(((p, n) for p, n in ours.items() if len(p) <= self.longest), max(0, room)))


_tables: dict = {}


def load(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _sampled_pieces(docs: DataFrame, sample_docs: int, pieces: int) -> list[str]:
    """The most frequent pieces of about ``sample_docs`` documents picked by a hash of id and text."""
    n = docs.count()
    if not n:
        return []
    step = max(1, n // sample_docs)
    picked = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(step)) == 0).select("text")

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in texts(batch):
                for part in slices(text):
                    seen.update(p for p in _PIECE.findall(part) if len(p) <= 48)
        top = seen.most_common(2 * pieces)
        yield pa.record_batch({"piece": pa.array([p for p, _ in top], pa.string()), "n": pa.array([c for _, c in top], pa.int64())})

    ship(docs.sparkSession)
    found = picked.mapInArrow(count, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    return [r["piece"] for r in found.orderBy(F.desc("n"), "piece").limit(pieces).collect()]


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = 1024, table_pieces: int = 50_000,
                 sample_docs: int = 2_000, cache_pieces: int = 300_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text).

    ``table_pieces`` bounds the broadcast table, ``cache_pieces`` each worker's cache.
    """
    docs = docs.select("doc_id", "text")
    tok = load(tokenizer_file)
    frequent = _sampled_pieces(docs, sample_docs, table_pieces)
    lengths = np.array([len(e) for e in tok.encode_batch(frequent, add_special_tokens=False)], np.uint16)
    packed = ("\n".join(p.encode("unicode_escape").decode() for p in frequent), lengths.tobytes())
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    name = (tokenizer_file, xxhash.xxh3_64_intdigest(packed[0].encode()), cache_pieces)

    def make():
        if _tables.get("name") != name:
            names, raw = shared.value
            pieces = [p.encode().decode("unicode_escape") for p in names.split("\n")] if names else []
            known = dict(zip(pieces, np.frombuffer(raw, np.uint16).tolist()))
            _tables.update(name=name, table=Lengths(load(tokenizer_file), known, cache_pieces))
        tab = _tables["table"]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, sizes = [0] * batch.num_rows, []
            get = tab.__getitem__
            for i, text in enumerate(texts(batch)):
                sizes.append(len(text.encode("utf-8", "replace")))
                tab.row = i
                for part in slices(text):
                    counts[i] += sum(map(get, _PIECE.findall(part)))
                if len(tab.late) >= 50_000:
                    tab.settle(counts)
            tab.settle(counts)
            return pa.record_batch({
                "doc_id": column(batch, "doc_id"), "n_bytes": pa.array(sizes, pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "over_limit": pa.array([c > limit for c in counts], pa.bool_())})

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs, make, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
