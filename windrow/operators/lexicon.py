"""Lemmas by a word automaton: one narrow step, no table of tokens.

The lexicon becomes a minimal acyclic automaton (Daciuk and others, 2000) in flat arrays, a few
bytes a word, which is broadcast. A batch looks every distinct token up once; all candidate forms
of a batch walk the automaton together, one letter a step.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.operators.lemmas import NOUN_SUFFIXES
from windrow.scale import ship

# Largest lexicon that is read to the driver and made an automaton; beyond it lemmas are a joined table.
LEXICON_WORDS = 2_000_000
# Bits of a code point in an arc's key.
_POINT = 21


class WordAutomaton:
    """``keys`` holds source << 21 | code point of every arc, sorted; ``targets`` where it leads; ``final``
    the states that end a word. State 0 is the start."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, final: np.ndarray):
        self.keys, self.targets, self.final = keys, targets, final

    @classmethod
    def of(cls, words: Iterable[str]) -> WordAutomaton:
        """From words in code-point order. Only the path of the last word is open at a time; what it
        leaves behind is replaced by an equal state seen before, if there is one."""
        known: dict[tuple, int] = {}
        arcs: list[tuple] = []
        path: list[tuple[list, list]] = [([], [False])]
        before = ""

        def close(down_to: int) -> None:
            while len(path) > down_to + 1:
                own, end = path.pop()
                state = (end[0], *own)
                if state not in known:
                    known[state] = len(arcs) + 1
                    arcs.append(state)
                last = path[-1][0]
                last[-1] = (last[-1][0], known[state])

        for word in words:
            same = 0
            while same < min(len(word), len(before)) and word[same] == before[same]:
                same += 1
            if word == before and before:
                continue
            close(same)
            for letter in word[same:]:
                path[-1][0].append((letter, 0))
                path.append(([], [False]))
            path[-1][1][0] = True
            before = word
        close(0)
        own, end = path[0]
        states = [(end[0], *own), *arcs]
        keys = [(at << _POINT) | ord(letter) for at, state in enumerate(states) for letter, _ in state[1:]]
        targets = [to for state in states for _, to in state[1:]]
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        return cls(np.array(keys, np.int64)[order], np.array(targets, np.int32)[order], np.array([s[0] for s in states]))

    def accepts(self, forms: list[str]) -> np.ndarray:
        """Which of the forms are words of the list."""
        out = np.zeros(len(forms), bool)
        if not len(forms):
            return out
        lengths = np.fromiter(map(len, forms), np.int64, len(forms))
        points = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        live, state = np.arange(len(forms)), np.zeros(len(forms), np.int64)
        at = 0
        while len(live):
            done = lengths[live] == at
            out[live[done]] = self.final[state[done]]
            live, state = live[~done], state[~done]
            if not len(live) or not len(self.keys):
                break
            key = (state << _POINT) | points[starts[live] + at]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[place] == key
            live, state = live[there], self.targets[place[there]].astype(np.int64)
            at += 1
        return out


def _one_step(form: str) -> list[str]:
    made = (form[: len(form) - len(old)] + new for old, new in NOUN_SUFFIXES if form.endswith(old))
    return [f for f in made if f]


class Lexicon:
    """The rules of ``lemma_table`` over an automaton and a table of irregular forms."""

    def __init__(self, words: WordAutomaton, irregular: dict[str, list[str]]):
        self.words, self.irregular = words, irregular

    def lemmas(self, tokens: list[str]) -> list[str]:
        """The lemma of every token; the token itself where no rule ends in a known word."""
        out = list(tokens)
        ends = tuple(old for old, _ in NOUN_SUFFIXES)
        open_: dict[int, list[str]] = {}
        frontier: dict[int, list[str]] = {}
        for i, token in enumerate(tokens):
            if token in self.irregular:
                open_[i], frontier[i] = [token, *self.irregular[token]], []
            elif token.endswith(ends):
                frontier[i] = _one_step(token)
                open_[i] = [token, *frontier[i]]
        while open_:
            flat = [f for forms in open_.values() for f in forms]
            known, at = self.words.accepts(flat), 0
            later: dict[int, list[str]] = {}
            for i, forms in open_.items():
                hits = [f for f, ok in zip(forms, known[at : at + len(forms)]) if ok]
                at += len(forms)
                if hits:
                    out[i] = min(hits, key=len)  # the first of the shortest
                else:
                    frontier[i] = [g for f in frontier[i] for g in _one_step(f)]
                    if frontier[i]:
                        later[i] = frontier[i]
            open_ = later
        return out


def read_lexicon(lexicon: DataFrame, exceptions: DataFrame | None = None, most: int = LEXICON_WORDS) -> Lexicon | None:
    """The automaton of ``lexicon(word)`` and ``exceptions(surface, lemma)``; None above ``most`` words."""
    words = lexicon.select("word").filter("word is not null").distinct().limit(most + 1).toArrow().column("word").to_pylist()
    if len(words) > most:
        return None
    irregular: dict[str, list[str]] = {}
    if exceptions is not None:
        for surface, lemma in sorted(map(tuple, exceptions.select("surface", "lemma").distinct().limit(most).collect())):
            irregular.setdefault(surface, []).append(lemma)
    return Lexicon(WordAutomaton.of(sorted(words)), irregular)


def lexicon_lookup(spark: SparkSession, lexicon: Lexicon):
    """Column function giving the lemmas of a list of tokens; narrow, so also for streams."""
    ship(spark)
    shared = spark.sparkContext.broadcast(lexicon)

    @F.arrow_udf("array<string>")
    def swap(col: pa.Array) -> pa.Array:
        tokens = col.flatten()
        distinct = pc.unique(tokens)
        lemmas = pa.array(shared.value.lemmas(distinct.to_pylist()), pa.string())
        new = pc.take(lemmas, pc.index_in(tokens, distinct))
        sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, new, mask=col.is_null())

    return swap
