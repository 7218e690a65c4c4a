"""Spelling variants, toxicity and the prefix trie against brute-force versions."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import CLASH, ODD
from windrow.llm import prefixtrie, toxicity, variants
from windrow.llm.shared import table


def checksum(x):
    return zlib.crc32(x.encode())


# --- spelling variants ----------------------------------------------------------------------------

def variants_by_force(rows, s):
    count = collections.Counter()
    for d, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = checksum(f"{'' if d is None else d}:{w}")
            if h % s.damage == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= s.shortest and n >= s.occurrences}
    near = collections.defaultdict(set)
    holes = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less = w[:i] + w[i + 1 :]
            holes[i, less].add(w)
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda y: (-words[y], y), default=None)
        if best is not None and words[best] >= s.ratio * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def variant_rows(docs, s):
    return [tuple(r) for r in variants.variants(docs, s).select("word", "form", "root", "n", "n_near", "form_n").collect()]


@pytest.mark.parametrize("crowd", [64, 2, 0])
def test_variants_equal_brute_force_also_when_words_crowd(spark, sf, crowd):
    docs, s = table(spark, sf, "documents"), variants.Settings(crowd=crowd, carried=9)
    got = variant_rows(docs, s)
    assert len(got) == len(set(got))
    assert set(got) == variants_by_force([tuple(r) for r in docs.select("doc_id", "text").collect()], s)


def test_variants_of_odd_rows(spark):
    long = "ab" * 700
    made = [(1, None), (2, ""), (None, "nowhere " * 5), (3, "Straße straße STRASSE STRAẞE " * 5), (4, f"{long} " * 5 + f"{long}c " * 30),
            (5, "letter letters lettter lettr " * 6), (5, "letter letters lettter lettr " * 6), (6, "letteŕ x×y÷z ÀÖØöøÿ àöøöøÿ " * 40), (7, "1letter_letter2 " * 9)]
    docs = spark.createDataFrame(made, "doc_id bigint, text string").select("*", *(F.lit(i).alias(c) for i, c in enumerate([*CLASH, "word", "n", "near", "form", "coarse"])))
    for carried in (256, 4):
        s = variants.Settings(damage=3, carried=carried)
        got = variant_rows(docs.repartition(3), s)
        assert len(got) == len(set(got)) and set(got) == variants_by_force(made, s)
    assert variant_rows(docs.limit(0), variants.Settings()) == []


def test_neighbourhood_is_full():
    words = [b"abcabc", b"zzzzzz", "çéüöäß".encode("latin-1")]
    for symbols in (3, 256):
        keys = variants.Keys(words, symbols)
        found = [set() for _ in words]
        for row, key in keys.neighbourhood(most=20):
            for r, k in zip(row.tolist(), key.tolist()):
                found[r].add(k)
        alphabet = range(symbols) if symbols == 3 else [int(x) for x in variants._ALPHABET]
        for at, w in enumerate(words):
            code = [int(x) for x in (variants.symbols_of(np.frombuffer(w, np.uint8), 3) if symbols == 3 else np.frombuffer(w, np.uint8))]
            near = {tuple(code)} | {tuple(code[:i] + code[i + 1 :]) for i in range(6)}
            near |= {(*code[:i], x, *code[i + 1 :]) for i in range(6) for x in alphabet} | {(*code[:i], x, *code[i:]) for i in range(7) for x in alphabet}
            assert len(found[at]) == len(near)


# --- toxicity -------------------------------------------------------------------------------------

CLEAN = "the river runs past a green hill and many small houses stand near water with trees".split()
RUDE = "blockhead nitwit dunderhead".split()


def talk(n, seed):
    rng, out = np.random.default_rng(seed), []
    for i in range(n):
        words = list(rng.choice(CLEAN, rng.integers(30, 400)))
        bad = bool(rng.random() < 0.25)
        for at in rng.integers(0, len(words), max(2, len(words) // 40)) if bad else []:
            words[at] = str(rng.choice(RUDE))
        out.append((i, " ".join(words), int(bad)))
    return out


@pytest.fixture(scope="module")
def judged(spark):
    rows = talk(600, 3)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id bigint, quality int, toxic int")
    return rows, docs, labels, toxicity.fit(docs, labels)


def test_toxic_texts_that_were_held_out_are_found(judged):
    rows, docs, _, net = judged
    got = {r["doc_id"]: r for r in toxicity.scored(docs, net).collect()}
    for i, _, bad in rows:
        assert got[i]["held_out"] == (checksum(str(i)) % 5 == 0)
        assert 0 <= got[i]["score"] <= 1 and got[i]["predicted"] == int(got[i]["score"] >= 0.5)
    held = [(got[i]["predicted"], bad) for i, _, bad in rows if got[i]["held_out"]]
    assert sum(p == b for p, b in held) >= 0.98 * len(held)


def test_unseen_misspellings_share_vectors(judged):
    reader = toxicity.Reader(judged[3])
    clean = " ".join(CLEAN * 6)
    assert reader.margin(clean) < 0
    for word in ("blockheads", "blokhead", "nitwitt", "dunderheaded"):
        assert reader.margin(f"{clean} {word} {word} {word} {word}") > reader.margin(f"{clean} window window window window") + 1


def test_scores_equal_a_plain_forward_pass(judged):
    rows, _, _, net = judged
    s = net.s

    def vector(word):
        ids, _ = toxicity.features([word], s)
        weights = [s.whole] + [(1 - s.whole) / (len(ids) - 1)] * (len(ids) - 1)
        return sum(w * net.table[i].astype(float) for w, i in zip(weights, ids))

    reader = toxicity.Reader(net)
    for _, text, _ in [*rows[:12], (0, "Ça é!? x " + "y" * 300 + " 漢字 🙂", 0)]:
        words = re.findall(r"\w+", text.lower())
        starts = [0] if len(words) <= s.passage else [*range(0, len(words) - s.passage, s.passage // 2), len(words) - s.passage]
        margins = []
        for a in starts:
            part = words[a : a + s.passage]
            z = sum(vector(w) for w in part) / len(part) @ net.dense + net.last
            margins.append(z[1] - z[0])
        assert reader.margin(text) == pytest.approx(max(margins), abs=1e-4)


def test_toxicity_of_odd_rows(spark, judged):
    odd = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string").repartition(3)
    odd = odd.select("*", *(F.lit(i).alias(c) for i, c in enumerate([*CLASH, "toxic", "predicted"]) if c != "score"))
    rows, docs, labels, net = judged
    got = toxicity.scored(odd, net).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    assert [r["score"] for r in got if r["doc_id"] in (1, 2, 3)] == [pytest.approx(1 / (1 + np.exp(-net.bias)))] * 3
    assert toxicity.scored(odd.limit(0), net).count() == 0
    for marks, score in ((labels.limit(0), 0.0), (labels.filter("toxic = 0"), 0.0), (labels.filter("toxic = 1"), 1.0), (labels.withColumn("toxic", F.lit(None).cast("int")), 0.0)):
        assert {r["score"] for r in toxicity.toxicity(docs, marks).limit(5).collect()} == {score}
    twice = labels.unionByName(labels)
    assert np.array_equal(toxicity.fit(docs, twice).table, net.table)


# --- prefix trie ----------------------------------------------------------------------------------

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def trie_by_force(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = checksum(str(c)) % 4
        built[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])  # SQL's remainder has the sign of c
    nodes = collections.defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    children = collections.Counter(n[:-1] for n in nodes if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, members in nodes.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += (len(members) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(((min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
                    digest(c for c in m if len(built[c]) == len(n))) for n, m in nodes.items()), key=repr)


def trie_rows(df):
    return sorted((tuple(r) for r in prefixtrie.prefix_trie(prefixtrie.rebuilt(prefixtrie.numbered(df))).select(*COLUMNS).collect()), key=repr)


def talks(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate("pos hi lo words n_turns block key t1 depth a b u part h base own taken".split())))


def test_trie_equals_brute_force(spark, sf):
    df = table(spark, sf, "conversations")
    assert trie_rows(df) == trie_by_force([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_trie_of_long_shared_and_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "_RUN", 2)
    monkeypatch.setattr(prefixtrie, "_IDS", 3)
    rows = [(0, t, "user", f"turn {t} of many") for t in range(45)]
    rows += [(c, t, "user", f"turn {t} of many") for c in (1, 2, 3, 21, 40) for t in range(45 - c % 3)]
    rows += [(c, t, "user", "same words here") for c in range(100, 130) for t in range(c % 4)] + [(c, None, None, None) for c in range(140, 150)]
    rows += [(None, 1, "user", "nobody"), (-5, 2, "b", "two"), (-5, None, "a", "one"), (-5, 1, None, ""), (300, 1, "a", "x" * 100_000), (301, 1, "a:", "b"), (302, 1, "a", ":b")]
    rows += [(400, 7, "a", "again")] * 12
    assert trie_rows(talks(spark, rows).repartition(5)) == trie_by_force(rows)


def test_trie_of_nothing_and_its_texts(spark, sf):
    df = talks(spark, [(1, 1, "a", "b")])
    assert trie_rows(df.limit(0)) == []
    trie = prefixtrie.prefix_trie(prefixtrie.rebuilt(prefixtrie.numbered(talks(spark, [(20, 0, "user", "hello there"), (20, 1, None, "bye")]))))
    assert [(r["depth"], r["role"], r["text"]) for r in prefixtrie.with_turns(trie, table(spark, sf, "conversations").limit(0)
            .unionByName(spark.createDataFrame([(20, 0, "user", "hello there"), (20, 1, None, "bye")], "conv_id bigint, turn bigint, role string, text string"))).orderBy("depth").collect()] == [
        (0, None, None), (1, "user", "hello there"), (2, "", "bye")]
