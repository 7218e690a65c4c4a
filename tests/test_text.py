import numpy as np
import re

import pytest
from pyspark.sql import functions as F

from windrow.functions import probs as P
from windrow.functions import text as T
from windrow.operators import chunking, lemmas
from windrow.sources import documents as D
from windrow.sources import requests as Q


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("n", [0, 1, 99, 100, 101, 250])
def test_windows_are_exact_and_tail_is_dropped(spark, n):
    words = [f"w{i}" for i in range(n)]
    docs = spark.createDataFrame([(1, " \n".join(words))], "source_id bigint, text string")
    rows = chunking.chunk_fixed(docs).orderBy("pos").collect()
    assert [r["text"].split() for r in rows] == [words[i : i + 100] for i in range(0, n - n % 100, 100)]
    assert chunking.chunk_counts(docs).first()["n"] == n // 100


@pytest.mark.parametrize("n", [45, 46, 144, 145, 146])
def test_shift(spark, n):
    words = [f"w{i}" for i in range(n)]
    docs = spark.createDataFrame([(1, " ".join(words))], "source_id bigint, text string")
    got = [r["text"].split() for r in chunking.chunk_fixed(docs, offset=45).collect()]
    rest = words[45:] if n > 45 else words
    assert got == ([rest[:100]] if len(rest) >= 100 else [])


def test_null_and_blank_text(spark):
    docs = spark.createDataFrame([(1, None), (2, "  ")], "source_id bigint, text string")
    assert chunking.chunk_fixed(docs).count() == 0
    assert [r["n"] for r in chunking.chunk_counts(docs).collect()] == [0]


def test_unicode_spaces(spark):
    text = "a\u0085b c d\u001ce f　g​h"
    assert one(spark, text, T.words) == text.split()
    assert one(spark, f" {text} ", T.normalize_space) == re.sub(r"\s+", " ", text)


START, END = "*** START OF THE TEXT ***\n", "*** end of the text ***"


@pytest.mark.parametrize("raw, body", [
    (f"head\n{START} body \n{END}\nfoot", "body"),
    (f"head\n{START}body", "body"),
    (f"body\n{END} foot", "body"),
    ("plain \U0001d538 ", "plain \U0001d538"),
    (f"x {END}\n{START}y", ""),
    (f"\U0001d538{START}\U0001d538b{END}", "\U0001d538b"),
    (f"{START}a{START}b{END}c{END}", f"a{START}b"),
    ("***START OF no newline", "***START OF no newline"),
])
def test_boilerplate(spark, raw, body):
    assert one(spark, raw, T.strip_boilerplate) == body


def test_tokens_and_ngrams(spark):
    tokens = one(spark, "Élan vital, the FREE will!", T.alpha_tokens)
    assert tokens == re.findall("[a-z]+", "Élan vital, the FREE will!".lower())
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(T.all_ngrams("t")).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_lemmas(spark):
    words = ["foxes", "men", "ladies", "bus", "glasses", "boyssss", "geese", "sheep", "unknowns"]
    known = ["fox", "man", "lady", "bus", "glass", "boy", "goose", "sheep"]
    table = lemmas.lemma_table(
        spark.createDataFrame([(w,) for w in words], "surface string"),
        spark.createDataFrame([(w,) for w in known], "word string"),
        spark.createDataFrame([("geese", "goose")], "surface string, lemma string"),
    )
    got = {r["surface"]: r["lemma"] for r in table.collect()}
    assert got == {"foxes": "fox", "men": "man", "ladies": "lady", "glasses": "glass", "boyssss": "boy", "geese": "goose"}
    rows = spark.createDataFrame([(1, ["men", "x", "foxes"]), (2, [])], "id int, tokens array<string>")
    joined = {r["id"]: r["tokens"] for r in lemmas.lemmatize(rows, "id", "tokens", table).collect()}
    assert joined == {1: ["man", "x", "fox"], 2: []}
    wanted = lemmas.relevant_lemmas(table, ["man", "fox", "none"])
    assert wanted == {"men": "man", "foxes": "fox"}
    rows = rows.unionByName(spark.createDataFrame([(3, None)], "id int, tokens array<string>"))
    swap = lemmas.lemma_lookup(spark, wanted)
    assert {r[0]: r[1] for r in rows.select("id", swap("tokens")).collect()} == joined | {3: None}


def test_decode(spark):
    short = "é" * 300
    rows = [(1, ("é" * 600).encode()), (2, ("é" * 600).encode("latin-1")), (3, short.encode()), (4, b"abc")]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in rows], "id int, content binary")
    got = {r["id"]: r["t"] for r in df.select("id", D.decode_fallback("content").alias("t")).collect()}
    assert got == {1: "é" * 600, 2: "é" * 600, 3: short.encode().decode("latin-1"), 4: None}


def test_requests(spark):
    bodies = ['{"text":"%s"}' % ("x" * 20), '{"text":"%s","speed":"fast"}' % ("x" * 19), '{"speed":"slow"}', "nonsense",
              '{"text":"%s","speed":"warp"}' % ("y" * 30)]
    raw = spark.createDataFrame(list(enumerate(bodies)), "id int, value string")
    ok, bad = Q.parse_requests(raw)
    assert {r["id"]: r["speed"] for r in ok.collect()} == {0: "slow", 4: "warp"}
    assert {r["id"] for r in bad.collect()} == {1, 2, 3}


def test_masked_probabilities(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.2, 0.3, 0.5]), ([0.0, 0.0], [0.2, 0.3, 0.5])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(P.hierarchical_mask("a", "b", [0, 0, 1])).collect()]
    assert got[0] == pytest.approx([0.4, 0.6, 0.0]) and got[1] == [0.0, 0.0, 0.0]
    big = spark.createDataFrame([([1000.0, 1000.0, 0.0],)], "z array<double>").select(P.softmax("z").alias("p"))
    assert big.first()["p"] == pytest.approx([0.5, 0.5, 0.0])
    assert big.select(P.argmax("p")).first()[0] == 0


def test_whole_file_reader(spark, tmp_path):
    (tmp_path / "pg12.txt").write_text("line one\nline two")
    (tmp_path / "7.txt").write_text("x")
    got = {r["source_id"]: r["text"] for r in D.read_books(spark, str(tmp_path)).collect()}
    assert got == {12: "line one\nline two", 7: "x"}
    raw = {r["source_id"]: bytes(r["content"]) for r in D.read_book_bytes(spark, str(tmp_path)).collect()}
    assert raw == {12: b"line one\nline two", 7: b"x"}


def test_word_automaton_accepts_its_words_only():
    from windrow.operators.lexicon import WordAutomaton
    rng = np.random.RandomState(1)
    words = sorted({"".join(rng.choice(list("abé漢"), rng.randint(1, 7))) for _ in range(800)})
    inside, outside = words[::2], words[1::2]
    made = WordAutomaton.of(inside)
    assert made.accepts(inside).all() and not made.accepts(outside + ["", "zz", "abx"]).any()
    assert len(made.final) < sum(map(len, inside)) / 3  # equal ends are shared
    assert WordAutomaton.of(["", "a"]).accepts(["", "a", "b"]).tolist() == [True, True, False]
    assert not WordAutomaton.of([]).accepts(["", "a"]).any()


def test_lexicon_lookup_equals_the_table(spark):
    from windrow.operators.lexicon import lexicon_lookup, read_lexicon
    words = "cat box bus leaf wolf quiz church dish man woman city sses ssess s glass class as fly ves goose ie".split()
    surfaces = [w + e for w in [*words, "x", "sse", "cities"] for e in ("", "s", "es", "ses", "sses", "ves", "ies", "men", "ches", "zes")]
    surfaces += ["geese", "men", "women", "oxen", "leaves", "wolves"]
    lexicon = spark.createDataFrame([(w,) for w in words], "word string")
    odd = spark.createDataFrame([("geese", "goose"), ("oxen", "ox"), ("cats", "cat"), ("men", "man"), ("men", "goose")], "surface string, lemma string")
    rows = spark.createDataFrame([(1, surfaces), (2, []), (3, None), (4, surfaces[::-1])], "id int, tokens array<string>")
    table = lemmas.lemma_table(spark.createDataFrame([(s,) for s in surfaces], "surface string"), lexicon, odd)
    want = {r["surface"]: r["lemma"] for r in table.collect()}
    swap = lexicon_lookup(spark, read_lexicon(lexicon, odd))
    got = {r["id"]: r["t"] for r in rows.select("id", swap("tokens").alias("t")).collect()}
    assert got == {1: [want.get(s, s) for s in surfaces], 2: [], 3: None, 4: [want.get(s, s) for s in surfaces[::-1]]}
    for form in (lemmas.lemmatize, lemmas.lemmatize_by_join):
        assert {r["id"]: r["tokens"] for r in form(rows, "id", "tokens", table).collect()} == got | {3: []}
    assert read_lexicon(lexicon, most=3) is None


def test_pruned_stats_are_the_frequent_terms(spark, monkeypatch):
    from windrow.operators import bitmap, tfidf as V
    rng = np.random.RandomState(2)
    rows = [([str(w) for w in rng.choice([*"abcdefgh", "stop", *map(str, range(60))], rng.randint(0, 25))],) for _ in range(300)] + [(None,), ([],), (["a"],), (["a", "b"],)]
    df = spark.createDataFrame(rows, "tokens array<string>")
    for ngrams in ((1, 3), (2, 2), (3, 3), (1, 1)):
        want = V.term_stats(V.with_terms(df, "tokens", ["stop"], ngrams)).filter("df >= 6")
        for most in (27, 15):
            monkeypatch.setattr(bitmap, "MOST_BITS", most)
            got = V.pruned_stats(df, "tokens", ["stop"], ngrams, 6)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), ngrams
    assert V.pruned_stats(df.limit(0), "tokens").count() == 0
    keys = rng.randint(-(1 << 62), 1 << 62, 500)
    made = bitmap.key_bitmap(spark.createDataFrame([(int(k),) for k in keys[:250]], "k bigint"), "k", 15)
    assert bitmap.maybe_in(made, keys[:250], 15).all() and bitmap.maybe_in(made, keys[250:], 15).mean() < 0.02


def test_ngrams_are_joined_from_shorter_ones(spark):
    lists = [["a", "b", "c", "d"], ["a", "b"], [], None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, t array<string>")
    got = {r["i"]: tuple(r)[1:] for r in df.select("i", T.ngrams("t", 1), T.ngrams("t", 2), T.ngrams("t", 3), T.all_ngrams("t", 2, 3)).collect()}
    assert got[0] == (lists[0], ["a b", "b c", "c d"], ["a b c", "b c d"], ["a b", "b c", "c d", "a b c", "b c d"])
    assert got[1] == (["a", "b"], ["a b"], [], ["a b"]) and got[2] == ([], [], [], []) and got[3] == (None, [], [], [])
    assert "sequence" not in df.select(T.all_ngrams("t"))._jdf.queryExecution().analyzed().toString()


def test_clean_text_keeps_its_lemmas_above_the_automatons_bound(spark, monkeypatch, tmp_path):
    from windrow.operators import lexicon
    from windrow.queries import corpus

    rows = [(1, "two cats and a cat"), (2, "many dogs, one dog"), (2, "many dogs, one dog"), (2, "cats"), (3, None), (None, "dogs"), (4, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    below = sorted((tuple(r) for r in corpus.clean_text(spark, str(tmp_path)).collect()), key=str)
    monkeypatch.setattr(corpus, "read_lexicon", lambda words: lexicon.read_lexicon(words, most=2))
    assert sorted((tuple(r) for r in corpus.clean_text(spark, str(tmp_path)).collect()), key=str) == below
    assert (1, "two cat cat") in below and below.count((2, "many dog one dog")) == 2 and len(below) == len(rows)
