"""Every operator against a brute-force version, an exact round trip or held-out accuracy."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from windrow.llm import ann, langid, licenses, linededup, minhash, mixing, packing, pii, quality, tokencount
from windrow.llm.shared import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]


ODD = [
    (1, None, "en", "a"), (2, "", "en", "b"), (3, " \t\n\r\x0b\f ", None, None), (None, "no id here at all", "en", "a"),
    (4, "one two three", "en", "a"), (5, "one two three", "fr", "b"), (5, "one two three", "fr", "b"),
    (6, "\x00\x1c\x85\xa0 odd   spaces  ", "en", "b"), (7, "wide " * 60_000, "en", "a"), (8, "x" * 20_000, "en", "a"),
    (9, "1.2.3.4 " * 3000 + "@" * 5000 + "9" * 9000, None, "b"), (10, "é́ ẞ İ K 'S don't <|endoftext|> <|STARTOFTEXT|>,", "de", None),
    (11, "ONE TWO three", "en", "c"),
]
CLASH = ("size key label node rep n d1 d2 bands _size _pattern _d1 _d2 _cuts _lines _others pos rank text_id component "
         "kept score held_out _taken _h _range").split()


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string").repartition(3)
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH)))


def coverage_by_force(text, limits):
    """ngram_cover, line_cover and kept by sets of n-grams and lines, in characters."""
    own = words(text)
    total, worst, within = sum(map(len, own)), 0.0, True
    for k, most in limits.ngrams.items():
        seen, marked = set(), set()
        for i in range(len(own) - k + 1):
            gram = tuple(own[i : i + k])
            if gram in seen:
                marked |= set(range(i, i + k))
            seen.add(gram)
        share = sum(len(own[i]) for i in marked) / total if total else 0.0
        worst, within = max(worst, share), within and share <= most
    seen, later = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            later += sum(map(len, words(line))) if line in seen else 0
            seen.add(line)
    counts = collections.Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    marked = {i + j for i in range(len(own) - 2) if counts[tuple(own[i : i + 3])] > 1 for j in range(3)}
    failed = len(own) < 50 or 100 * len(marked) > 50 * len(own)
    lines = later / total if total else 0.0
    return worst, lines, not failed and within and lines <= limits.lines


def test_coverage_equals_brute_force(spark, docs, rows):
    limits = quality.Limits()
    once = " ".join(f"word{i}" for i in range(200))
    twice = " ".join("слово" + "абвгдежзик"[i % 10] + "лмнопрсту"[i // 10 % 9] for i in range(20))
    mixed = [(900_001, f"{once} {twice} {twice}", "x", "y"), (900_002, f"{once}\n{twice}\n{once[:300]}\n{twice}", "x", "y"), (900_003, "é è\né è\n" * 40, "x", "y")]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame([m[:2] for m in mixed], "doc_id bigint, text string"))
    got = {(r["doc_id"]): r for r in quality.repetition(frame, limits).collect()}
    for d, text, *_ in rows + mixed:
        worst, lines, kept = coverage_by_force(text, limits)
        assert got[d]["ngram_cover"] == pytest.approx(worst) and got[d]["line_cover"] == pytest.approx(lines)
        assert got[d]["kept"] == kept, d
    assert got[900_001]["kept"]  # under a tenth of its characters, over a tenth of its bytes


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.limit(0)


# --- personal data -------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = kind == "email"
            if kind == "ip":
                good = all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
            if kind == "card":
                doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits[:40]))]
                good = 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
            if kind == "phone":
                good = 9 <= len(digits) <= 15
            if good:
                out.append((m.start(), k, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


TRICKY = [
    "a@b@c.d @x.y q.w%e+r-t@h-1.z.2. a@b.c@d.e 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 9.9.9",
    "4111 1111 1111 1111-4111-1111-1111-1111 4111111111111111 41  11 1-2-3 +1 (234) 567-8901, +12 +1+23456789 0123456789",
    "@ a@ @b a@b. a@b.c. é@b.c x" + "1" * 30 + "@d.ee +(12) +1().-.-()5 +123456789012345 +1234567890123456",
]


def test_plain_identifiers_equal_the_patterns():
    rng = np.random.default_rng(1)
    made = ["".join(rng.choice(list("a1.2@+- (4)%é\n"), 200)) for _ in range(300)]
    for text in TRICKY + made:
        assert pii.plain(text) == plain_spans(text), text


def test_disguises_are_found_with_source_offsets():
    cases = {
        "write to jane [at] mail (dot) example [dot] com now": ("email", "jane [at] mail (dot) example [dot] com"),
        "write to jane at mail dot example dot com now": ("email", "jane at mail dot example dot com"),
        "mail jаne@exаmple.com today": ("email", "jаne@exаmple.com"),  # Cyrillic letters
        "mail jo​e@example.com today": ("email", "jo​e@example.com"),
        "call +one two three four five six seven eight nine ok": ("phone", "+one two three four five six seven eight nine"),
        "host １９２.168.0.1 up": ("ip", "１９２.168.0.1"),
        "card four one one one 1111 1111 1111 ok 5": None,
    }
    for text, want in cases.items():
        found = pii.disguised(text, pii.plain(text))
        got = [(kind, text[a:b]) for a, b, kind in found]
        assert got == ([want] if want else got), text
    for clean in ("we met at noon, dot your eyes", "she ate one apple and two pears at home", "Ça été à l'école, è"):
        assert pii.disguised(clean, []) == []


def disguises(text):
    return [(kind, text[a:b]) for a, b, kind in pii.disguised(text, pii.plain(text))]


def test_spelled_addresses_with_short_parts():
    for ip in ("one nine two dot one six eight dot one dot one", "one two seven dot zero dot zero dot one", "one nine two.one six eight.one.one",
               "192.168.one.one", "192.168.1.one", "one dot one dot one dot one", "One Zero Dot two [dot] three (dot) 4"):
        assert disguises(f"host {ip} is up") == [("ip", ip)], ip
    for clean in ("one. two. three. four.", "three nine nine dot one dot one dot one", "point one dot two is next", "version one.two.three"):
        assert not [x for x in disguises(clean) if x[0] == "ip"], clean
    card = "four one one one.one one one one.one one one one.one one one one"
    assert disguises(f"card {card} ok") == [("card", card)]


def test_bare_at_with_any_dots_and_case():
    for mail in ("jane at example.com", "jane at mail.example dot com", "Jane At Example Dot Com", "jane.doe AT mail dot example dot org", "jane at one two three dot com"):
        assert disguises(f"mail {mail} today") == [("email", mail)], mail
    for clean in ("we met at noon.Then we left", "it is hosted at github.com and free", "look at www.example.com now", "up at 5.30 today", "see page at v1.2.x"):
        assert disguises(clean) == [], clean


def test_defanged_spaced_and_joined_forms():
    for mail in ("jane[@]mail[.]com", "jane @ mail . com", "jane -at- mail -dot- com", "jane_at_mail_dot_com", "jane-at-mail-dot-co-dot-uk", "jane(@)mail.com",
                 "jane@mail[.]com", "jane{at}mail{dot}com", "jane@mail . co . uk", "jane @ mail.com"):
        assert disguises(f"mail {mail} today") == [("email", mail)], mail
    for ip in ("192[.]168[.]1[.]1", "192 . 168 . 1 . 1", "192(.)168(.)1(.)1", "l92.168.1.1", "1O.0.0.1", "192.168.O.l"):
        assert disguises(f"host {ip} is up") == [("ip", ip)], ip
    for card in ("4lll llll llll llll", "4111-1111-1111-llll", "4ll11ll111l11l1l"):
        assert disguises(f"card {card} ok") == [("card", card)], card
    for phone in ("plus four nine one seven six one two three four five six seven", "plus 49 one seven six 1234567", "+49 l76 l234567", "+49 one seven six 1234567"):
        assert disguises(f"call {phone} now") == [("phone", phone)], phone
    for clean in ("the polka-dot-dress at home", "we stay-at-home.com", "see you @ home . it rains", "chapter 1 . 2 . 3 is long", "in 10 lo 20 Il 30", "two plus four nine one",
                  "see us @ the shop. it is fine", "a meet_at_noon note", "v1.O and 2.l", "level 0l0 of 5", "user@host . It works", "look-at-me-dot", "(.) and [.] and [@]"):
        assert disguises(clean) == [], clean


WORDS = "garden river never under stone paper little winter morning yellow".split()
SPELL = "zero one two three four five six seven eight nine".split()


def disguise(rng, value, kind):
    """``value`` in one of the forms the transducer knows."""
    def pick(*forms):
        return forms[rng.integers(len(forms))]

    if kind == "email":
        at, dot = pick(("[at]", "[dot]"), (" (at) ", " (dot) "), (" at ", " dot "), ("[@]", "[.]"), (" @ ", " . "), (" -at- ", " -dot- "), ("_at_", "_dot_"), ("@", "\u200b."), ("\uff20", "."))
        return value.replace(".", dot).replace("@", at)
    if kind == "ip":
        form = pick("[.]", " dot ", " . ", " (dot) ")
        return value.replace(".", form) if rng.random() < 0.7 else " ".join(" ".join(SPELL[int(c)] for c in p) + " dot" for p in value.split("."))[: -len(" dot")]
    if kind == "card":
        return value.replace("1", pick("l", "I", "\uff11")) if rng.random() < 0.5 else " ".join(SPELL[int(c)] for c in value)
    digits = value[1:]
    return pick("plus ", "+") + " ".join(SPELL[int(c)] for c in digits) if rng.random() < 0.5 else "+" + digits.replace("1", pick("l", "\u0661"))


def test_random_disguises_come_back_at_their_offsets():
    rng = np.random.default_rng(5)
    for _ in range(400):
        parts, want, at = [], [], 0
        for _ in range(int(rng.integers(1, 5))):
            words = " ".join(rng.choice(WORDS, int(rng.integers(2, 8)))) + ". note "
            kind = str(rng.choice(["email", "ip", "card", "phone"]))
            value = {"email": "jane@mail.com", "ip": "192.168.1.13", "card": "4111111111111111", "phone": "+49176123457"}[kind]
            shown = disguise(rng, value, kind)
            parts += [words, shown, ", "]
            want.append((at + len(words), at + len(words) + len(shown), kind))
            at += len(words) + len(shown) + 2
        text = "".join(parts)
        assert sorted(pii.disguised(text, pii.plain(text))) == want, (text, want, [text[a:b] for a, b, _ in pii.disguised(text, pii.plain(text))])


def test_pii_rows(odd, nothing):
    got = {(r["doc_id"], r["base_sha256"], r["spans"]) for r in pii.find_pii(odd).collect()}
    for d, text, *_ in ODD:
        base = pii.digest(plain_spans(text or ""))
        assert (d, hashlib.sha256(base.encode()).hexdigest(), base) in got
    assert pii.find_pii(nothing).count() == 0
    assert pii.redact(odd.filter("doc_id = 1")).first()["text"] is None
    assert pii.redact(odd.sparkSession.createDataFrame([(1, "a b@c.de f")], "doc_id int, text string")).first()["text"] == "a [email] f"


# --- near duplicates -----------------------------------------------------------------------------


def groups_by_force(data, least=85):
    sets = []
    for d, text in data:
        w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    where = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    common = collections.Counter((a, b) for own in where.values() for k, b in enumerate(own) for a in own[:k])
    parent = list(range(len(data)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= least * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    smallest = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            smallest[root(i)] = min(d, smallest.get(root(i), d))
    return sorted(((d, len(s), smallest.get(root(i), d) if s else d) for i, ((d, _), s) in enumerate(zip(data, sets))), key=repr)


def found_groups(frame, **settings):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(frame, **settings).collect()), key=repr)


def test_minhash_equals_all_pairs(docs, rows):
    assert found_groups(docs) == groups_by_force([(d, t) for d, t, *_ in rows])


def test_minhash_large_group_needs_tiles(spark):
    """Copies with random edits: many pairs just miss the limit, so buckets stay open after the stars."""
    rng = np.random.default_rng(2)
    base, data = [f"w{i}" for i in range(150)], []
    for d in range(160):
        own = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 5)):
            own[at] = f"e{rng.integers(1 << 30)}"
        data.append((d, " ".join(own)))
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    assert found_groups(frame, tile_members=32) == groups_by_force(data)


def test_representatives_link_from_four_fifths(spark):
    rng = np.random.default_rng(8)
    data = []
    for d in range(120):
        own = [f"g{d // 6}w{i}" for i in range(120)]
        for at in rng.integers(0, 120, rng.integers(0, 5)):
            own[at] = f"e{rng.integers(1 << 30)}"
        data.append((d, " ".join(own)))
    got = minhash.representatives(spark.createDataFrame(data, "doc_id bigint, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(d for d, _, component in groups_by_force(data, 80) if d == component)


def test_minhash_odd_rows(odd, nothing):
    assert found_groups(odd) == groups_by_force([(d, t) for d, t, *_ in ODD])
    assert minhash.near_duplicates(nothing).count() == 0
    left = minhash.representatives(odd)
    assert left.columns == odd.columns and left.count() == 10  # 5, 5 and 11 repeat 4
    assert minhash.representatives(nothing).count() == 0


def test_tile_forest_connects_all_links():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.int64) for _ in range(40)]
    edges = minhash.forest(np.arange(40), np.arange(40), np.zeros(40), sets, 40, wide=16)
    parent = list(range(40))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        assert root(a) != root(b)
        parent[root(a)] = root(b)
    for a in range(40):
        for b in range(a):
            n = len(np.intersect1d(sets[a], sets[b]))
            if 100 * n >= 40 * (len(sets[a]) + len(sets[b]) - n):
                assert root(a) == root(b)


# --- repetition ----------------------------------------------------------------------------------


def test_repetition_base(docs, rows, odd, nothing):
    for frame, data in ((docs, [(d, t) for d, t, *_ in rows]), (odd, [(d, t) for d, t, *_ in ODD])):
        want = []
        for d, text in data:
            w, text = words(text), text or ""
            seen = collections.defaultdict(list)
            for i in range(len(w) - 2):
                seen[tuple(w[i : i + 3])].append(i)
            inside = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
            lines = [x for x in text.split("\n") if words(x)]
            failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
            want.append((d, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside), failed))
        got = [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality.repetition(frame).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert quality.repetition(nothing).count() == 0


def test_repetition_verdict(spark):
    rng = np.random.default_rng(0)
    fresh = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 1 << 30, n))
    again = fresh(30)
    data = [(1, fresh(300)), (2, fresh(60) + " " + " ".join([again] * 3)), (3, "\n".join([fresh(20)] * 2 + [fresh(30)])), (4, fresh(10))]
    got = {r["doc_id"]: r for r in quality.repetition(spark.createDataFrame(data, "doc_id int, text string")).collect()}
    assert got[1]["kept"] and not got[2]["kept"] and not got[4]["kept"]
    assert got[2]["ngram_cover"] == pytest.approx(0.4, abs=0.06) and got[3]["line_cover"] == pytest.approx(2 / 7, abs=0.05)


def test_repetition_rejects_what_the_base_rule_lets_through():
    fresh = lambda n, at: [f"w{at + i:06d}" for i in range(n)]
    passage, limits = fresh(40, 0), quality.Limits()
    twice = quality.measures(" ".join(passage + fresh(120, 100) + passage).encode(), limits)
    assert twice[5] == pytest.approx(0.2) and not twice[7] and not twice[8]
    lines = [" ".join(fresh(4, 10 * i)) for i in range(40)]  # too short for the n-grams within a line
    mixed = [x for i, line in enumerate(lines) for x in (line, *([lines[i - 20]] if i >= 28 else []))]
    of_lines = quality.measures("\n".join(mixed).encode(), limits)
    assert of_lines[6] == pytest.approx(12 / 52) and of_lines[5] <= 0.1 and not of_lines[7] and not of_lines[8]
    little = quality.measures(" ".join(passage[:10] + fresh(180, 100) + passage[:10]).encode(), limits)
    assert little[5] == pytest.approx(0.05) and little[8]


# --- language ------------------------------------------------------------------------------------


def test_language_held_out(docs, rows, odd, nothing):
    lang = {d: name for d, _, name, _ in rows}
    got = langid.languages(docs).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    net = langid.fit(docs)
    shown = {(r["doc_id"], r["lang_pred"] == "und") for r in langid.identify(odd, net).collect()}
    assert {(1, True), (2, True), (3, True), (4, False), (9, True), (8, False)} <= shown
    assert langid.fit(nothing) is None and langid.languages(nothing).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.accepted(odd).columns == odd.columns


def test_pair_tables_equal_the_training_form():
    net = langid.Network.drawn(["a", "b"], langid.Settings())
    x = np.random.default_rng(0).integers(0, 256, (5, 192)).astype(np.uint8)
    assert np.allclose(langid.Reader(net, 192).hidden(x), net.pooled(x)[0], atol=1e-4)


# --- packing and tokens --------------------------------------------------------------------------


def test_packing_round_trip(docs, rows, odd, nothing):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for frame, data in ((docs, [(d, t) for d, t, *_ in rows]), (odd, [(d, t) for d, t, *_ in ODD])):
        got = packing.pack(frame, public_tokenizers.path("word_bpe_49k.json"), open_bins=8, fan_in=2).collect()
        want = []
        for d, text in data:
            ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            for k, at in enumerate(range(0, len(ids), 2048)):
                part = ids[at : at + 2048]
                want.append((d, k, at, len(part), zlib.crc32(part.tobytes())))
        assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
        bins = collections.defaultdict(list)
        for r in got:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for own in bins.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 2048
        assert len(bins) <= 1.05 * sum(r["length"] for r in got) / 2048 + 2
    assert packing.pack(nothing, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_token_counts(docs, rows, odd, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    for frame, data, cache in ((docs, [(d, t) for d, t, *_ in rows], 1000), (odd, [(d, t) for d, t, *_ in ODD], 100_000)):
        want = []
        for d, text in data:
            n = len(tok.encode(text or "", add_special_tokens=False).ids)
            want.append((d, len((text or "").encode()), n, n > 1024))
        got = tokencount.token_counts(frame, path, cache_pieces=cache).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert tokencount.token_counts(nothing, path).count() == 0


def test_pieces_never_cut_a_token():
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(3)
    for _ in range(400):
        text = "".join(rng.choice(list("ab1 ,.'é\n\t \x1c\x85s  "), 40))
        whole = len(tok.encode(text, add_special_tokens=False).ids)
        assert sum(len(tok.encode(p, add_special_tokens=False).ids) for p in tokencount._PIECE.findall(text)) == whole, repr(text)
        assert "".join(tokencount.slices(text, 5)) == text


# --- nearest vectors -----------------------------------------------------------------------------


def test_nearest_equals_brute_force(spark, sf):
    vectors = table(spark, sf, "embeddings")
    rows = vectors.collect()
    ids = np.array([r["vec_id"] for r in rows])
    v = np.array([r["embedding"] for r in rows], float)
    got = collections.defaultdict(list)
    for r in ann.nearest(vectors, F.col("vec_id") % 50 == 0, block=40).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(ids[ids % 50 == 0].tolist())
    for q, found in got.items():
        i = int(np.flatnonzero(ids == q)[0])
        score = v @ v[i] / (np.linalg.norm(v, axis=1) * np.linalg.norm(v[i]))
        best = sorted((-s, x) for s, x in zip(score, ids.tolist()) if x != q)[:5]
        assert [x for _, x, _ in sorted(found)] == [x for _, x in best]
        assert np.allclose([s for *_, s in sorted(found)], [-s for s, _ in best], atol=1e-12)


def test_nearest_odd_vectors(spark):
    data = [(0, [1.0, 0.0]), (50, [1e300, 1e300]), (3, [1.0, 1.0]), (2, [2.0, 2.0]), (1, [3.0, 3.0]), (4, [0.0, 0.0]), (5, None), (6, []),
            (7, [None, 1.0]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 1.0]), (10, [1.0, 1.0, 1.0]), (1, [3.0, 3.0])]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>").withColumn("part", F.lit(1))
    got = sorted(tuple(r) for r in ann.nearest(frame, F.col("vec_id") % 50 == 0, block=2).collect())
    assert [g[2] for g in got if g[0] == 50] == [1, 1, 2, 3, 0]
    assert [g[2] for g in got if g[0] == 0] == [1, 1, 2, 3, 50]
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# --- licences ------------------------------------------------------------------------------------


def test_licences(docs, rows, odd, nothing):
    model = licenses.fit(docs)
    got = {r["doc_id"]: r for r in licenses.licence_scan(docs, model).collect()}
    sure = re.compile(r"Licensed under|Released under the MIT License|GNU General Public License|All rights reserved")
    for d, text, *_ in rows:
        assert bool(sure.search(text)) == (got[d]["n_licence"] > 0), (d, got[d])
    text = "Éa x.\nTo all: Permission is hereby granted, free of charge, to any person obtaining a copy of this software. More words follow here."
    _, found = licenses.scan_text(text.encode(), model)
    assert [(f, text[a:b].strip()[:20]) for f, a, b, _ in found] == [("mit", "To all: Permission i")]
    assert licenses.scan_text(b"We were licensed to drive under the bridge.", model)[1] == []
    assert licenses.licence_scan(odd, model).count() == len(ODD) and licenses.licence_scan(nothing).count() == 0


@pytest.fixture(scope="module")
def licence_model(docs):
    return licenses.fit(docs)


def test_licence_notices_inside_longer_sentences(licence_model):
    cases = {
        "Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution 4.0 International license.": "cc-by",
        "All files in this folder are, unless stated otherwise, licensed under the Apache License, Version 2.0.": "apache-2.0",
        "The photographs are distributed under the terms of the Creative Commons Attribution 4.0 International License, which permits reuse.": "cc-by",
        "This project is released under the MIT license, see the LICENSE file in the root directory.": "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:": "mit",
    }
    for text, want in cases.items():
        assert [f[:3] for f in licenses.scan_text(text.encode(), licence_model)[1]] == [(want, 0, len(text))], text
    for clean in ("The MIT License was written in the 1980s.", "The state licensed two doctors under the new terms of the act.", "You may not do so.",
                  "Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-NC-SA 4.0."):
        assert not {f[0] for f in licenses.scan_text(clean.encode(), licence_model)[1]} & set(licenses.TEMPLATES), clean


def test_licence_labels(licence_model):
    cases = {
        "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: GPL-3.0-or-later": "gpl-3", "License: BSD-3-Clause": "bsd",
        "Sous licence MIT, voir le fichier LICENSE.": "mit", "// SPDX-License-Identifier: LGPL-2.1-only": "lgpl", "Licence : MIT": "mit",
        "SPDX-License-Identifier: ISC": "isc", "SPDX-License-Identifier: BSL-1.0": "boost", "# License: CC-BY-SA-4.0": "cc-by-sa",
        "SPDX-License-Identifier: Zlib": "unknown", "Licensed under CC BY-NC-SA 4.0.": "unknown",
    }
    for text, want in cases.items():
        assert [f[0] for f in licenses.scan_text(text.encode(), licence_model)[1]] == [want], text
    for clean in ("The licence MIT gave to the firm ended.", "He lost his driving license in May.", "The team won the BSD 3 cup.", "My driving license mit dem Auto",
                  "A license to sell beer was granted to the shop."):
        assert licenses.scan_text(clean.encode(), licence_model)[1] == [], clean


def test_ambiguous_licence_text(licence_model):
    shared = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED'
    assert [f[0] for f in licenses.scan_text(shared.encode(), licence_model)[1]] == ["ambiguous"]
    # The family that the rest of the text shows takes it.
    for family, text in licenses.full_texts().items():
        found = {f[0] for f in licenses.scan_text(text.encode(), licence_model)[1]}
        assert family in found and found <= {family, "all-rights-reserved", "unknown"}, (family, found)
    # The calibrated probability of the class, not a phrase, says unknown.
    _, found = licenses.scan_text(b"The drug was distributed under the terms of this license.", licence_model)
    assert all(f[0] == "unknown" and f[3] < 0.95 for f in found)


def test_licence_paragraphs_and_unknown_licences(spark, licence_model):
    wrapped = "A tool for maps.\n\nThe code of this tool is licensed under the Apache\nLicense, Version 2.0. Have fun\nwith it.\n\nOther words follow."
    _, found = licenses.scan_text(wrapped.encode(), licence_model)
    assert [(f, wrapped[a:b].strip()[:8]) for f, a, b, _ in found] == [("apache-2.0", "The code")]
    clause = "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software\nand associated documentation files, to deal\nin the Software without restriction."
    assert [f[:3] for f in licenses.scan_text(f"Tea.\n\n{clause}\n\nTea.".encode(), licence_model)[1]] == [("mit", 6, 6 + len(clause))]
    full = licenses.full_texts()["mit"]
    assert {f[0] for f in licenses.scan_text(full.encode(), licence_model)[1]} == {"mit"}
    unlisted = [
        "Licensed under the Educational Community License, Version 2.0.", "Released under the zlib licence.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "This library is free; you may use it under the terms of the European Union Public Licence as approved by the Commission.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.",
    ]
    for text in unlisted:
        assert [f[0] for f in licenses.scan_text(text.encode(), licence_model)[1]] == ["unknown"], text
    for clean in ("We were licensed to drive under the bridge.", "Everyone is permitted to make tea.", "The MIT License was written in the 1980s."):
        assert licenses.scan_text(clean.encode(), licence_model)[1] == [], clean
    got = licenses.licence_scan(spark.createDataFrame([(1, unlisted[0])], "doc_id int, text string"), licence_model).first()
    assert (got["n_licence"], got["families"]) == (1, "unknown") and got["spans"].startswith("unknown:0:")


# --- line runs -----------------------------------------------------------------------------------


def cut_by_force(data, least):
    """Deleted lines of each distinct (id, text), by comparing the text of all shortest runs."""
    runs = collections.defaultdict(set)
    for key in set(data):
        if key[1] is None:
            continue
        lines = key[1].split("\n")
        n = [len(words(x)) for x in lines]
        for i in range(len(lines)):
            for step in (1, -1):
                e, total = i, n[i]
                while total < least and 0 <= e + step < len(lines):
                    e += step
                    total += n[e]
                if total >= least:
                    a, b = min(i, e), max(i, e)
                    runs[tuple(lines[a : b + 1])].add((key, a, b))
    cut = collections.defaultdict(set)
    for own in runs.values():
        order = sorted(own, key=lambda r: (r[0][0] is not None, r[0][0] or 0, r[1]))
        for key, a, b in order[1:]:
            cut[key].update(range(a, b + 1))
    return cut


def check_lines(frame, data, least):
    cut = cut_by_force(data, least)
    got = linededup.report(frame, least).collect()
    want = []
    for key in data:
        lines = [] if key[1] is None else key[1].split("\n")
        left = "\n".join(x for i, x in enumerate(lines) if i not in cut[key])
        want.append((key[0], len(lines), len(cut[key]), hashlib.md5(left.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_lines"], r["n_deleted"], r["kept_md5"]) for r in got), key=repr) == sorted(want, key=repr)
    return cut


def test_line_runs_equal_brute_force(docs, rows):
    assert sum(map(len, check_lines(docs, [(d, t) for d, t, *_ in rows], 50).values())) > 0


def test_line_runs_made_up(spark):
    rng = np.random.default_rng(5)
    for alphabet in (3, 12):
        data = [(d, "\n".join(["", "a", "b c", "d e f", "g h", "i", "j k l m", "n", "o p", "q", "r s t", "u"][x] for x in rng.integers(0, alphabet, rng.integers(1, 30)))) for d in range(25)]
        check_lines(spark.createDataFrame(data, "doc_id bigint, text string").repartition(4), data, 7)


def test_line_runs_odd_rows(spark, odd, nothing):
    check_lines(odd, [(d, t) for d, t, *_ in ODD], 3)
    left = linededup.deduplicated(odd, 3)
    assert left.columns == odd.columns and left.count() == len(ODD) - 2
    assert linededup.report(nothing).count() == 0 and linededup.deduplicated(nothing).count() == 0
    passage = "\n".join(" ".join(f"p{k}w{i}" for i in range(15)) for k in range(4))
    data = [(1, f"own line one\n{passage}\nown line two"), (2, f"other\n{passage}"), (3, passage), (4, "own line one\nclean text stays")]
    kept = {r["doc_id"]: r["text"] for r in linededup.deduplicated(spark.createDataFrame(data, "doc_id int, text string")).collect()}
    assert kept == {1: data[0][1], 2: "other", 4: data[3][1]}


# --- mixing --------------------------------------------------------------------------------------


def test_mix_meets_its_targets(docs, odd, nothing):
    for frame in (docs, odd):
        got = mixing.mix(frame).collect()
        source = frame.select("doc_id", "source").collect()
        assert len(got) == len(source)
        name = {r["doc_id"]: r["source"] for r in source}
        by = collections.defaultdict(lambda: [0, 0, None])
        for r in got:
            own = by[name[r["doc_id"]]]
            own[0] += r["size"]
            own[1] += r["taken"]
            own[2] = (r["source_size"], r["target"])
            assert 0 <= r["taken"] <= 3 * r["size"]
        for size, taken, (source_size, target) in by.values():
            assert size == source_size and abs(taken - target) <= 0.5
        assert sum(t[2][1] for t in by.values()) == pytest.approx(sum(t[0] for t in by.values()))
        again = mixing.mix(frame.repartition(5)).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
        made = mixing.mixed_documents(frame)
        assert made.columns == frame.columns
        kept, given, size = made.collect(), collections.Counter(), collections.Counter()
        whole = {(r["doc_id"], r["text"]) for r in frame.collect()}
        for r in kept:
            assert (r["doc_id"], r["text"]) in whole  # no text is cut
            given[r["source"]] += len(words(r["text"]))
            size[r["source"]] = max(size[r["source"]], len(words(r["text"])))
        want = collections.Counter()
        source = {(r["doc_id"], len(words(r["text"]))): r["source"] for r in frame.collect()}
        for r in got:
            want[source[r["doc_id"], r["size"]]] += r["taken"]
            size[source[r["doc_id"], r["size"]]] = max(size[source[r["doc_id"], r["size"]]], r["size"])
        assert all(abs(given[x] - want[x]) <= size[x] / 2 for x in want)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_mix_follows_the_hash_order(spark):
    """Equal ids share a place in the order; the smaller text comes first."""
    data = [(i // 3, "w " * (i % 7), "ab"[i % 5 == 0]) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(data, "doc_id bigint, text string, source string")).collect()
    for name in "ab":
        own = [r for r in got if r["source_size"] == sum(i % 7 for i in range(3000) if "ab"[i % 5 == 0] == name)]
        own.sort(key=lambda r: (hashlib.md5(f"17-{r['doc_id']}".encode()).hexdigest()[:15], r["size"]))
        full, rest = divmod(int(own[0]["target"] + 0.5), own[0]["source_size"])
        for r in own:
            assert r["taken"] == full * r["size"] + max(0, min(r["size"], rest))
            rest -= r["size"]


def test_water_filling_and_flow():
    assert mixing.shared_targets([10, 100, 100], [1, 2, 3], 210, 3) == [30.0, 72.0, 108.0]
    assert mixing.shared_targets([0, 5], [1, 2], 5, 3) == [0.0, 5.0]
    # Pattern (0, 1) must give way to source 1, because (0,) can only serve source 0.
    given = mixing.route([((0,), 10), ((0, 1), 10), ((1,), 2)], [10, 12], 3)
    assert given == [10, 10, 2]
    assert mixing.route([((0, 1), 10)], [15, 10], 3) == [25]


def test_overlapping_sources(spark):
    data = [(i, "w " * 10, ["a"] if i < 20 else ["a", "b"] if i < 30 else ["b"]) for i in range(40)] + [(99, "w w", [])]
    got = mixing.mix(spark.createDataFrame(data, "doc_id int, text string, source array<string>"))
    assert got.agg(F.sum("taken")).first()[0] == 402
    assert got.filter("doc_id = 99").first()["taken"] == 0
