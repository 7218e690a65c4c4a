"""Personal data in texts: plain identifiers, and disguised ones found behind a transducer.

Plain identifiers are found by patterns on the text itself. Then a transducer rewrites only the
places where a disguise is possible (look-alike letters and digits, letters for digits, spelled
digits, ``at`` and ``dot`` in words, brackets, blanks or dashes, zero-width characters) and keeps, for every character it emits, the
source span it came from. The same patterns run on the rewritten text; what they find is mapped
back to source offsets and added if it holds at least one rewritten place and each plain span of
its kind that it meets is a smaller part of it; a card inside a phone number is not added.
Plain spans always stay.

All patterns are linear in the text: runs are entered at their start only, and matched without
giving characters back. Texts are read whole and offsets are code points.

Null or empty text: no spans. Null or repeated ``doc_id``: rows stay as they are. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from windrow.llm.shared import column, per_batch, texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each ``@`` takes all address characters before it, back to the last match."""
    free = seen = 0
    while (at := text.find("@", seen)) >= 0:
        before = text[free:at]
        size = len(before) - len(before.rstrip(_LOCAL))
        seen = at + 1
        if size and (m := _DOMAIN.match(text, at)):
            yield at - size, m.end()
            free = seen = m.end()
        else:
            free = at + 1


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p := g.lstrip("0")) <= 3 and int(p or "0") <= 255 for g in m.groups()):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def plain(text: str) -> list[Span]:
    """Spans of the undisguised identifiers, by start, then kind as listed."""
    found: list[Span] = []
    if "@" in text:
        found += ((a, b, "email") for a, b in emails(text))
    if _DIGIT.search(text):
        found += ((a, b, "ip") for a, b in ips(text))
        found += ((a, b, "card") for a, b in cards(text))
        if "+" in text:
            found += ((a, b, "phone") for a, b in phones(text))
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# Look-alike letters (fixed values): Cyrillic and Greek forms next to the Latin letter they imitate.
_ALIKE = dict(zip("авекмнорстухіјѕԁһԛԝАВЕКМНОРСТУХІЈЅ", "abekmhopctyxijsdhqwABEKMHOPCTYXIJS"))
_ALIKE |= dict(zip("αικνορυχΑΒΕΗΙΚΜΝΟΡΤΥΧΖ", "aikvopuxABEHIKMNOPTYXZ"))
_SPELLED = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_ZERO_WIDTH = "​‌‍⁠﻿­"

# A text without any of these cannot hold a disguise. Full-width and mathematical forms fold to
# ASCII by compatibility; spelled digits count in runs of three or more only.
_WORD_DIGIT = "zero|one|two|three|four|five|six|seven|eight|nine|oh"
_RUN = re.compile(
    rf"(?<![A-Za-z0-9])(?:(plus[ ,.-]+)(?:{_WORD_DIGIT}|[0-9]++)(?![A-Za-z])|(?:{_WORD_DIGIT}))"
    rf"(?:[ ,.-]+(?:{_WORD_DIGIT}|[0-9]++)(?![A-Za-z])){{2,}}", re.I)
# A bare ``at`` or a loose ``@`` needs a domain after it, whose labels dots join when dot words are resolved.
_AT = re.compile(
    r" ?[\[({<] ?(?:at|@) ?[\])}>] ?| -at- |(?<=[A-Za-z0-9])(?: at | @ ?|@ )(?=([A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++))", re.I)
_BARE_AT = re.compile(r"[A-Za-z0-9](?: at | @ ?|@ )[A-Za-z0-9-]++\.[A-Za-z0-9]", re.I)
# A whole address whose words a dash or an underscore joins.
_JOINED = re.compile(r"(?<=[A-Za-z0-9])([-_])at\1(?=([A-Za-z0-9]++(?:\1dot\1[A-Za-z0-9]++)++))", re.I)
_JOINED_DOT = re.compile(r"[-_]dot[-_]", re.I)
# Dots between blanks: in a domain behind ``@``, or between the four parts of an address of digits.
_LOOSE_DOMAIN = re.compile(r"(?<=[A-Za-z0-9])(?: ?@ ?| ?[\[({<] ?(?:at|@) ?[\])}>] ?| -at- )([A-Za-z0-9-]++(?: \. [A-Za-z0-9-]++)++)(?!\.?[A-Za-z0-9])", re.I)
_LOOSE_IP = re.compile(r"(?<![0-9.])[0-9lIOo]{1,3}(?: \. [0-9lIOo]{1,3}){3}(?! ?\.? ?[0-9])(?![A-Za-z])")
_LOOSE_DOT = re.compile(r" \. ")
# Groups of digits among which letters stand for one and nought.
_LETTERED = re.compile(r"(?<![A-Za-z0-9])[0-9lIOo]++(?![A-Za-z0-9])(?:[ .-][0-9lIOo]++(?![A-Za-z0-9]))*+")
_LETTER_HINT = re.compile(r"[0-9]\.?[lIOo]|[lIOo]\.?[0-9]|[0-9][ -][lIOo]{3}|[lIOo]{3}[ -][0-9]")
_LETTER_GROUP = re.compile(r"[0-9lIOo]+")
_AS_DIGIT = str.maketrans("lIOo", "1100")
# Ends of domains (fixed values), asked for where every dot is a literal one.
_ENDS = frozenset(
    "com org net edu gov mil int info biz name pro aero coop museum mobi jobs travel cat tel post xyz app dev online site shop store blog cloud tech email live news "
    "ac ad ae af ag ai al ao aq ar au aw ax az ba bb bd bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk "
    "dm dz ec ee eg er es et eu fi fj fk fm fo fr ga gd ge gf gg gh gi gl gm gn gp gq gr gt gu gw gy hk hn hr ht hu id ie il im io iq ir je jm jo jp ke kg kh ki km kn "
    "kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx mz na nc ne nf ng ni nl np nr nu nz om pa pe pf pg ph "
    "pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sk sl sm sn sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn tr tt tv tw tz ua ug uk "
    "us uy uz va vc ve vg vi vn vu ws ye yt za zm zw".split())
# Words after which a bare ``at`` and a literal domain name a place, not an address.
_NO_LOCAL = frozenset(
    "a an the is are was were be been being it us them him her me you one look looks looked looking find finds found see seen online available hosted host live lives "
    "living work works worked working worker met meet meets arrive arrives arrived stop stopped start starts started end ends ended page pages site website blog read "
    "more here there now and or not only also visit visited visiting shop shopping buy bought sold posted published documented described listed located based documentation "
    "docs download downloads downloaded register registered registering sign signed stay stayed aim aimed people team everyone".split())
_DOT = re.compile(r" ?[\[({<] ?(?:dot|\.) ?[\])}>] ?|(?<=[A-Za-z0-9])(?: dot | -dot- )(?=[A-Za-z0-9])", re.I)
_ODD = re.compile(
    f"[{_ZERO_WIDTH}{''.join(_ALIKE)}‐-―−․。！-～\U0001d400-\U0001d7ff"
    "٠-٩۰-۹①-⑳]")
_BRACKET_AT = re.compile(r"[\[({<] ?(?:at|dot|@|\.) ?[\])}>]", re.I)
_DASHED = re.compile(r"[-_](?:at|dot)[-_]", re.I)
_SPELL_HINT = re.compile(rf"\b(?:{_WORD_DIGIT})\b[ ,.-]+(?:{_WORD_DIGIT}|[0-9])|[0-9]\.(?:{_WORD_DIGIT})\b", re.I)
# Four parts of up to three digits, spelled or not, with dots between them.
_DIGITS = rf"(?:[0-9]{{1,3}}|(?:{_WORD_DIGIT})(?:[ -](?:{_WORD_DIGIT}|[0-9](?![0-9]))(?![A-Za-z])){{0,2}})(?![A-Za-z0-9])"
_SPELLED_IP = re.compile(rf"(?<![A-Za-z0-9]){_DIGITS}(?:\.{_DIGITS}){{3}}", re.I)
_ONE_DIGIT = re.compile(rf"{_WORD_DIGIT}|[0-9]+|\.", re.I)
_DOT_WORD = re.compile(r" dot ", re.I)


def fold(ch: str) -> str:
    """The ASCII form of one look-alike character; itself if there is none."""
    if ch in _ZERO_WIDTH:
        return ""
    if ch in _ALIKE:
        return _ALIKE[ch]
    if "‐" <= ch <= "―" or ch == "−":
        return "-"
    if ch in "․。":
        return "."
    digit = unicodedata.digit(ch, None)
    if digit is not None:
        return str(digit)
    plain_form = unicodedata.normalize("NFKC", ch)
    return plain_form if plain_form.isascii() else ch


class Transduced:
    """Rewritten text whose every character knows its source span.

    The text is kept as segments (start in the result, start in the source, source length,
    rewritten or not); a copied segment maps character by character, a rewritten one as a whole.
    """

    def __init__(self, text: str, segments: list[tuple[int, int, int, bool]] | None = None):
        self.text, self.segments = text, segments or [(0, 0, len(text), False)]
        self.starts = [s[0] for s in self.segments]

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Transduced:
        """Apply ordered, disjoint edits (start, end, replacement) of the current text."""
        out, segments, size, at = [], [], 0, 0
        for start, end, new in [*edits, (len(self.text), len(self.text), "")]:
            if start > at:
                for a, b, src, length, changed in self._pieces(at, start):
                    segments.append((size, src, length, changed))
                    size += b - a
                out.append(self.text[at:start])
            if new:
                src, stop = self.source(start, end)
                segments.append((size, src, stop - src, True))
                out.append(new)
                size += len(new)
            at = end
        return Transduced("".join(out), segments)

    def _pieces(self, start: int, end: int):
        k = bisect_right(self.starts, start) - 1
        while start < end:
            base, src, length, changed = self.segments[k]
            stop = min(end, self.starts[k + 1] if k + 1 < len(self.starts) else len(self.text))
            if changed:
                yield start, stop, src, length, True
            else:
                yield start, stop, src + start - base, stop - start, False
            start, k = stop, k + 1

    def source(self, start: int, end: int) -> tuple[int, int]:
        pieces = list(self._pieces(start, end))
        if not pieces:
            return 0, 0
        return pieces[0][2], pieces[-1][2] + pieces[-1][3]

    def changed(self, start: int, end: int) -> bool:
        return any(p[4] for p in self._pieces(start, end))


def transduce(text: str) -> Transduced | None:
    """The text with its possible disguises resolved; None if there is nothing to resolve."""
    odd = not text.isascii() and _ODD.search(text)
    spelled = _SPELL_HINT.search(text)
    worded = _BRACKET_AT.search(text) or _DOT_WORD.search(text) or _BARE_AT.search(text) or _DASHED.search(text)
    loose = " . " in text and ("@" in text or _LOOSE_IP.search(text) or _LOOSE_DOMAIN.search(text))
    lettered = _LETTER_HINT.search(text)
    if not (odd or spelled or worded or loose or lettered):
        return None
    now = Transduced(text)
    if odd:
        edits = []
        for m in _ODD.finditer(text):
            new = fold(m.group())
            if new != m.group():
                edits.append((m.start(), m.end(), new))
        now = now.rewrite(edits)
    # Dots come first: they separate the parts of spelled digits and the labels after a bare ``at``.
    now = now.rewrite([(m.start(), m.end(), ".") for m in _DOT.finditer(now.text)])
    now = now.rewrite(joined_words(now.text))
    now = now.rewrite(loose_dots(now.text))
    now = now.rewrite(spelled_digits(now.text))
    now = now.rewrite(lettered_digits(now.text))
    return now.rewrite([(m.start(), m.end(), "@") for m in _AT.finditer(now.text) if addressed(now, m)])


def addressed(now: Transduced, m: re.Match) -> bool:
    """A bracketed ``at``, one whose domain holds a rewritten place, or a domain-shaped one after a name."""
    if m.group(1) is None or now.changed(*m.span(1)):
        return True
    before = now.text[max(0, m.start() - 64) : m.start()]
    name = before[len(before.rstrip(_LOCAL)) :].lower()
    return m.group(1).rsplit(".", 1)[1].lower() in _ENDS and name not in _NO_LOCAL


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Edits that turn spelled digits into digits: addresses of four parts keep their dots, other runs
    are joined."""
    edits, at = [], 0
    for m in _SPELLED_IP.finditer(text):
        parts = "".join(_SPELLED.get(w.lower(), w) for w in _ONE_DIGIT.findall(m.group()))
        if parts != m.group() and all(int(p) <= 255 for p in parts.split(".")):
            edits += [*joined_runs(text, at, m.start()), (m.start(), m.end(), parts)]
            at = m.end()
    return edits + joined_runs(text, at, len(text))


def joined_runs(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """Runs of spelled digits as one number; a spelled plus belongs to 9 to 15 digits only."""
    edits = []
    for run in _RUN.finditer(text, start, end):
        at = run.end(1) if run.group(1) else run.start()
        digits = "".join(_SPELLED.get(w.lower(), w) for w in re.findall(rf"{_WORD_DIGIT}|[0-9]+", text[at : run.end()], re.I))
        if run.group(1) and 9 <= len(digits) <= 15:
            edits.append((run.start(), run.end(), "+" + digits))
        else:
            edits.append((at, run.end(), digits))
    return edits


def joined_words(text: str) -> list[tuple[int, int, str]]:
    """Edits of addresses written in one piece, as ``name_at_mail_dot_com``."""
    edits: list[tuple[int, int, str]] = []
    for m in _JOINED.finditer(text):
        if edits and m.start() < edits[-1][1]:
            continue
        edits.append((m.start(), m.end(), "@"))
        edits += ((d.start(), d.end(), ".") for d in _JOINED_DOT.finditer(text, m.end(), m.end(2)))
    return edits


def loose_dots(text: str) -> list[tuple[int, int, str]]:
    """Edits of dots between blanks where a domain with a known end, or four parts of digits, need them."""
    if " . " not in text:
        return []
    places = [m.span() for m in _LOOSE_IP.finditer(text)]
    for m in _LOOSE_DOMAIN.finditer(text):
        # A known end in small letters: a sentence that follows would begin with a capital.
        labels, at = m.group(1).split(" . "), m.start(1)
        known = [i for i, label in enumerate(labels) if i and label in _ENDS]
        if known:
            places.append((at, at + len(" . ".join(labels[: known[-1] + 1]))))
    return [(d.start(), d.end(), ".") for a, b in sorted(places) for d in _LOOSE_DOT.finditer(text, a, b)]


def lettered_digits(text: str) -> list[tuple[int, int, str]]:
    """Edits of letters that stand for digits, where the digits make a card, an address or a phone number."""
    edits: list[tuple[int, int, str]] = []
    for m in _LETTERED.finditer(text):
        run = m.group()
        if len(run) < 7 or not _DIGIT.search(run) or run.isdigit():
            continue
        groups = list(_LETTER_GROUP.finditer(run))
        # Words of one or two letters at the ends (``I``, ``lo``) are words, but for parts of an address.
        if run.count(".") != 3:
            while groups and short_word(groups[0].group()):
                groups.pop(0)
            while groups and short_word(groups[-1].group()):
                groups.pop()
        if not groups:
            continue
        start, end = m.start() + groups[0].start(), m.start() + groups[-1].end()
        new = text[start:end].translate(_AS_DIGIT)
        digits = "".join(_DIGIT.findall(new))
        card = "." not in new and 12 <= len(digits) <= 19 and luhn(digits)
        phone = start > 0 and text[start - 1] == "+" and 9 <= len(digits) <= 15
        parts = new.split(".")
        ip = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
        if card or phone or (ip and len(_DIGIT.findall(text[start:end])) >= 2):
            edits += ((start + i, start + i + 1, d) for i, d in enumerate(new) if d != text[start + i])
    return edits


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the rewritten text shows, in source offsets."""
    now = transduce(text)
    if now is None:
        return []
    taken: dict[str, list[tuple[int, int]]] = {k: [(a, b) for a, b, kind in base if kind == k] for k in KINDS}
    found: list[Span] = []
    for a, b, kind in plain(now.text):
        start, end = now.source(a, b)
        if end - start == b - a and not now.changed(a, b):
            continue
        spans = taken[kind]
        at = max(0, bisect_right(spans, (start, start)) - 1)
        met = []
        while at < len(spans) and spans[at][0] < end:
            if spans[at][1] > start:
                met.append(spans[at])
            at += 1
        if all(start <= x and y <= end and y - x < end - start for x, y in met):
            found.append((start, end, kind))
    calls = sorted((a, b) for a, b, kind in [*base, *found] if kind == "phone")
    return [s for s in found if s[2] != "card" or not within(calls, s)]


def short_word(group: str) -> bool:
    return len(group) < 3 and not _DIGIT.search(group)


def within(spans: list[tuple[int, int]], span: Span) -> bool:
    """Whether one of the ordered spans holds ``span``."""
    at = bisect_right(spans, (span[0], float("inf"))) - 1
    return at >= 0 and spans[at][1] >= span[1]


def digest(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts and digest of the plain spans, number of
    spans added by the transducer and of all spans, all spans as ``kind:start:end`` text."""
    docs = docs.select("doc_id", "text")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            hashes, added, every, joined = [], [], [], []
            for text in texts(batch):
                base = plain(text)
                more = disguised(text, base)
                for k in KINDS:
                    counts[k].append(sum(s[2] == k for s in base))
                hashes.append(hashlib.sha256(digest(base).encode()).hexdigest())
                added.append(len(more))
                every.append(len(base) + len(more))
                joined.append(digest(ordered(base + more)))
            made = [pa.array(counts[k], pa.int64()) for k in KINDS]
            made += [pa.array(hashes, pa.string()), pa.array(added, pa.int64()), pa.array(every, pa.int64()), pa.array(joined, pa.string())]
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "n_disguised", "n_spans", "spans"]
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), *made], names=names)

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs, make, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                     "base_sha256 string, n_disguised bigint, n_spans bigint, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with every span replaced by its kind in brackets; null text stays null."""
    docs = docs.select("doc_id", "text")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text, given in zip(texts(batch), column(batch, "text").is_valid().to_pylist()):
                base = plain(text)
                spans, parts, at = ordered(base + disguised(text, base)), [], 0
                for a, b, kind in spans:
                    if a >= at:
                        parts += [text[at:a], f"[{kind}]"]
                    at = max(at, b)
                out.append("".join([*parts, text[at:]]) if given else None)
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

        return step

    return per_batch(docs, make, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string")
