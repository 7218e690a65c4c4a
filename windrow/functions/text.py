"""Text column expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word size of a passage, evaluation shift, marker patterns, minimal token
# and request lengths, preview length.
CHUNK_WORDS = 100
SHIFT_WORDS = 45
MIN_TOKEN_CHARS = 3
MIN_REQUEST_CHARS = 20
MIN_SOURCE_CHARS = 500
PREVIEW_CHARS = 300

# Unicode white space, listed: Java's \s is ASCII-only and its (?U) form leaves out U+001C-1F.
SPACE = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
BODY_START = r"(?iu)\*{3}" + SPACE + r"*START OF[^\n]*\n"
BODY_END = r"(?iu)\*{3}" + SPACE + r"*END OF"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c) -> Column:
    return F.regexp_replace(_col(c), rf"\A{SPACE}+|{SPACE}+\z", "")


def normalize_space(c) -> Column:
    """Every run of white space becomes one blank; none at the ends."""
    return strip_space(F.regexp_replace(_col(c), SPACE + "+", " "))


def strip_boilerplate(c) -> Column:
    """Text between the first start-marker line and the first end marker.

    The end marker is searched in the whole text, so an end before the start gives an
    empty body. Splitting (not position arithmetic) keeps characters outside the BMP right.
    """
    raw = _col(c)
    head = F.split(raw, BODY_END, 2).getItem(0)
    parts = F.split(head, BODY_START, 2)
    after = F.when(F.size(parts) > 1, parts.getItem(1)).otherwise(F.lit(""))
    return strip_space(F.when(raw.rlike(BODY_START), after).otherwise(head))


def words(c) -> Column:
    """White-space separated words (the empty edge strings of the split are dropped)."""
    return F.array_remove(F.split(_col(c), SPACE + "+"), "")


def shifted(words_col, offset: int) -> Column:
    """Drop the first ``offset`` words if there are more than that."""
    w = _col(words_col)
    if offset <= 0:
        return w
    return F.when(F.size(w) > offset, F.slice(w, F.lit(offset + 1), F.size(w))).otherwise(w)


def alpha_tokens(c) -> Column:
    """Lower-case ASCII letter runs."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit("[a-z]+"), 0)


def drop_words(tokens, stop: list[str], min_chars: int = 1) -> Column:
    """Remove listed words and words shorter than ``min_chars``; duplicates stay."""
    stop = sorted(set(stop))

    def keep(x: Column) -> Column:
        ok = F.length(x) >= min_chars
        return ok & ~x.isin(*stop) if stop else ok

    return F.filter(_col(tokens), keep)


def ngram_at(tokens, place: Column, n: int) -> Column:
    """The n-gram whose first token is the ``place``-th (from 1)."""
    return F.array_join(F.slice(_col(tokens), place, n), " ")


def ngrams(tokens, n: int) -> Column:
    """Contiguous runs of ``n`` tokens joined by a blank."""
    return all_ngrams(tokens, n, n)


def all_ngrams(tokens, low: int = 1, high: int = 3) -> Column:
    """Runs of ``low`` to ``high`` tokens, shorter ones first.

    A longer run is the run one shorter and the token behind it, so a row's runs are joined length by length
    instead of being cut out of the list one by one.
    """
    t = _col(tokens)
    none = F.array().cast("array<string>")

    def longer(runs: Column, n: int, found: list[Column]) -> Column:
        found = [*found, runs] if n >= low else found
        if n == high:
            return F.concat(*found) if len(found) > 1 else found[0]
        size = F.size(t) - n
        joined = F.zip_with(F.slice(runs, F.lit(1), F.greatest(size, F.lit(0))), F.slice(t, F.lit(n + 1), F.greatest(size, F.lit(0))),
                            lambda a, b: F.concat(a, F.lit(" "), b))
        # The runs are bound to a lambda variable, so they are built once per row.
        return F.flatten(F.transform(F.array(F.when(size > 0, joined).otherwise(none)), lambda x: longer(x, n + 1, found)))

    return longer(t, 1, [])


def preview(c, chars: int = PREVIEW_CHARS) -> Column:
    return F.concat(F.substring(_col(c), 1, chars), F.lit("..."))
