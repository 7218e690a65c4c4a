"""Probability column expressions over ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: guard added to the sum before a masked distribution is renormalised.
MASK_EPS = 1e-10


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_total(c) -> Column:
    return F.aggregate(_col(c), F.lit(0.0), lambda acc, x: acc + x)


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` bound to a lambda variable: it is worked out once, not per element."""
    return F.transform(F.array(value), use).getItem(0)


def softmax(logits) -> Column:
    """Shifted by the maximum, so large logits do not overflow. Linear in the number of labels."""
    z = _col(logits)
    e = once(F.array_max(z), lambda top: F.transform(z, lambda x: F.exp(x - top)))
    return once(e, lambda v: once(array_total(v), lambda t: F.transform(v, lambda x: x / t)))


def parent_mass(p1, parent: Sequence[int]) -> Column:
    """Branch probability of every school, in school order."""
    p = _col(p1)
    return F.array(*[p.getItem(i) for i in parent])


def hierarchical_mask(p1, p2, parent: Sequence[int], eps: float = MASK_EPS) -> Column:
    """School probabilities weighted by their branch's probability, renormalised."""
    m = F.zip_with(_col(p2), parent_mass(p1, parent), lambda a, b: a * b)
    return once(m, lambda v: once(array_total(v) + F.lit(eps), lambda t: F.transform(v, lambda x: x / t)))


def argmax(p) -> Column:
    """Zero-based position of the first maximum."""
    c = _col(p)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def label_at(labels: Sequence[str], code) -> Column:
    return F.array(*[F.lit(x) for x in labels])[_col(code)]


def prob_map(labels: Sequence[str], p) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), _col(p))


def percent_text(p) -> Column:
    """0.8341 -> '83.4%'."""
    return F.concat(F.format_string("%.1f", _col(p) * 100), F.lit("%"))


def percent_value(s) -> Column:
    """'83.4%' -> 0.834."""
    return F.rtrim(_col(s), F.lit("%")).cast("double") / 100


def vote(margins, pairs: Sequence[tuple[int, int]], n_classes: int) -> Column:
    """One-vs-one vote: a positive margin is a vote for the pair's first class.

    Most votes win; on a tie the lowest code.
    """
    m = _col(margins)
    tally = []
    for k in range(n_classes):
        got = [F.when(m.getItem(i) > 0, 1).otherwise(0) for i, (a, _) in enumerate(pairs) if a == k]
        got += [F.when(m.getItem(i) > 0, 0).otherwise(1) for i, (_, b) in enumerate(pairs) if b == k]
        total = F.lit(0)
        for g in got:
            total = total + g
        tally.append(total)
    return argmax(F.array(*tally))
