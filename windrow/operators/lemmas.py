"""Noun lemmas from a lexicon, as tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.scale import ship

# Published noun suffix rules, tried in this order.
NOUN_SUFFIXES = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]


def _one_step(form):
    """Forms one suffix rule away, in rule order."""
    return F.filter(
        F.array(*[
            F.when(form.endswith(old), F.concat(F.substring(form, F.lit(1), F.length(form) - len(old)), F.lit(new)))
            for old, new in NOUN_SUFFIXES
        ]),
        lambda f: f.isNotNull() & (f != ""),
    )


def lemma_table(tokens: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``lemmas(surface, lemma)`` of the distinct ``tokens(surface)`` that change.

    A token listed in ``exceptions(surface, lemma)`` is looked up there; otherwise suffix
    rules are applied again and again until a form is a known noun of ``lexicon(word)``.
    The token itself counts as a candidate; the shortest known candidate of the first
    successful step wins, the earliest on a tie.
    """
    distinct = tokens.select("surface").distinct()
    start = F.array(F.struct(F.lit(0).alias("step"), F.col("surface").alias("form")))
    chain = F.aggregate(
        F.sequence(F.lit(1), F.length("surface")),
        start,
        lambda acc, i: F.concat(acc, F.flatten(F.transform(
            F.filter(acc, lambda x: x["step"] == i - 1),
            lambda x: F.transform(_one_step(x["form"]), lambda f: F.struct(i.alias("step"), f.alias("form"))),
        ))),
    )
    # Other tokens have no candidate but themselves and never change.
    fits = F.lit(False)
    for old, _ in NOUN_SUFFIXES:
        fits = fits | F.col("surface").endswith(old)
    by_rule = distinct.filter(fits)
    if exceptions is not None:
        by_rule = by_rule.join(exceptions.select("surface").distinct(), "surface", "left_anti")
    cands = by_rule.select("surface", F.posexplode(chain).alias("ord", "c")).select(
        "surface", F.greatest(F.col("c.step"), F.lit(1)).alias("step"), "ord", F.col("c.form").alias("form")
    )
    if exceptions is not None:
        irregular = distinct.join(exceptions, "surface").select(
            "surface", F.lit(1).alias("step"), F.lit(1).alias("ord"), F.col("lemma").alias("form")
        )
        own = irregular.select("surface").distinct().select(
            "surface", F.lit(1).alias("step"), F.lit(0).alias("ord"), F.col("surface").alias("form")
        )
        cands = cands.unionByName(irregular).unionByName(own)
    known = cands.join(lexicon.select(F.col("word").alias("form")).distinct(), "form", "left_semi")
    best = known.groupBy("surface").agg(
        F.min_by("form", F.struct("step", F.length("form"), "ord")).alias("lemma")
    )
    return best.filter(F.col("lemma") != F.col("surface"))


# Largest table of lemmas that tasks look up whole.
LOOKUP_ROWS = 300_000


def lemmatize(df: DataFrame, id_col: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """Replace tokens by lemmas. Returns ``(id, tokens)``.

    A table of at most ``LOOKUP_ROWS`` is read once and looked up in the row; a larger one is joined.
    """
    found = lemmas.select("surface", "lemma").limit(LOOKUP_ROWS + 1).toArrow()
    if found.num_rows <= LOOKUP_ROWS:
        table = dict(zip(found.column("surface").to_pylist(), found.column("lemma").to_pylist()))
        swapped = F.coalesce(lemma_lookup(df.sparkSession, table)(tokens), F.array().cast("array<string>"))
        return df.select(id_col, swapped.alias(tokens))
    return lemmatize_by_join(df, id_col, tokens, lemmas)


def lemmatize_by_join(df: DataFrame, id_col: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """The same with joins only; any table size. A word that very many rows hold is split by the adaptive skew join."""
    cells = df.select(id_col, F.posexplode_outer(tokens).alias("_p", "surface")).filter("surface IS NOT NULL")
    found = cells.join(lemmas, "surface", "left").select(
        id_col, "_p", F.coalesce("lemma", "surface").alias("_t")
    )
    lists = found.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("_p", "_t"))).alias("_l"))
    return df.select(id_col).join(lists, id_col, "left").select(
        id_col,
        F.coalesce(F.transform("_l", lambda x: x["_t"]), F.array().cast("array<string>")).alias(tokens),
    )


def relevant_lemmas(lemmas: DataFrame, words: list[str]) -> dict[str, str]:
    """The entries whose surface or lemma is one of ``words``.

    For a fitted vocabulary and stop list no other entry changes a result: any other token is
    unknown before and after. So the dictionary is bounded by the model, not by the lexicon.
    """
    table = lemmas.sparkSession.createDataFrame([(w,) for w in sorted(set(words))], "word string")
    hit = lemmas.select("surface", "lemma").join(table, F.col("word") == F.col("lemma"), "left_semi")
    own = lemmas.select("surface", "lemma").join(table, F.col("word") == F.col("surface"), "left_semi")
    return {r["surface"]: r["lemma"] for r in hit.union(own).distinct().collect()}


def lemma_lookup(spark: SparkSession, table: dict[str, str]):
    """Column function replacing the tokens of a list by ``table``; narrow, also usable on a stream.

    Works on whole Arrow columns: one index lookup over all tokens of a batch.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast((list(table), list(table.values())))

    @F.arrow_udf("array<string>")
    def swap(col: pa.Array) -> pa.Array:
        surfaces, lemmas = shared.value
        tokens = col.flatten()
        at = pc.index_in(tokens, pa.array(surfaces, tokens.type))
        new = pc.coalesce(pc.take(pa.array(lemmas, tokens.type), at), tokens)
        sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, new.cast(pa.string()), mask=col.is_null())

    return swap
