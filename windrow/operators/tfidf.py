"""1-3-gram TF-IDF with document-frequency pruning.

Fitting counts terms with map-side combined ``(term, df, cf)`` rows, one n-gram length after the
other: an n-gram is as rare as its rarest part, so only n-grams whose two shorter parts are
frequent enough are built and shuffled. Which parts are is known from a bitmap of bounded size;
what it lets through by mistake has its own count and falls to the limit.
Transforming a row needs no shuffle at all: the vocabulary (at most ``max_features``
terms) is a broadcast hash map and everything happens inside the row, so the same code
serves bulk tables and streams. A join form exists for vocabularies beyond the bound.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from windrow.functions import text as T
from windrow.operators.bitmap import bits_for, key_bitmap, maybe_in_column
from windrow.scale import BROADCAST_ROWS, share

# Vocabulary size, n-gram lengths, document-frequency limits.
MAX_FEATURES = 10_000
NGRAMS = (1, 3)
MIN_DF = 5
MAX_DF = 0.60
# Groups that the n-grams one shorter than the longest are counted in, and the share of all from which a group
# is combined before the shuffle; the rows that share is taken from.
HEAD_BUCKETS, HOT_SHARE, HOT_SAMPLE = 4096, 1 / 256, 0.05


def with_terms(df: DataFrame, tokens: str = "tokens", stop=(), ngrams=NGRAMS, out: str = "terms") -> DataFrame:
    """Add all n-grams of a token list, taken after the second stop list.

    The filtered list is a column of its own, so it is computed once and not per n-gram length.
    """
    kept = T.drop_words(tokens, list(stop)) if stop else F.col(tokens)
    return df.withColumn("_kept", kept).withColumn(out, T.all_ngrams("_kept", *ngrams)).drop("_kept")


def term_stats(df: DataFrame, terms: str = "terms") -> DataFrame:
    """``(term, df, cf)``: rows holding the term and its total count.

    The terms of a row are sorted inside the row; the first of equal neighbours counts for
    ``df``. So one aggregation gives both numbers, without a shuffle per (row, term).
    """
    rows = df.select(F.sort_array(terms).alias("_s"))
    # The outer form keeps the optimiser from computing the list a second time in a size filter.
    cells = rows.select("_s", F.posexplode_outer("_s").alias("_p", "term")).filter("term IS NOT NULL")
    first = (F.col("_p") == 0) | (F.col("term") != F.get("_s", F.col("_p") - 1))
    return (
        cells.select("term", F.when(first, 1).otherwise(0).cast("bigint").alias("_f"))
        .groupBy("term")
        .agg(F.sum("_f").alias("df"), F.count(F.lit(1)).alias("cf"))
    )


def ngram_stats(df: DataFrame, tokens: str = "tokens", stop=(), ngrams=NGRAMS, share_of_all: float = HOT_SHARE) -> DataFrame:
    """:func:`term_stats` of all n-grams of a token list, with a shuffle of about one record per token.

    An n-gram of the largest length goes to the task of its head, the n-gram one shorter. The heads are counted
    there from the same records, so they need none of their own. Heads that make up more than
    ``share_of_all`` of all, and what is shorter, are few and are combined before the shuffle, as in ``term_stats``.
    Tokens hold no blank and nothing that sorts before it.
    """
    low, high = ngrams
    if high < 2:
        return term_stats(with_terms(df, tokens, stop, ngrams))
    rows = df.select((T.drop_words(tokens, list(stop)) if stop else F.col(tokens)).alias("_kept"))

    def head(x):
        return F.substring_index(x, " ", high - 1)

    def bucket(x):
        return F.pmod(F.xxhash64(x), F.lit(HEAD_BUCKETS))

    # Which heads are hot decides only where they are counted, so a part of the rows is enough to tell.
    sizes = rows.sample(HOT_SAMPLE, seed=42).select(F.explode(F.transform(T.ngrams("_kept", high - 1), bucket)).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()
    limit = share_of_all * sum(r["n"] for r in sizes)
    hot = [r["b"] for r in sizes if r["n"] > limit]

    # The longest n-gram at every place; the last head of a row has no token behind it. Equal neighbours of
    # the sorted ones count once for ``df``.
    last = F.when(F.size("_kept") >= high - 1, F.array(T.ngram_at("_kept", F.size("_kept") - (high - 2), high - 1)))
    longest = F.concat(T.ngrams("_kept", high), F.coalesce(last, F.array().cast("array<string>")))
    places = rows.select("_kept", F.sort_array(longest).alias("_s"))
    cells = places.select("_s", F.posexplode_outer("_s").alias("_p", "x")).filter("x IS NOT NULL")
    before = F.get("_s", F.col("_p") - 1)
    new_term = ~F.col("x").eqNullSafe(before)
    new_head = ~head(F.col("x")).eqNullSafe(head(before))
    cold = cells if not hot else cells.filter(~bucket(head(F.col("x"))).isin(hot))
    # One small number says whether the n-gram and whether its head are new in the row.
    placed = cold.select("x", (new_term.cast("tinyint") + new_head.cast("tinyint")).alias("f")).repartition(head(F.col("x")))
    known = placed.select(head(F.col("x")).alias("head"), "x", "f")
    as_term = F.struct("x", F.least("f", F.lit(1)).cast("bigint").alias("f"))
    as_head = F.struct(F.col("head").alias("x"), (F.col("f") == 2).cast("bigint").alias("f"))
    if low == high:
        wanted = F.when(F.col("x") != F.col("head"), F.array(as_term))
    else:
        wanted = F.when(F.col("x") != F.col("head"), F.array(as_term, as_head)).otherwise(F.array(as_head))
    parts = known.select("head", F.explode(wanted).alias("_c")).select("head", F.col("_c.x").alias("term"), "_c.f")
    found = parts.groupBy("head", "term").agg(F.sum("f").alias("df"), F.count(F.lit(1)).alias("cf")).drop("head")

    few = [T.all_ngrams("_kept", low, high - 2)] if low < high - 1 else []
    if hot:
        warm = F.filter("_s", lambda x: bucket(head(x)).isin(hot))
        few.append(F.filter(warm, lambda x: x != head(x)))
        if low < high:
            few.append(F.transform(warm, head))
    if not few:
        return found
    return found.unionByName(term_stats(places.select(F.concat(*few).alias("_few")), "_few"))


def pruned_stats(df: DataFrame, tokens: str = "tokens", stop=(), ngrams=NGRAMS, min_df: int = MIN_DF,
                 held: list[DataFrame] | None = None) -> DataFrame:
    """``(term, df, cf)`` of every n-gram that at least ``min_df`` rows hold.

    The same rows as ``term_stats`` of all n-grams, filtered by ``df``. ``df`` is read once per n-gram
    length, so it should be kept. The frequent terms of the shorter lengths are kept while the result
    is in use; ``held`` gets these frames, for the caller to release.
    """
    spark, (low, high) = df.sparkSession, ngrams
    rows = df.select((T.drop_words(tokens, list(stop)) if stop else F.col(tokens)).alias("_kept"))
    frequent, found, good = None, None, None
    for n in range(1, high + 1):
        here = rows
        if good is not None:
            # Hashes of the shorter parts, then the places where both of them are frequent.
            size = F.size("_kept") - (n - 2)
            hashes = F.transform(T.ngrams("_kept", n - 1), lambda x: F.xxhash64(x))
            here = rows.withColumn("_h", F.when(size >= 2, hashes)).withColumn("_ok", good("_h"))
            places = F.filter(F.sequence(F.lit(1), F.size("_ok") - 1), lambda i: F.get("_ok", i - 1) & F.get("_ok", i))
            terms = F.when(F.size("_ok") >= 2, F.transform(places, lambda i: T.ngram_at("_kept", i, n)))
            here = here.withColumn("_terms", terms)
        else:
            here = here.withColumn("_terms", T.ngrams("_kept", n))
        frequent = term_stats(here, "_terms").filter(F.col("df") >= min_df)
        if n < high:
            frequent = share(frequent)
            if held is not None:
                held.append(frequent)
            count = frequent.count()
        if n >= low:
            found = frequent if found is None else found.unionByName(frequent)
        if n < high:
            if not count:
                break
            bits = bits_for(count)
            good = maybe_in_column(spark, key_bitmap(frequent.select(F.xxhash64("term").alias("k")), "k", bits), bits)
    return found if found is not None else frequent.limit(0)


def vocabulary(
    stats: DataFrame, n_rows: int, max_features=MAX_FEATURES, min_df=MIN_DF, max_df=MAX_DF
) -> DataFrame:
    """``vocab(term, term_idx, df, cf, idf)``: the most frequent terms inside the df limits.

    Ties at the cut-off go to the alphabetically first term; ``term_idx`` is alphabetical.
    The window runs over the kept terms only, a model-sized table.
    """
    kept = (
        stats.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df * n_rows)))
        .orderBy(F.desc("cf"), "term")
        .limit(max_features)
    )
    return kept.select(
        "term",
        (F.row_number().over(Window.orderBy("term")) - 1).alias("term_idx"),
        "df", "cf",
        _idf(n_rows).alias("idf"),
    )


def _idf(n_rows: int):
    return F.log(F.lit(1.0 + n_rows) / (1.0 + F.col("df"))) + 1.0


@dataclass
class TfidfModel:
    """Fitted vocabulary and idf; ``stop`` and ``ngrams`` as used for fitting."""

    terms: list[str]
    idf: list[float]
    stop: tuple[str, ...] = ()
    ngrams: tuple[int, int] = NGRAMS
    n_rows: int = 0
    _model: CountVectorizerModel | None = field(default=None, repr=False, compare=False)

    @property
    def width(self) -> int:
        return len(self.terms)

    def _counter(self) -> CountVectorizerModel:
        if self._model is None:
            self._model = CountVectorizerModel.from_vocabulary(
                self.terms, inputCol="_terms", outputCol="_cv"
            )
        return self._model

    def transform(self, df: DataFrame, tokens: str = "tokens") -> DataFrame:
        """Add ``idx array<int>`` and ``val array<double>``: the sparse weighted unit row.

        (1 + ln tf) * idf, divided by the row's L2 norm. A row without a known term gets
        two empty arrays.
        """
        ready = self._counter().transform(with_terms(df, tokens, self.stop, self.ngrams, out="_terms"))
        # The struct behind a vector column holds its two arrays.
        cells = F.unwrap_udt("_cv")
        # One text literal folds into one array constant; a list of literals is slow to analyse.
        idf = F.from_json(F.lit(json.dumps(self.idf)), "array<double>")
        raw = F.zip_with(
            F.col("_c.indices"), F.col("_c.values"),
            lambda i, tf: (1.0 + F.log(tf)) * F.get(idf, i),
        )
        norm = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda a, w: a + w * w))
        # The norm is bound to a lambda variable, so it is computed once per row.
        unit = F.transform(F.array(norm), lambda n: F.transform("_raw", lambda w: w / n)).getItem(0)
        return (
            ready.withColumn("_c", cells)
            .withColumn("_raw", raw)
            .select(
                *df.columns,
                F.coalesce("_c.indices", F.array().cast("array<int>")).alias("idx"),
                F.coalesce(unit, F.array().cast("array<double>")).alias("val"),
            )
        )

    def transform_long(self, df: DataFrame, id_col: str, tokens: str = "tokens") -> DataFrame:
        """``(id, term_idx, w)``; rows without a known term are absent."""
        arrays = self.transform(df.select(id_col, tokens), tokens)
        return arrays.select(id_col, F.explode(F.arrays_zip("idx", "val")).alias("c")).select(
            id_col, F.col("c.idx").alias("term_idx"), F.col("c.val").alias("w")
        )

    def vocab_table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(t, i, float(w)) for i, (t, w) in enumerate(zip(self.terms, self.idf))],
            "term string, term_idx int, idf double",
        )


def transform_by_join(df: DataFrame, id_col: str, terms: str, vocab: DataFrame) -> DataFrame:
    """``(id, term_idx, w)`` through joins only, for vocabularies too large to broadcast.

    Rows are placed by id before the n-grams are unfolded, so counting needs no further
    shuffle, and neither does the row norm when the optimiser broadcasts the vocabulary. A bitmap of
    bounded size rules out most n-grams outside the vocabulary before they are placed; the join drops the rest. Terms
    are counted per row before they meet the vocabulary, and a term that very many rows hold
    is split by the adaptive skew join. ``vocab`` is read three times, so it should be kept.
    """
    bits = bits_for(vocab.count())
    good = maybe_in_column(df.sparkSession, key_bitmap(vocab.select(F.xxhash64("term").alias("k")), "k", bits), bits)
    hashes = F.transform(terms, lambda x: F.xxhash64(x))
    # The flags are an argument and not read in the lambda, where Spark could not evaluate their function.
    found = F.array_compact(F.zip_with(terms, "_ok", lambda x, ok: F.when(ok, x)))
    placed = df.select(id_col, terms).withColumn("_ok", good(hashes)).select(id_col, found.alias(terms)).repartition(F.col(id_col))
    cells = placed.select(id_col, F.explode_outer(terms).alias("term")).filter("term IS NOT NULL")
    counted = cells.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))
    tf = counted.join(vocab.select("term", "term_idx", "idf"), "term")
    w = (1.0 + F.log("tf")) * F.col("idf")
    norm = F.sqrt(F.sum(w * w).over(Window.partitionBy(id_col)))
    return tf.select(id_col, "term_idx", (w / norm).alias("w"))


def fit_tfidf(
    df: DataFrame,
    tokens: str = "tokens",
    stop=(),
    max_features=MAX_FEATURES,
    ngrams=NGRAMS,
    min_df=MIN_DF,
    max_df=MAX_DF,
) -> TfidfModel:
    """Learn the vocabulary; only it reaches the driver.

    ``df`` is read four times, so it should be kept: ``share`` it if its rows are bounded, else store it.
    ``max_features`` is a parameter of the model, at most BROADCAST_ROWS: every task holds the
    vocabulary. It does not depend on the number of rows.
    """
    if max_features > BROADCAST_ROWS:
        raise ValueError("vocabulary above the broadcast bound: use vocabulary() and transform_by_join()")
    n_rows = df.count()
    held: list[DataFrame] = []
    stats = pruned_stats(df, tokens, stop, ngrams, max(1, min_df), held)
    fits = stats.filter(F.col("df") <= F.lit(max_df * n_rows)).orderBy(F.desc("cf"), "term").limit(max_features)
    rows = sorted(fits.select("term", _idf(n_rows).alias("idf")).collect())
    for frame in held:
        frame.unpersist()
    if not rows:
        raise ValueError("no term is left inside the document-frequency limits")
    return TfidfModel(
        [r["term"] for r in rows], [r["idf"] for r in rows], tuple(stop), tuple(ngrams), n_rows
    )


def with_vector(df: DataFrame, width: int, idx="idx", val="val", out="features") -> DataFrame:
    """Sparse ML vector column from the two arrays, built inside the JVM from its JSON form."""
    schema = StructType([StructField("v", VectorUDT())])
    body = F.struct(F.struct(
        F.lit(0).alias("type"), F.lit(width).alias("size"),
        F.col(idx).alias("indices"), F.col(val).alias("values"),
    ).alias("v"))
    return df.withColumn(out, F.from_json(F.to_json(body), schema)["v"])


def gamma_scale(long: DataFrame, n_rows: int, width: int) -> DataFrame:
    """One row, ``gamma``: 1 / (width * variance of all matrix entries), zeros included."""
    cells = F.lit(float(n_rows) * width)
    mean = F.sum("w") / cells
    return long.agg((1.0 / (F.lit(float(width)) * (F.sum(F.col("w") * F.col("w")) / cells - mean * mean))).alias("gamma"))


def term_label_assoc(df: DataFrame, label: str, terms: str = "terms") -> DataFrame:
    """``(term, label, share, gap)``: share of a class's rows holding the term, minus the
    share over all rows."""
    cells = df.select(label, F.explode(F.array_distinct(terms)).alias("term"))
    hits = cells.groupBy("term", label).agg(F.count(F.lit(1)).alias("n"))
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    overall = hits.groupBy("term").agg(F.sum("n").alias("n_all"))
    total = per_class.agg(F.sum("rows").alias("t")).scalar()
    joined = hits.join(overall, "term").join(F.broadcast(per_class), label)
    return joined.select(
        "term", label, (F.col("n") / F.col("rows")).alias("share"),
        (F.col("n") / F.col("rows") - F.col("n_all") / total).alias("gap"),
    )
