"""Full build and batch or stream scoring with all models."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from windrow.functions import probs as P
from windrow.functions import text as T
from windrow.models.kmeans import KMeansFit, fit_kmeans
from windrow.models.mlp import MlpModel, fit_mlp
from windrow.models.numeric import Rows
from windrow.models.pca import PcaModel, fit_pca_wide
from windrow.models.svm import SvmModel, fit_svm
from windrow.operators import balance, integrity
from windrow.operators.lemmas import lemma_lookup, lemmatize, relevant_lemmas
from windrow.operators.lexicon import Lexicon, lexicon_lookup
from windrow.operators.sampling import fast_subset
from windrow.operators.tfidf import TfidfModel, fit_tfidf
from windrow.plans.report import by_mode
from windrow.scale import share, ship
from windrow.sources.documents import ingest
from windrow.taxonomy import DEFAULT_T2_LOSS_WEIGHTS, Labels, labels_of

RAW_SCHEMA = ("svm_slow int, svm_fast int, km_slow int, km_fast int, km_slow_d2 double, km_fast_d2 double, "
              "z1 array<double>, z2 array<double>, pca_x double, pca_y double")


@dataclass
class Params:
    """Settings of a build; the defaults are the fixed values of the single operators."""

    quota: int = balance.QUOTA
    chunk_words: int = T.CHUNK_WORDS
    stop_words: list[str] = field(default_factory=list)
    term_stop_words: list[str] = field(default_factory=list)
    max_features: int = 10_000
    min_df: int = 5
    max_df: float = 0.60
    svm_features: int = 512
    svm_max_iter: int = 100
    svm_tol: float = 1e-6
    epochs: int = 50
    batch: int = 64
    mlp_partitions: int = 4
    mlp_rate: float | None = None
    clusters: int = 7
    restarts: int = 10
    kmeans_max_iter: int = 300
    kmeans_tol: float = 1e-4
    pca_max_passes: int = 100
    pca_tol: float = 1e-4
    seed: int = 42
    t2_loss_weights: dict[int, float] = field(default_factory=lambda: dict(DEFAULT_T2_LOSS_WEIGHTS))


# Names of the models of an engine.
MODELS = ("mlp", "svm_slow", "svm_fast", "kmeans_slow", "kmeans_fast", "pca")


@dataclass
class Engine:
    """Fitted models. ``lemma_map`` holds the lemmas that can matter to the vocabulary.

    ``checks`` holds the ``(name, status, detail)`` rows of the integrity gate of a build, ``audit``
    the rows of its audit table. A model that was not asked for is None and scores null.
    """

    labels: Labels
    params: Params
    tfidf: TfidfModel
    svm_slow: SvmModel | None = None
    svm_fast: SvmModel | None = None
    mlp: MlpModel | None = None
    kmeans_slow: KMeansFit | None = None
    kmeans_fast: KMeansFit | None = None
    pca: PcaModel | None = None
    lemma_map: dict[str, str] = field(default_factory=dict)
    checks: list[tuple[str, str, str]] = field(default_factory=list)
    audit: list[tuple] = field(default_factory=list)
    _lookup: object = field(default=None, repr=False, compare=False)

    def vectors(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """Add the sparse row of every text. Narrow, so also for streams."""
        cleaned = clean(df, text_col, self.params.stop_words)
        if self.lemma_map:
            cleaned = cleaned.withColumn("tokens", self._swap(df.sparkSession)("tokens"))
        return self.tfidf.transform(cleaned).drop("tokens")

    def _swap(self, spark):
        if self._lookup is None:
            self._lookup = lemma_lookup(spark, self.lemma_map)
        return self._lookup

    def raw_scores(self, vectors: DataFrame, every: bool = True, mode_col: str | None = None) -> DataFrame:
        """All model outputs of rows with ``idx`` and ``val``: one pass, one row out per row in.

        With ``every`` off, a row meets only the SVM and the K-Means its mode names (slow without a
        mode column); the other two are null.
        """
        spark = vectors.sparkSession
        ship(spark)
        shared = spark.sparkContext.broadcast(
            (self.svm_slow, self.svm_fast, self.mlp, self.kmeans_slow, self.kmeans_fast, self.pca)
        )
        keep = [c for c in vectors.columns if c not in ("idx", "val")]

        def run(batches):
            svm_slow, svm_fast, mlp, km_slow, km_fast, pca = shared.value
            for b in batches:
                rows = Rows.from_arrow(b)
                slow = fast = np.ones(len(rows), dtype=bool)
                if not every:
                    fast = np.zeros(len(rows), dtype=bool)
                    if mode_col is not None:
                        fast = pc.fill_null(pc.equal(b.column(b.schema.get_field_index(mode_col)), "fast"), False).to_numpy(zero_copy_only=False)
                    slow = ~fast
                (v_slow, c_slow, d_slow), (v_fast, c_fast, d_fast) = _chosen(svm_slow, km_slow, rows, slow), _chosen(svm_fast, km_fast, rows, fast)
                logits = [_lists(z) for z in mlp.logits(rows)] if mlp else [pa.nulls(len(rows), pa.list_(pa.float64()))] * 2
                xy = [pa.array(x) for x in pca.project(rows).T] if pca else [pa.nulls(len(rows), pa.float64())] * 2
                cols = [v_slow, v_fast, c_slow, c_fast, d_slow, d_fast, *logits, *xy]
                kept = [b.column(b.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, *cols], names=[*keep, *_RAW_NAMES])

        target = StructType([vectors.schema[c] for c in keep] + StructType.fromDDL(RAW_SCHEMA).fields)
        return vectors.mapInArrow(run, target)

    def predictions(self, raw: DataFrame, id_col: str, mode_col: str | None = None) -> DataFrame:
        """Prediction rows from :meth:`raw_scores`: softmax, branch mask and labels in SQL."""
        lab = self.labels
        p = raw.withColumn("p1", P.softmax("z1")).withColumn("p2", P.softmax("z2"))
        p = p.withColumn("pm", P.hierarchical_mask("p1", "p2", lab.parent))

        def pick(fast: str, slow: str):
            return F.col(slow) if mode_col is None else by_mode(mode_col, F.col(fast), F.col(slow))

        def tier(names, probs: str, out: str):
            return F.struct(P.label_at(names, P.argmax(probs)).alias("label"),
                            P.prob_map(names, probs).alias("probabilities")).alias(out)

        return p.select(
            F.col(id_col).alias("id"),
            P.label_at(lab.t1, pick("svm_fast", "svm_slow")).alias("svm_label"),
            tier(lab.t1, "p1", "tier1"), tier(lab.t2, "pm", "tier2"),
            pick("km_fast", "km_slow").alias("cluster"), "pca_x", "pca_y",
        )

    def score(self, df: DataFrame, id_col: str, text_col: str = "text", mode_col: str | None = None) -> DataFrame:
        """Clean, vectorise and classify every passage. ``mode_col`` = "fast" picks the fast models."""
        keep = [id_col] + ([mode_col] if mode_col else [])
        vectors = self.vectors(df.select(*keep, text_col), text_col).drop(text_col)
        return self.predictions(self.raw_scores(vectors, False, mode_col), id_col, mode_col)

    def cluster_meta(self, spark) -> DataFrame:
        """``clusters(cluster, x, y, t1, t2)``: centroids through the other models."""
        dense = self.kmeans_slow.centers
        rows = [(i, [int(j) for j in np.flatnonzero(c)], [float(x) for x in c[np.flatnonzero(c)]])
                for i, c in enumerate(dense)]
        table = spark.createDataFrame(rows, "cluster int, idx array<int>, val array<double>")
        got = self.predictions(self.raw_scores(table.withColumnRenamed("cluster", "k"), False), "k")
        return got.select(
            F.col("id").alias("cluster"), F.col("pca_x").alias("x"), F.col("pca_y").alias("y"),
            F.col("svm_label").alias("t1"), F.col("tier2.label").alias("t2"),
        )


_RAW_NAMES = [part.split()[0] for part in RAW_SCHEMA.split(", ")]


def _chosen(svm: SvmModel | None, km: KMeansFit | None, rows: Rows, wanted: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Vote, cluster and squared distance of the wanted rows, null elsewhere."""
    at = np.flatnonzero(wanted)
    vote, cluster, far = np.zeros(len(wanted), np.int32), np.zeros(len(wanted), np.int32), np.zeros(len(wanted))
    if len(at):
        some = rows if len(at) == len(wanted) else rows.take(at)
        if svm:
            vote[at] = svm.vote(svm.margins(some))
        if km:
            d = km.distances(some)
            cluster[at], far[at] = d.argmin(axis=1), d.min(axis=1)
    return tuple(pa.array(x, mask=~wanted if model else np.ones(len(wanted), bool)) for x, model in ((vote, svm), (cluster, km), (far, km)))


def _lists(x: np.ndarray) -> pa.ListArray:
    n, k = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.array(x.ravel()))


def clean(df: DataFrame, text_col: str, stop: list[str], lemmas: DataFrame | Lexicon | None = None,
          id_col: str = "chunk_id") -> DataFrame:
    """Add ``tokens``: lower-case letter runs without listed or short words, lemmatised by a lexicon
    (narrow) or by a table of lemmas."""
    tokens = df.withColumn("tokens", T.drop_words(T.alpha_tokens(text_col), stop, T.MIN_TOKEN_CHARS))
    if lemmas is None:
        return tokens
    if isinstance(lemmas, Lexicon):
        return tokens.withColumn("tokens", lexicon_lookup(df.sparkSession, lemmas)("tokens"))
    return tokens.drop("tokens").join(lemmatize(tokens, id_col, "tokens", lemmas), id_col)


def training_vectors(corpus: DataFrame, params: Params, lemmas: DataFrame | None = None) -> tuple[TfidfModel, DataFrame]:
    """Fitted vectoriser and the shared sparse rows of a labelled corpus."""
    kept = ["chunk_id", "t1_idx", "t2_idx"]
    tokens = share(clean(corpus.select(*kept, "text"), "text", params.stop_words, lemmas, "chunk_id").drop("text"))
    tfidf = fit_tfidf(tokens, stop=params.term_stop_words, max_features=params.max_features,
                      min_df=params.min_df, max_df=params.max_df)
    vectors = share(tfidf.transform(tokens).drop("tokens"))
    vectors.count()
    tokens.unpersist()
    return tfidf, vectors


def fit_engine(corpus: DataFrame, taxonomy: DataFrame, params: Params, lemmas: DataFrame | None = None,
               models: tuple[str, ...] = MODELS) -> tuple[Engine, DataFrame]:
    """Fit ``models`` on ``corpus(chunk_id, t1_idx, t2_idx, text)``; also returns its vectors."""
    labels = labels_of(taxonomy)
    tfidf, x = training_vectors(corpus, params, lemmas)
    engine = Engine(labels, params, tfidf)
    fit_models(engine, x, models)
    words = [w for term in tfidf.terms for w in term.split(" ")] + list(params.term_stop_words)
    engine.lemma_map = relevant_lemmas(lemmas, words) if lemmas is not None else {}
    return engine, x


def fit_models(engine: Engine, x: DataFrame, models: tuple[str, ...] = MODELS) -> None:
    """Fit those of ``models`` that the engine does not have yet, on its training vectors.

    No model depends on another one, so the order in which they are asked for does not matter.
    """
    params, labels, width = engine.params, engine.labels, engine.tfidf.width
    svm = dict(width=width, features=params.svm_features, seed=params.seed, max_iter=params.svm_max_iter, tol=params.svm_tol)
    km = dict(width=width, k=params.clusters, restarts=params.restarts, seed=params.seed, max_iter=params.kmeans_max_iter, tol=params.kmeans_tol)
    # The two fast models draw different subsets, as two independent draws would.
    fits = {
        "mlp": lambda: fit_mlp(x, width, len(labels.t1), len(labels.t2), "chunk_id", epochs=params.epochs,
                               batch=params.batch, partitions=params.mlp_partitions, rate=params.mlp_rate, class_weights=params.t2_loss_weights, seed=params.seed),
        "svm_slow": lambda: fit_svm(x, "t1_idx", **svm),
        "svm_fast": lambda: fit_svm(fast_subset(x, "chunk_id", params.seed), "t1_idx", **svm),
        "kmeans_slow": lambda: fit_kmeans(x, **km),
        "kmeans_fast": lambda: fit_kmeans(fast_subset(x, "chunk_id", params.seed + 1), **km),
        "pca": lambda: fit_pca_wide(x, width, seed=params.seed, max_passes=params.pca_max_passes, tol=params.pca_tol),
    }
    wanted = [name for name in fits if name in models and getattr(engine, name) is None]
    if not wanted:
        return
    # The fits are independent chains of short jobs on the same shared rows: run side by side,
    # one chain's driver step overlaps another's tasks.
    threaded = inheritable_thread_target(x.sparkSession)
    with ThreadPoolExecutor(len(wanted)) as pool:
        running = {name: pool.submit(threaded(fits[name])) for name in wanted}
        for name, f in running.items():
            setattr(engine, name, f.result())


def build(books: DataFrame, catalog: DataFrame, taxonomy: DataFrame, params: Params | None = None,
          lemmas: DataFrame | None = None, strict: bool = False, models: tuple[str, ...] = MODELS) -> tuple[Engine, DataFrame]:
    """Ingest, balance, check, vectorise and fit ``models``. Returns the engine and the training vectors.

    ``books`` holds one copy per source, as text or bytes; boilerplate is stripped here.
    The cheap integrity gate runs before anything is vectorised; a warning stops the build only
    if ``strict``.
    """
    engine, vectors, counts = build_from(ingest(books), catalog, taxonomy, params or Params(), lemmas, strict, models)
    counts.unpersist()
    return engine, vectors


def build_from(books: DataFrame, catalog: DataFrame, taxonomy: DataFrame, params: Params,
               lemmas: DataFrame | None = None, strict: bool = False, models: tuple[str, ...] = MODELS) -> tuple[Engine, DataFrame, DataFrame]:
    """:func:`build` of ingested books; also returns the windows per source that were counted."""
    counts = balance.counts_until_full(books, catalog, params.quota, params.chunk_words)
    corpus = share(balance.balanced(books, counts, taxonomy, params.quota, params.chunk_words))
    checks = [tuple(r) for r in integrity.integrity_report(corpus).collect()]
    if strict and any(status == "WARNING" for _, status, _ in checks):
        raise ValueError(f"integrity check failed: {checks}")
    engine, vectors = fit_engine(corpus, taxonomy, params, lemmas, models)
    engine.checks = checks
    engine.audit = [tuple(r) for r in balance.audit_table(balance.pool_sizes(counts, taxonomy, params.quota), params.quota).collect()]
    corpus.unpersist()
    return engine, vectors, counts
