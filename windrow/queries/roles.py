"""How the given tables stand in for books, taxonomy, logits and so on.

Every role exists twice: as a DataFrame and as the same expression in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.functions import text as T
from windrow.operators import chunking, clustering
from windrow.operators.sampling import fast_subset
from windrow.operators.tfidf import with_terms
from windrow.scale import share, spread
from windrow.sources.catalog import catalog_of
from windrow.taxonomy import encode, taxonomy_table

# Two inline stop lists standing in for the published ones, which are parameters.
STOP_1 = ["and", "are", "avec", "das", "dem", "den", "der", "des", "die", "for", "from", "les",
          "los", "pour", "que", "that", "the", "this", "und", "von", "was", "with"]
STOP_2 = ["dans", "del", "ein", "las", "not", "par", "par", "qui", "sur", "una", "une", "you"]

QUOTA = 2_500
PARENT = [0, 0, 1, 1, 2, 2, 2]
SPACE_SQL = (r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
             r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


T2_SQL = "(lang || '_' || (substr(source, 4)::INT % 2))"


def t2_name():
    parity = F.substring("source", 4, 9).cast("int") % 2
    return F.concat(F.col("lang"), F.lit("_"), parity.cast("string")).alias("t2")


def books(spark, sf) -> DataFrame:
    """``books(source_id, text)``."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("source_id"), "text")
    return spread(docs, "source_id")


def class_of_source(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", t2_name())


def taxonomy(spark, sf) -> DataFrame:
    names = sorted(tuple(r) for r in class_of_source(spark, sf).select("lang", "t2").distinct().collect())
    tree: dict[str, list[str]] = {}
    for t1, t2 in names:
        tree.setdefault(t1, []).append(t2)
    return taxonomy_table(spark, list(tree.items()))


def catalog(spark, sf) -> DataFrame:
    return catalog_of(class_of_source(spark, sf), "t2", "doc_id")


def labelled(spark, sf) -> DataFrame:
    """``(doc_id, text, t2, t1, t1_idx, t2_idx)`` of whole documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text", t2_name())
    return encode(docs, taxonomy(spark, sf))


def chunks(spark, sf, offset: int = 0) -> DataFrame:
    return chunking.chunk_fixed(books(spark, sf), offset=offset)


def chunk_tokens(spark, sf) -> DataFrame:
    """``(source_id, pos, tokens)``: clean tokens of every window of every document."""
    tokens = T.drop_words(T.alpha_tokens("text"), STOP_1, T.MIN_TOKEN_CHARS)
    return chunks(spark, sf).select("source_id", "pos", tokens.alias("tokens"))


def chunk_terms(spark, sf) -> DataFrame:
    return with_terms(chunk_tokens(spark, sf), "tokens", STOP_2).drop("tokens")


def embeddings(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").alias("y_true")
    )


def centers(vectors: DataFrame) -> list[tuple[int, list[float]]]:
    """Class means, one per label: the size of a fitted model."""
    return [(r["y_true"], r["center"]) for r in
            clustering.group_means(vectors, "embedding", "y_true").orderBy("y_true").collect()]


def assigned(spark, sf) -> DataFrame:
    """``(vec_id, embedding, y_true, cluster, dist2)``: nearest class mean of every vector."""
    vecs = embeddings(spark, sf)
    return clustering.nearest_centroid(vecs, "embedding", centers(vecs))


def assigned_both(spark, sf) -> DataFrame:
    """Nearest class mean under the means of all vectors (slow) and of the fast subset."""
    vecs = embeddings(spark, sf)
    subset = share(fast_subset(vecs, "vec_id"))
    slow = clustering.nearest_centroid(vecs, "embedding", centers(vecs)).select(
        "*", F.col("cluster").alias("slow"), F.col("dist2").alias("slow_d2")).drop("cluster", "dist2")
    fast = clustering.nearest_centroid(slow, "embedding", centers(subset)).select(
        "*", F.col("cluster").alias("fast"), F.col("dist2").alias("fast_d2")).drop("cluster", "dist2")
    in_fit = subset.select("vec_id", F.lit(True).alias("in_fast"))
    return fast.join(in_fit, "vec_id", "left").withColumn("in_fast", F.coalesce("in_fast", F.lit(False)))


def logits(spark, sf) -> DataFrame:
    """``(vec_id, z1, z2)``: 3 branch and 7 school logits."""
    return embeddings(spark, sf).select(
        "vec_id", F.slice("embedding", 1, 3).alias("z1"), F.slice("embedding", 4, 7).alias("z2")
    )


# ---- the same roles in DuckDB ---------------------------------------------------------


def _in(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(words)))


WORDS_SQL = f"list_filter(regexp_split_to_array(text, '{SPACE_SQL}+'), lambda x: x <> '')"
TAXONOMY_CTE = f"""taxonomy AS (
  SELECT (dense_rank() OVER (ORDER BY t1) - 1)::INTEGER AS t1_idx, t1,
         (dense_rank() OVER (ORDER BY t2) - 1)::INTEGER AS t2_idx, t2
  FROM (SELECT DISTINCT lang AS t1, {T2_SQL} AS t2 FROM documents))"""
CATALOG_CTE = f"""catalog AS (
  SELECT {T2_SQL} AS t2, row_number() OVER (PARTITION BY {T2_SQL} ORDER BY doc_id) AS seq,
         doc_id AS source_id FROM documents)"""


def chunks_cte(offset: int = 0, name: str = "chunks") -> str:
    words = "w" if offset == 0 else f"CASE WHEN len(w) > {offset} THEN w[{offset + 1}:] ELSE w END"
    return f"""{name} AS (
  SELECT source_id, i::INTEGER AS pos, array_to_string(w[i * 100 + 1 : i * 100 + 100], ' ') AS text
  FROM (SELECT source_id, {words} AS w FROM
         (SELECT doc_id AS source_id, {WORDS_SQL} AS w FROM documents)),
       unnest(range(0, len(w) // 100)) AS u(i))"""


TOKENS_CTE = chunks_cte() + f""",
tokens AS (
  SELECT source_id, pos, list_filter(regexp_extract_all(lower(text), '[a-z]+'),
         lambda x: len(x) > 2 AND x NOT IN ({_in(STOP_1)})) AS t FROM chunks)"""
TERMS_CTE = TOKENS_CTE + f""",
kept AS (SELECT source_id, pos, list_filter(t, lambda x: x NOT IN ({_in(STOP_2)})) AS t FROM tokens),
grams AS (
  SELECT source_id, pos, n, k, array_to_string(t[k : k + n - 1], ' ') AS term
  FROM kept, unnest([1, 2, 3]) AS a(n), unnest(range(1, len(t) - n + 2)) AS b(k)),
tf AS (SELECT source_id, pos, term, count(*) AS tf FROM grams GROUP BY ALL),
stats AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY term),
size AS (SELECT count(*) AS n FROM chunks),
vocab AS (
  SELECT term, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS term_idx, df, cf,
         ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf
  FROM (SELECT stats.*, size.n FROM stats, size WHERE df >= 5 AND df <= 0.6 * n
        ORDER BY cf DESC, term LIMIT 10000))"""
WEIGHTS_CTE = TERMS_CTE + """,
raw AS (SELECT source_id, pos, term_idx, term, (1.0 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term)),
weights AS (
  SELECT source_id, pos, term_idx, term, w / sqrt(sum(w * w) OVER (PARTITION BY source_id, pos)) AS w FROM raw)"""

VECS_CTE = "vecs AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings)"


def centers_cte(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT label AS cluster, list(m ORDER BY p) AS c FROM (
    SELECT label, p, avg(v) AS m FROM (
      SELECT label, unnest(e) AS v, generate_subscripts(e, 1) AS p FROM {source}) GROUP BY label, p)
  GROUP BY label)"""


ASSIGNED_CTE = VECS_CTE + ",\n" + centers_cte("vecs", "cent") + """,
assigned AS (
  SELECT vec_id, any_value(e) AS e, any_value(label) AS y_true, arg_min(cluster, d) AS cluster, min(d) AS dist2
  FROM (SELECT v.*, c.cluster, power(list_distance(v.e, c.c), 2) AS d FROM vecs v, cent c) GROUP BY vec_id)"""
BOTH_CTE = ASSIGNED_CTE + """,
subset AS (
  SELECT vec_id, e, label FROM (
    SELECT vecs.*, row_number() OVER (ORDER BY md5(vec_id || '-42')) AS r, count(*) OVER () AS n FROM vecs)
  WHERE r <= greatest(1, floor(0.25 * n))),
""" + centers_cte("subset", "cent_fast") + """,
fast AS (
  SELECT vec_id, arg_min(cluster, d) AS fast, min(d) AS fast_d2
  FROM (SELECT v.vec_id, c.cluster, power(list_distance(v.e, c.c), 2) AS d FROM vecs v, cent_fast c) GROUP BY vec_id),
two AS (
  SELECT a.vec_id, a.y_true, a.cluster AS slow, a.dist2 AS slow_d2, f.fast, f.fast_d2,
         s.vec_id IS NOT NULL AS in_fast
  FROM assigned a JOIN fast f USING (vec_id) LEFT JOIN subset s USING (vec_id))"""

PROBS_CTE = """logits AS (
  SELECT vec_id, embedding[1:3]::DOUBLE[] AS z1, embedding[4:10]::DOUBLE[] AS z2 FROM embeddings),
exps AS (
  SELECT vec_id, list_transform(z1, lambda x: exp(x - list_max(z1))) AS e1,
         list_transform(z2, lambda x: exp(x - list_max(z2))) AS e2 FROM logits),
probs AS (
  SELECT vec_id, list_transform(e1, lambda x: x / list_sum(e1)) AS p1,
         list_transform(e2, lambda x: x / list_sum(e2)) AS p2 FROM exps),
prod AS (
  SELECT vec_id, p1, p2, list_transform([1, 2, 3, 4, 5, 6, 7],
         lambda j: p2[j] * p1[[1, 1, 2, 2, 3, 3, 3][j]]) AS m FROM probs),
masked AS (SELECT vec_id, p1, p2, list_transform(m, lambda x: x / (list_sum(m) + 1e-10)) AS pm FROM prod)"""
