"""The queries of the operators, with production parameters, and their SQL forms."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import ann, langid, licenses, linededup, minhash, mixing, packing, pii, prefixtrie, quality, tokencount, toxicity, variants
from windrow.llm.shared import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licence_scan(table(spark, sf_dir, "documents"))


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixtrie.rebuilt(prefixtrie.numbered(table(spark, sf_dir, "conversations")))
    return prefixtrie.prefix_trie(turns).drop("turn_hi", "turn_lo")


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_minhash, op3_repetition, op4_language, op5_best_fit, op6_nearest, op7_licences, op8_line_runs, op9_token_counts, op10_mixing,
    op11_variants, op12_toxicity, op13_prefix_trie)}

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"



def _crc32(text: str) -> str:
    """CRC-32 (reflected polynomial 0xEDB88320) of a text of code points up to 255, bit by bit."""
    seven = ", 0" * 7
    units = (f"list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT{seven}] "
             f"ELSE [195::BIGINT{seven}, unicode(c)::BIGINT - 64{seven}] END)")
    steps = f"list_concat([4294967295::BIGINT], flatten({units}))"
    return f"xor(list_reduce({steps}, lambda x, v: xor(xor(x, v) >> 1, 3988292384 * (xor(x, v) & 1))), 4294967295)"


ORACLES: dict[str, str] = {
    "op2_minhash": rf"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN either l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op8_line_runs": rf"""WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, i - 1 AS pos, len(regexp_extract_all(l[i], '{_WORD}')) AS w FROM split, unnest(range(1, len(l) + 1)) AS u(i)),
cum AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM lines),
runs AS (
  SELECT x.doc_id, x.pos AS a, min(y.pos) AS b FROM cum x JOIN cum y ON x.doc_id = y.doc_id AND y.upto >= x.upto - x.w + 50 GROUP BY x.doc_id, x.pos
  UNION SELECT x.doc_id, max(y.pos), x.pos FROM cum x JOIN cum y ON x.doc_id = y.doc_id AND y.upto - y.w <= x.upto - 50 GROUP BY x.doc_id, x.pos),
named AS (SELECT doc_id, a, b, row_number() OVER (PARTITION BY l[a + 1 : b + 1] ORDER BY doc_id, a) AS nth FROM runs JOIN split USING (doc_id)),
cut AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS pos FROM named WHERE nth > 1),
islands AS (SELECT doc_id, min(pos) AS a, max(pos) AS b FROM (
  SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM cut) GROUP BY doc_id, g),
cuts AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS cuts, sum(b - a + 1)::BIGINT AS n FROM islands GROUP BY doc_id),
left_over AS (SELECT doc_id, string_agg(l[pos + 1], chr(10) ORDER BY pos) AS t FROM lines JOIN split USING (doc_id)
  WHERE (doc_id, pos) NOT IN (SELECT doc_id, pos FROM cut) GROUP BY doc_id)
SELECT doc_id, len(l) AS n_lines, coalesce(n, 0) AS n_deleted, coalesce(cuts, '') AS cuts, md5(coalesce(t, '')) AS kept_md5
FROM split LEFT JOIN cuts USING (doc_id) LEFT JOIN left_over USING (doc_id)""",
    "op10_mixing": rf"""WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
         ('0x' || substr(md5('17-' || doc_id), 1, 15))::BIGINT AS h FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS s, ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1) AS w FROM docs GROUP BY source),
ranked AS (SELECT *, sum(3 * s) OVER o - 3 * s AS capped, sum(w) OVER o - w AS gone, row_number() OVER o AS k, (SELECT sum(s) FROM src) AS t,
  (SELECT sum(w) FROM src) AS tw FROM src WINDOW o AS (ORDER BY 3.0 * s / w, source ROWS UNBOUNDED PRECEDING)),
fit AS (SELECT * FROM ranked WHERE (t - capped) * w <= 3 * s * (tw - gone) ORDER BY k LIMIT 1),
plan AS (SELECT r.source, r.s, CASE WHEN r.k < f.k THEN 3.0::DOUBLE * r.s ELSE (f.t - f.capped)::DOUBLE * r.w / (f.tw - f.gone)::DOUBLE END AS target FROM ranked r, fit f),
quota AS (SELECT *, least(3 * s, floor(target + 0.5)::BIGINT) AS q FROM plan),
part AS (SELECT *, CASE WHEN s > 0 THEN q // s ELSE 0 END AS times, CASE WHEN s > 0 THEN q % s ELSE 0 END AS rest FROM quota),
placed AS (SELECT d.doc_id, d.size, p.*, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id) - d.size AS ahead
  FROM docs d JOIN part p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, s AS source_size, target, (times * size + greatest(0, least(size, rest - ahead)))::BIGINT AS taken FROM placed""",
    "op11_variants": rf"""WITH RECURSIVE runs AS (
  SELECT doc_id, w, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents)
  WHERE length(w) >= 6 GROUP BY ALL),
hashed AS (SELECT w, c, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || w")} AS h FROM runs),
spelled AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM hashed),
vocab AS (SELECT word, sum(c)::BIGINT AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM vocab, unnest(range(1, length(word) + 1)) AS u(i)),
shorter AS (SELECT DISTINCT less.word, d FROM less JOIN vocab v ON v.word = d),
pairs AS (SELECT a.word, b.word AS near FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, d FROM shorter UNION SELECT d, word FROM shorter),
ranked AS (SELECT p.word, p.near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
  row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, p.near) AS nth FROM pairs p JOIN vocab v ON v.word = p.near),
forms AS (SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 5 * v.n THEN r.near END AS form,
  CASE WHEN r.near_n >= 5 * v.n THEN r.near_n END AS form_n FROM vocab v LEFT JOIN ranked r ON r.word = v.word AND r.nth = 1),
follow AS (SELECT word, word AS at, form AS onto FROM forms UNION ALL SELECT f.word, g.word, g.form FROM follow f JOIN forms g ON g.word = f.onto)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN follow w ON w.word = f.word AND w.onto IS NULL""",
    "op13_prefix_trie": rf"""WITH turns AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS w,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id AS c, list(k ORDER BY pos) AS k, list(w ORDER BY pos) AS w, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM turns GROUP BY conv_id),
built AS (SELECT o.c, list_concat(coalesce(b.k, [])[1 : o.h], o.k[o.h + 1 :]) AS k, list_concat(coalesce(b.w, [])[1 : o.h], o.w[o.h + 1 :]) AS w
  FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 20),
nodes AS (SELECT k[1 : d] AS p, d AS depth, min(c) AS conv_id, count(*) AS n_convs, coalesce(any_value(w[d]), 0) AS words,
  string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(k) = d) AS ends FROM built, unnest(range(0, len(k) + 1)) AS u(d) GROUP BY ALL),
children AS (SELECT p[1 : depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (p)),
above AS (SELECT p[1 : d] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved FROM counted, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, a.n_leaves, a.saved AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM counted n JOIN above a USING (p) LEFT JOIN nodes up ON n.depth > 0 AND up.p = n.p[1 : n.depth - 1]""",
}
