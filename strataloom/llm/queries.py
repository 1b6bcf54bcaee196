"""The operators over the whole given tables, and SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    bpe, divergence, fingerprints, katz_corpus, langid, mixing, neardup, pii, quality, rules, spelling, tokenfile, toxicity,
)
from .frames import held_out, text_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_session(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_session(spark).read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


@registered
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    out = held_out(F.col("doc_id"), 5, 0)
    model = quality.fit(docs, _labels(spark, sf_dir), ~out)
    return quality.score(docs, model, threshold=0.3).select("doc_id", out.alias("held_out"), "score", "predicted")


@registered
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    out = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, _labels(spark, sf_dir), ~out)
    return toxicity.score(docs, model, threshold=0.5).select("doc_id", out.alias("held_out"), "score", "predicted")


@registered
def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    return rules.judge(docs.select("doc_id", "text"), rules.references(docs)).drop("text")


@registered
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(_documents(spark, sf_dir).select("doc_id", "text"))
    of_kind = lambda k: F.size(F.filter("seeds", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.sha2(pii.as_text(F.col("seeds")), 256).alias("base_sha256"),
        pii.as_text(F.concat("seeds", "added")).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )


@registered
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(_documents(spark, sf_dir))
    return taken.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken")
    )


SQL["op6_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, text,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (
  SELECT source, source_size,
         CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM per),
sums AS (
  SELECT *, SUM(w) OVER () - SUM(w) OVER (ORDER BY CAST(source_size AS DOUBLE) / w, source) AS open_w,
         SUM(2 * source_size) OVER (ORDER BY CAST(source_size AS DOUBLE) / w, source) AS capped,
         1.5 * SUM(source_size) OVER () AS goal FROM placed),
filled AS (
  SELECT *, COALESCE(LAG(open_w) OVER o, SUM(w) OVER ()) AS before_w, COALESCE(LAG(capped) OVER o, 0) AS before_c
  FROM sums WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / w, source)),
level AS (
  SELECT arg_min(CAST(goal - before_c AS DOUBLE) / CAST(before_w AS DOUBLE), CAST(source_size AS DOUBLE) / w) AS height FROM filled
  WHERE CAST(goal - before_c AS DOUBLE) / CAST(before_w AS DOUBLE) * w < 2.0 * source_size),
targets AS (
  SELECT source, source_size,
         LEAST(2.0 * source_size, COALESCE((SELECT height FROM level), 1e300) * w) AS target FROM placed),
drawn AS (
  SELECT s.doc_id, s.size, t.source_size, CAST(t.target AS DOUBLE) AS target,
         CASE WHEN t.source_size > 0 THEN CAST(t.target AS DOUBLE) / t.source_size ELSE 1.0 END AS rate,
         CAST('0x' || substr(md5('mix:' || COALESCE(CAST(s.doc_id AS VARCHAR), 'text:' || s.text, 'none')), 1, 13) AS BIGINT)
           / 4503599627370496.0 AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((FLOOR(rate) + CASE WHEN u < rate - FLOOR(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM drawn"""


@registered
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.encode(_documents(spark, sf_dir).select("doc_id", "text"), path, keep_text=False)
    return bpe.decode(coded, path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@registered
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(_documents(spark, sf_dir))


@registered
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.fit(docs, ~held_out(F.col("doc_id"), 3, 1))
    said = langid.predict(docs.select("doc_id", "text"), model, reject=False)
    return said.select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score", "rejected"
    )


@registered
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_documents(spark, sf_dir), percent=85)


SQL["op10_near_duplicates"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, COALESCE(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, UNNEST(range(1, len(w) - 3)) AS i FROM worded WHERE len(w) >= 5)
  UNION ALL
  SELECT doc_id, array_to_string(w, ' ') FROM worded WHERE len(w) BETWEEN 1 AND 4),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 85 * (p.n + q.n - k)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, v.y FROM reach r JOIN ways v ON r.b = v.x),
lowest AS (SELECT a, MIN(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id JOIN lowest ON a = d.doc_id"""


@registered
def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    teach = ~held_out(F.col("doc_id"), 10, 0)
    scored = katz_corpus.score_all(docs, teach)
    return scored.select("doc_id", (~F.col("teach")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@registered
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    tokenfile.write(_documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return tokenfile.read(spark, folder, keep_ids=False)


@registered
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf_dir).select("lang", "source", "text"))


SQL["op11_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
         translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
found AS (
  SELECT d, lang, source, UNNEST(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, COUNT(*) AS n FROM found GROUP BY ALL),
kept AS (SELECT lang, term, COUNT(*) AS n FROM found GROUP BY ALL HAVING COUNT(DISTINCT d) >= 10),
langs AS (SELECT lang, COUNT(*) AS v, SUM(n) AS total FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
cells AS (
  SELECT s.lang, s.source, k.term, COALESCE(c.n, 0) AS n, k.n AS lang_n
  FROM sources s JOIN kept k ON k.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
priced AS (
  SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (SUM(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
         1 + (1000000000 * (lang_n + 2)) // (total + 2 * v) AS q
  FROM cells JOIN langs USING (lang)),
pairs AS (
  SELECT s.lang, s.source, t.source AS item, COALESCE(f, 0) AS value
  FROM sources s JOIN sources t ON t.lang = s.lang AND t.source <> s.source
  LEFT JOIN (SELECT a.lang, a.source AS x, b.source AS y, SUM(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS f
             FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) z
  ON z.lang = s.lang AND x = s.source AND y = t.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM priced WHERE n > 0 AND p > q),
ranked AS (
  SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (SELECT 'term' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
  WHERE rank <= 10)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked"""


@registered
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT UNNEST(range(256)) AS b))),
runs AS (
  SELECT doc_id, run, COUNT(*) AS k FROM (
    SELECT doc_id, UNNEST(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           flatten(list_transform(string_split(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
             lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + unicode(c)::BIGINT // 64, 128 + unicode(c)::BIGINT % 64] END))),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS h
  FROM runs, crc),
words AS (
  SELECT word, CAST(SUM(k) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= 5 GROUP BY 1 HAVING SUM(k) >= 3),
less AS (
  SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS cut
  FROM (SELECT word, n, UNNEST(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word AS x, b.word AS y, b.n AS m FROM less a JOIN less b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.cut = b.word),
best AS (
  SELECT x, COUNT(*) AS n_near, arg_min(y, ROW(-m, y)) AS y, MAX(m) AS m FROM pairs GROUP BY x),
formed AS (
  SELECT word, n, COALESCE(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN y END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM words LEFT JOIN best ON x = word),
walk(word, stop) AS (
  SELECT word, word FROM formed UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON f.word = w.stop WHERE f.form IS NOT NULL),
ends AS (SELECT w.word, w.stop FROM walk w JOIN formed f ON f.word = w.stop WHERE f.form IS NULL)
SELECT f.word, form, stop AS root, n, n_near, form_n FROM formed f JOIN ends e ON e.word = f.word"""
