"""The registered queries of this subpackage: thin callers of its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstack.llm import ann, bpe, chat, divergence, jaccard_join, langid, licenses, lm, packing, resample, spotsigs, toxicity, warc
from tabstack.llm.common import id_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = id_remainder("doc_id", 4) == 2
    langs, model = langid.fit(docs, ~held)
    return langid.predict(docs.withColumn("held_out", held), langs, model, keep=("held_out",))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = id_remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, labels, ~held)
    scored = toxicity.score(docs.withColumn("held_out", held), model, keep=("held_out",))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(table(spark, sf_dir, "documents"), id_remainder("doc_id", 10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


@query
def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edited(table(spark, sf_dir, "documents"))


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


@query
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat.digests(chat.format_chats(rows.unionByName(own)))


ORACLES["op13_chat_formatting"] = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*(/?(SYS|INST|OUT|ROLE)|TEXT)\]')) AS escaped,
    CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 11
      ELSE 19 + length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*(/?(SYS|INST|OUT|ROLE)|TEXT)\]')) END AS marks
  FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(7 + sum(escaped + marks) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_importance_resampling"] = r"""
WITH RECURSIVE step(k, i, c) AS (
  SELECT 0, i::BIGINT, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT k + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM step WHERE k = 8),
w AS (
  SELECT 0 AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 1, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS (
  SELECT kind, id, unnest(w) AS feature FROM w
  UNION ALL SELECT kind, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w),
hashed AS (
  SELECT feature, xor(4294967295, list_reduce(list_transform(range(0, length(h) // 2), lambda i: (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) % 10000 AS bucket
  FROM (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM f), tab),
n AS (SELECT kind, id, bucket, count(*) AS n FROM f JOIN hashed USING (feature) GROUP BY ALL),
b AS (SELECT bucket, coalesce(sum(n) FILTER (kind = 0), 0) AS s, coalesce(sum(n) FILTER (kind = 1), 0) AS t FROM range(10000) r(bucket) LEFT JOIN n USING (bucket) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM b),
m AS (SELECT id, sum(n) AS nf, sum(n * gain) AS total FROM n JOIN g USING (bucket) WHERE kind = 0 GROUP BY id),
sc AS (
  SELECT doc_id, CAST(coalesce(nf, 0) AS BIGINT) AS n_features,
    CAST(CASE WHEN nf IS NULL THEN 0 ELSE total // nf - CASE WHEN total % nf < 0 THEN 1 ELSE 0 END END AS BIGINT) AS weight,
    CAST('0x' || left(sha256('7:' || doc_id), 8) AS BIGINT) AS h
  FROM documents LEFT JOIN m ON id = doc_id),
ranked AS (
  SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM sc),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS total FROM ranked WHERE n_features >= 39)
SELECT k.*, CASE WHEN place <= 25 * total // 100 THEN place END AS rank FROM ranked k LEFT JOIN r USING (doc_id)
"""


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
n AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM (SELECT id, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS everywhere FROM n GROUP BY ALL HAVING sum(docs) >= 30),
totals AS (SELECT lang, count(*) AS v, sum(everywhere) AS total FROM kept GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total, coalesce(own, 0) AS own
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN totals USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS own FROM n JOIN kept USING (lang, term) GROUP BY ALL) USING (lang, source)),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (own + 5 * v) AS p, 1 + (1000000000::HUGEINT * (everywhere + 5)) // (total + 5 * v) AS q
  FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
pair AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(f, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN (SELECT a.lang, a.source AS a, b.source AS b, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
      ON s.lang = x.lang AND s.a = x.source AND s.b = y.source),
every AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', term, p - q, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS rank FROM p WHERE n > 0 AND p > q
  QUALIFY rank <= 50)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM every
"""
