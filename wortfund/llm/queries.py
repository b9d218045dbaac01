"""The operators of this subpackage as queries over whole tables, with SQL where SQL can say the same.

A query prints the contract's digest columns of what its operator returns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wortfund.llm import bpe, hard_negatives, html_text, langid, lm, mixing, near_dup, periodic, quality, secret_scan, sharding, topk, toxicity

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_sharding(spark, sf_dir):
    out = sharding.shard(read(spark, sf_dir, "documents").select("doc_id", "text"), shards=24)
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_mixing(spark, sf_dir):
    out = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "mix_block", "mix_slot", "mix_position")


@query
def op3_quality_rules(spark, sf_dir):
    out = quality.cascade(read(spark, sf_dir, "documents").select("doc_id", "text"), complete=True)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept")


@query
def op4_near_duplicates(spark, sf_dir):
    return near_dup.classify(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op5_top_k(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op6_lm_scoring(spark, sf_dir):
    out = lm.score(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "lm_words", "lm_known_bigrams", F.round("lm_logsum", 4).alias("lm_logsum"), F.round("lm_score", 6).alias("lm_score"))


@query
def op7_secret_scan(spark, sf_dir):
    out = secret_scan.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    show = lambda some: F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.filter("secrets", lambda s: s["kind"] == kind)
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))
    return out.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(show(base), 256).alias("base_sha256"),
        show(F.col("secrets")).alias("spans"),
    )


@query
def op8_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs.where(langid.remainder("doc_id", 4) != 2).select("lang", "text"))
    out = langid.predict(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(langid.remainder("doc_id", 4) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query
def op9_toxicity(spark, sf_dir):
    docs, labels = (read(spark, sf_dir, t) for t in ("documents", "labels"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels.where(langid.remainder("doc_id", 5) != 0))
    out = toxicity.predict(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(langid.remainder("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def _digests(*more: str):
    def run(batches):
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            ids = [np.asarray(x.values.to_numpy(), dtype="<u4") for x in batch["ids"]]
            columns = {
                "doc_id": batch["row"].field("doc_id"),
                "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                "ids_sha256": pa.array([sha(x.tobytes()) for x in ids], pa.string()),
                "decoded_sha256": pa.array([sha(x.encode()) for x in batch["decoded"].to_pylist()], pa.string()),
            }
            columns |= {c: batch["row"].field(c) for c in more}
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return run


def tokens_of(docs: DataFrame, content: str, *more: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, and its columns `more`, which are whole numbers."""
    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join(f", {c} long" for c in more)
    return bpe.encode_and_decode(docs.select("doc_id", "text", *more), content, _digests(*more), columns)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op10_bpe(spark, sf_dir):
    return tokens_of(read(spark, sf_dir, "documents"), bpe.vocabulary(vocabulary_path()))


@query
def op11_periodic_runs(spark, sf_dir):
    docs = periodic.planted(read(spark, sf_dir, "documents").select("doc_id", "text"))
    out = periodic.find_runs(docs, keep_text=False)
    # runs come by start and period, so of equal exponents the first stays
    longer = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    none = F.lit(None).cast(periodic.RUN)
    best = F.aggregate("runs", none, lambda best, run: F.when(longer(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query
def op13_html_extraction(spark, sf_dir):
    out = html_text.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"), keep_html=False)
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op2_mixing"] = """
WITH RECURSIVE src AS (
  SELECT source, n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i,
         greatest(1, CAST(floor(32 * sqrt(n) / sqrt(max(n) OVER ())) AS BIGINT)) AS parts
  FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)
), arr AS (SELECT list(parts ORDER BY i) AS a, CAST(sum(parts) AS BIGINT) AS d, count(*) AS k FROM src),
sim AS (
  SELECT CAST(-1 AS BIGINT) AS t, list_transform(a, lambda x: CAST(0 AS BIGINT)) AS had, CAST(NULL AS BIGINT) AS pick, a, d, k FROM arr
  UNION ALL
  SELECT t, list_transform(range(k), lambda j: had[j + 1] + CASE WHEN j = pick THEN 1 ELSE 0 END), pick, a, d, k
  FROM (
    SELECT t + 1 AS t, had, a, d, k, list_min(list_transform(range(k), lambda j:
      CASE WHEN had[j + 1] < a[j + 1] AND (had[j + 1] * d) // a[j + 1] <= t + 1
           THEN (((had[j + 1] + 1) * d + a[j + 1] - 1) // a[j + 1]) * k + j END)) % k AS pick
    FROM sim WHERE t + 1 < d)
), slots AS (SELECT t AS slot, pick AS i, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS own FROM sim WHERE t >= 0),
ranked AS (
  SELECT doc_id, source,
         row_number() OVER (PARTITION BY source ORDER BY md5(concat('11:', coalesce(CAST(doc_id AS VARCHAR), chr(0)), ':', coalesce(text, chr(0))))) - 1 AS r
  FROM documents
), placed AS (
  SELECT doc_id, ranked.source, r, r // 16 AS mix_block, ((r // 16) // parts) * d + slot AS mix_slot
  FROM ranked JOIN src ON ranked.source IS NOT DISTINCT FROM src.source, arr JOIN slots ON true
  WHERE slots.i = src.i AND slots.own = (r // 16) % parts
)
SELECT doc_id, source, mix_block, mix_slot, row_number() OVER (ORDER BY mix_slot, r) - 1 AS mix_position FROM placed
"""

ORACLES["op3_quality_rules"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT u, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT u, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) > 5)
), again AS (SELECT u, i FROM g QUALIFY count(*) OVER (PARTITION BY u, g) > 1),
covered AS (SELECT u, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(5)) AS k) GROUP BY u),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (u)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 40 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 12 * n_words) AS kept
FROM m
"""

ORACLES["op5_top_k"] = """
WITH v AS (
  SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.u, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLES["op6_lm_scoring"] = f"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT u, i, m, w[i] AS w2, CASE WHEN i > 1 THEN w[i - 1] END AS w1 FROM (SELECT u, w, len(w) AS m, unnest(range(1, len(w) + 1)) AS i FROM d)),
c AS (
  SELECT u, m, w1, w1 IS NOT NULL AS second, count(*) OVER () AS n,
         count(*) OVER (PARTITION BY w2) - count(*) OVER (PARTITION BY u, w2) AS c2,
         count(*) OVER (PARTITION BY w1, w2) - count(*) OVER (PARTITION BY u, w1, w2) AS c12
  FROM p
), one AS (SELECT w2 AS w, count(*) AS c FROM p GROUP BY w2), own AS (SELECT u, w2 AS w, count(*) AS c FROM p GROUP BY u, w2),
x AS (
  SELECT c.u, second, n - m AS n, c2, one.c - own.c AS c1, c12
  FROM c LEFT JOIN one ON one.w = c.w1 LEFT JOIN own ON own.u = c.u AND own.w = c.w1
), s AS (
  SELECT u, second AND c12 > 0 AS known, CASE WHEN c2 > 0 THEN CAST(c2 AS DOUBLE) / n ELSE CAST(0.4 AS DOUBLE) / (n + 1) END AS single, second, c1, c12 FROM x
), t AS (
  SELECT u, count(*) AS lm_words, count_if(known) AS known,
         sum(ln(CASE WHEN known THEN CAST(c12 AS DOUBLE) / c1 WHEN second THEN CAST(0.4 AS DOUBLE) * single ELSE single END)) AS total
  FROM s GROUP BY u
)
SELECT doc_id, coalesce(lm_words, 0) AS lm_words, CAST(coalesce(known, 0) AS BIGINT) AS lm_known_bigrams,
       round(coalesce(total, 0), 4) AS lm_logsum, round(total / lm_words, 6) AS lm_score
FROM d LEFT JOIN t USING (u)
"""

ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
         row_number() OVER () AS u
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.u, q.vec_id AS anchor_id, c.u AS cu, c.vec_id AS id, c.label = q.label AS same,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.u <> c.u AND len(q.v) = len(c.v)
), p AS (SELECT u, cu, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY u ORDER BY score DESC, id) <= 5),
n AS (
  SELECT s.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.u, p.cu ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
         s.id AS negative_id, positive_score, s.score AS negative_score
  FROM p JOIN s ON s.u = p.u AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT * FROM n WHERE rank <= 10
"""
