"""Views of the driver's tables in the shapes that the operators take. The same text runs on Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UTTERANCES = """
WITH base AS (
  SELECT o_orderkey AS k, o_custkey AS c, lower(c_mktsegment) AS source,
         CASE WHEN o_orderstatus = 'F' THEN 'fake' ELSE 'real' END AS label,
         CASE WHEN o_orderstatus <> 'F' THEN ''
              WHEN o_orderpriority = '1-URGENT' THEN 'eng_a:v1'
              WHEN o_orderpriority = '2-HIGH'   THEN 'eng_a:v2'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'eng_b:v1'
              WHEN o_orderpriority = '5-LOW'    THEN 'eng_c:v1'
              ELSE 'eng_c' END AS generator,
         CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE b.text END AS text
  FROM {orders} o JOIN {customer} u ON o_custkey = c_custkey
  JOIN {benchmark} b ON b.item_id = o_orderkey % 40),
clean AS (
  SELECT 'utt-' || CAST(k AS VARCHAR(20)) AS utt_id, label, source,
         CASE WHEN c % 25 = 0 THEN '' ELSE 'spk-' || CAST(c AS VARCHAR(20)) END AS speaker,
         text, generator,
         CASE WHEN label = 'real' THEN ''
              WHEN k % 11 = 0 THEN 'utt-missing'
              ELSE coalesce('utt-' || CAST(min(CASE WHEN label = 'real' THEN k END)
                                           OVER (PARTITION BY c) AS VARCHAR(20)), 'utt-missing') END AS ref_utt_id,
         CAST(3000 + k % 7001 AS DOUBLE) / CAST(1000 AS DOUBLE) AS duration,
         CAST((k * 7919) % 701 + CASE WHEN label = 'fake' THEN 300 ELSE 0 END AS DOUBLE)
             / CAST(1000 AS DOUBLE) AS score,
         k
  FROM base)
SELECT utt_id, label, source, speaker, text, generator, ref_utt_id, duration, score,
       '' AS augment, '' AS parent_utt_id FROM clean
UNION ALL
SELECT utt_id || '-aug0', label, source, speaker, text, generator, ref_utt_id, duration, score,
       'gauss15db', utt_id FROM clean WHERE k % 5 = 0
"""

FEATURES = """
SELECT concat('vec-', CAST(vec_id AS VARCHAR(20))) AS utt_id,
       concat('spk-', CAST(label AS VARCHAR(20))) AS speaker,
       CASE WHEN label >= 5 THEN 'fake' ELSE 'real' END AS label,
       CASE WHEN label >= 5 THEN concat('eng_', CAST(label AS VARCHAR(20))) ELSE '' END AS generator,
       embedding,
       CASE WHEN vec_id % 10 < 7 THEN 'train' WHEN vec_id % 10 = 7 THEN 'val' ELSE 'test' END AS split
FROM {embeddings}
"""

HYPOTHESES = """
SELECT a.conv_id, a.turn, a.text AS ref_text, b.text AS hyp_text
FROM {conversations} a JOIN {conversations} b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
WHERE a.role = 'user' AND b.role = 'assistant'
"""

SOURCE_ITEMS = """
SELECT source, lang AS language, concat('spk ', CAST(d.doc_id % 60 AS VARCHAR(20))) AS speaker,
       concat('doc/', CAST(d.doc_id AS VARCHAR(20)), '.wav') AS key, text, n_chars,
       CASE WHEN l.toxic = 1 THEN 'fake' ELSE 'real' END AS label
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

TABLES = ("orders", "customer", "benchmark", "embeddings", "conversations", "documents", "labels", "events")


def in_duckdb(view: str) -> str:
    return view.format(**{t: t for t in TABLES}).strip()


def _view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return spark.sql(view, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in view})


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, UTTERANCES)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, FEATURES)


def hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, HYPOTHESES)


def source_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SOURCE_ITEMS)


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vector of samples for each user, by time; a sample counts as 0.1 s."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    ordered = F.array_sort(F.collect_list(F.struct("ts", "event_id", "value")))
    return events.groupBy("user_id").agg(ordered.alias("s")).select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("utt_id"), F.transform("s", lambda x: x["value"] / 512).alias("signal")
    )


SIGNALS = """
SELECT 'user-' || CAST(user_id AS VARCHAR) AS utt_id, list(value / CAST(512 AS DOUBLE) ORDER BY ts, event_id) AS signal
FROM events GROUP BY user_id
"""
