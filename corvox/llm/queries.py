"""The registered queries of the operators: each applies one to its whole table, with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, brown, centroids, decontamination, infilling, packing, personal, secrets, sharding, simhash, suffixes, toxicity, windows


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(decontamination.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op5_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(_table(spark, sf_dir, "documents"))


def op6_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.remove_repeats(_table(spark, sf_dir, "documents")).drop("n_spans")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout has all documents of a source in one of 12 shards, so a hot source makes it uneven."""
    old = F.pmod(F.xxhash64("source"), F.lit(12))
    placed = sharding.reshard(_table(spark, sf_dir, "documents"), 16, old, 12)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, final = centroids.cluster(_table(spark, sf_dir, "embeddings"))
    of = {r.cluster: r.n for r in found.groupBy("cluster").agg(F.try_sum("distance").alias("n")).collect()}  # a row a cluster
    every = None if None in of.values() or sum(of.values()) >= 1 << 63 else sum(of.values())
    facts = [(k, n, every, hashlib.sha256(",".join(map(str, final[k].tolist())).encode()).hexdigest()) for k, n in of.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infilling.transform(_table(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    back = infilling.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"))


def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.scan(_table(spark, sf_dir, "documents"))


def _lloyd(rounds: int = 10) -> str:
    """The rounds one after another: c0, a0, c1, a1 ..., each a table of its own."""
    parts = [
        """v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
 WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM v ORDER BY h, v LIMIT 8))",
    ]
    for t in range(rounds + 1):
        parts.append(f"a{t} AS MATERIALIZED (SELECT r, arg_min(k, d * 8 + k) AS k, min(d) AS d FROM (SELECT r, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, c{t}) GROUP BY r)")
        if t < rounds:
            parts.append(f"m{t} AS (SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range(64)) AS i FROM a{t} JOIN v USING (r)) GROUP BY k, i)")
            parts.append(f"c{t + 1} AS MATERIALIZED (SELECT k, coalesce(m, c) AS c FROM c{t} LEFT JOIN (SELECT k, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM m{t} GROUP BY k) USING (k))")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} USING (k)"""


#: DuckDB SQL for the operators that it can express.
ORACLE = {
    "op3_suffixes": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, s, substr(h, 2 * s + 1, 2) AS b, CASE WHEN 2 * s + 400 <= length(h) THEN md5_number(substr(h, 2 * s + 1, 400)) END AS w FROM (SELECT doc_id, h, unnest(range(length(h) // 2)) AS s FROM d)),
n AS (SELECT doc_id, s, b, CASE WHEN w IS NOT NULL AND count(*) OVER (PARTITION BY w) > 1 THEN 1 ELSE 0 END AS r FROM p),
g AS (SELECT doc_id, s, b, max(r) OVER (PARTITION BY doc_id ORDER BY s ROWS 199 PRECEDING) AS gone FROM n),
e AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM g),
a AS (SELECT doc_id, sum(gone) AS n_removed, count(*) FILTER (gone = 1 AND before = 0) AS n_spans, string_agg(b, '' ORDER BY s) FILTER (gone = 0) AS k FROM e GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, ''))) AS kept_sha256 FROM d LEFT JOIN a USING (doc_id)""",
    "op4_decontamination": """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
bn AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, i + 1, i + n), ' ') AS w FROM (SELECT *, unnest(range(len(ws) - n + 1)) AS i FROM bn)),
dn AS (SELECT doc_id, ws, n FROM d, (SELECT DISTINCT n FROM bn) WHERE len(ws) >= n),
dw AS (SELECT doc_id, i, n, array_to_string(list_slice(ws, i + 1, i + n), ' ') AS w FROM (SELECT *, unnest(range(len(ws) - n + 1)) AS i FROM dn)),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, w)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op6_windows": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, s, array_to_string(list_slice(ws, s + 1, s + 20), ' ') AS w FROM (SELECT *, unnest(range(len(ws) - 19)) AS s FROM d WHERE len(ws) >= 20)),
again AS (SELECT doc_id, s FROM w QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM again),
kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS k FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_centroids": _lloyd(),
    "op12_infilling": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS us, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(list_slice(us, 1, a), '') AS pre, array_to_string(list_slice(us, a + 1, b), '') AS mid, array_to_string(list_slice(us, b + 1, n), '') AS suf,
 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_packing, op2_neighbours, op3_suffixes, op4_decontamination, op5_brown, op6_windows, op7_sharding, op8_simhash, op9_toxicity, op10_secrets, op11_centroids, op12_infilling, op13_personal]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
