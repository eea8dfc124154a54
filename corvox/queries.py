"""The registered queries over the driver's tables, each beside the DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import views
from .functions import text as X
from .operators import augment, corpus, features, metrics, model, signal, splits
from .plans import synthesis
from .schema import engine, label_code, problems
from .sources import ingest
from .tables import held

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

U = f"WITH utterances AS ({views.in_duckdb(views.UTTERANCES)})"
FE = f"WITH features AS ({views.in_duckdb(views.FEATURES)})"
HY = f"WITH hypotheses AS ({views.in_duckdb(views.HYPOTHESES)})"
SI = f"WITH source_items AS ({views.in_duckdb(views.SOURCE_ITEMS)})"
SG = f"WITH signals AS ({views.SIGNALS.strip()})"
CH = "chr(31)"
SPEC10 = signal.AudioSpec(sample_rate=10)


def query(sql: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__], ORACLE[fn.__name__] = fn, sql
        return fn

    return add


# ------------------------------------------------------------------ metrics

ROC = """
h AS (SELECT {keys}, score, count(*) FILTER (label = 'fake') AS f, count(*) FILTER (label = 'real') AS r FROM {rows} GROUP BY ALL),
c AS (SELECT {keys}, score, sum(f) OVER w AS tp, sum(r) OVER w AS fp, sum(f) OVER (PARTITION BY {keys}) AS p, sum(r) OVER (PARTITION BY {keys}) AS n
      FROM h WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
k AS (SELECT *, lead(tp) OVER w - 2 * tp + lag(tp) OVER w AS bt, lead(fp) OVER w - 2 * fp + lag(fp) OVER w AS bf
      FROM c WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC)),
roc AS (SELECT {keys}, score, tp, fp, p, n FROM k WHERE bt IS NULL OR bt <> 0 OR bf <> 0
        UNION ALL SELECT {keys}, CAST('inf' AS DOUBLE), 0, 0, sum(f), sum(r) FROM h GROUP BY {keys}),
e AS (SELECT {keys}, (CAST(fp AS DOUBLE) / n + 1 - CAST(tp AS DOUBLE) / p) / 2 AS eer, score AS eer_threshold
      FROM roc WHERE p > 0 AND n > 0
      QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY round(abs(1 - CAST(tp AS DOUBLE) / p - CAST(fp AS DOUBLE) / n), 12), score DESC) = 1)
"""


def roc_sql(keys: str, rows: str) -> str:
    return ROC.format(keys=keys, rows=rows)


@query(f"{U}, {roc_sql('engine', chr(40) + "SELECT split_part(generator, ':', 1) AS engine, label, score FROM utterances" + chr(41))} SELECT engine, score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM roc")
def roc_points(spark, d):
    rows = views.utterances(spark, d).withColumn("engine", engine(F.col("generator")))
    return metrics.roc_points(metrics.histogram(rows, "engine"), ["engine"]).select("engine", "score", "tp", "fp")


BREAKDOWN = """
g AS (SELECT {keys}, score, count(*) FILTER (label = 'fake') AS f, count(*) FILTER (label = 'real') AS r FROM {rows} GROUP BY ALL),
facts AS (SELECT {keys}, sum(f + r) AS n, sum(r) AS n_real, sum(f) AS n_fake, sum(score * (f + r)) / sum(f + r) AS mean_score,
          CAST(coalesce(sum(f + r) FILTER (score >= 0.5), 0) AS DOUBLE) / sum(f + r) AS hits FROM g GROUP BY {keys}),
reals AS (SELECT {dim}score, sum(r) AS r FROM g GROUP BY {dim}score HAVING sum(r) > 0),
h AS (SELECT {keys}, score, sum(f) AS f, sum(r) AS r FROM (
        SELECT {keys}, score, f, r FROM g UNION ALL
        SELECT {fkeys}, reals.score, 0, reals.r FROM facts JOIN reals ON {on} WHERE n_real = 0 AND n_fake > 0) GROUP BY ALL),
"""


def breakdown_sql(keys: list[str], rows: str) -> str:
    dim = "".join(f"{k}, " for k in keys[:-1])
    head = BREAKDOWN.format(keys=", ".join(keys), dim=dim, fkeys=", ".join(f"facts.{k}" for k in keys), rows=rows, on=" AND ".join(f"facts.{k} = reals.{k}" for k in keys[:-1]) or "true")
    tail = roc_sql(", ".join(keys), "utterances").split("c AS", 1)[1]
    using = ", ".join(keys)
    return f"""{head} c AS {tail}
SELECT {using}, CAST(n AS BIGINT) AS n, CAST(n_real AS BIGINT) AS n_real, CAST(n_fake AS BIGINT) AS n_fake, round(mean_score, 6) AS mean_score, round(eer, 6) AS eer,
       CASE WHEN n_real = 0 THEN round(hits, 6) END AS detection_rate, CASE WHEN n_fake = 0 THEN round(hits, 6) END AS false_alarm_rate
FROM facts LEFT JOIN e USING ({using})"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"{U}, {breakdown_sql(['value'], "(SELECT coalesce(nullif(generator, ''), '(real)') AS value, label, score FROM utterances)")}")
def eer_by_generator(spark, d):
    rows = views.utterances(spark, d).withColumn("value", X.or_placeholder(F.col("generator"), "(real)"))
    return _rounded(metrics.breakdown(rows, ["value"], 0.5), "mean_score", "eer", "detection_rate", "false_alarm_rate")


DIMS = """(SELECT unnest([{'dim': 'generator', 'value': coalesce(nullif(generator, ''), '(real)')}, {'dim': 'engine', 'value': coalesce(nullif(split_part(generator, ':', 1), ''), '(real)')},
  {'dim': 'source', 'value': coalesce(nullif(source, ''), '(unknown)')}, {'dim': 'condition', 'value': CASE WHEN augment = '' THEN 'clean' ELSE 'augmented' END}], recursive := true), label, score FROM utterances)"""


@query(f"{U}, {breakdown_sql(['dim', 'value'], DIMS)}")
def breakdowns(spark, d):
    rows = metrics.dimensions(views.utterances(spark, d))
    return _rounded(metrics.breakdown(rows, ["dim", "value"], 0.5), "mean_score", "eer", "detection_rate", "false_alarm_rate")


@query(f"""{U}, {roc_sql('all_', '(SELECT 0 AS all_, label, score FROM utterances)')},
ends AS (SELECT max(score) FILTER (r > 0) AS top_real, min(score) FILTER (f > 0) AS low_fake, min(score) AS low, max(score) AS top FROM h),
t AS (SELECT CASE WHEN top_real < low_fake THEN (top_real + low_fake) / 2 WHEN eer_threshold > low AND eer_threshold < top THEN eer_threshold ELSE 0.5 END AS threshold, eer FROM ends, e),
m AS (SELECT sum(f) FILTER (score >= threshold) AS tp, sum(r) FILTER (score >= threshold) AS fp, sum(f) FILTER (score < threshold) AS fn, sum(r) FILTER (score < threshold) AS tn FROM h, t),
auc AS (SELECT CAST(sum((fp - lf) * (tp + lt)) AS DOUBLE) / (CAST(2 AS DOUBLE) * max(p) * max(n)) AS auc FROM (SELECT *, coalesce(lag(fp) OVER (ORDER BY score DESC), 0) AS lf, coalesce(lag(tp) OVER (ORDER BY score DESC), 0) AS lt FROM c)),
dcf AS (SELECT min(CAST(0.05 AS DOUBLE) * (1 - CAST(tp AS DOUBLE) / p) + CAST(0.95 AS DOUBLE) * CAST(fp AS DOUBLE) / n) / CAST(0.05 AS DOUBLE) AS min_dcf FROM roc)
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, round(threshold, 6) AS threshold, round(eer, 6) AS eer, round(min_dcf, 6) AS min_dcf, round(auc, 6) AS auc,
  round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 6) AS accuracy, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS "precision", round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS recall,
  round(CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn), 6) AS f1, round(CAST(fp AS DOUBLE) / (fp + tn), 6) AS false_alarm_rate, round(CAST(fn AS DOUBLE) / (tp + fn), 6) AS miss_rate,
  round((CAST(tp AS DOUBLE) / (tp + fn) + CAST(tn AS DOUBLE) / (tn + fp)) / 2, 6) AS balanced_accuracy FROM m, t, auc, dcf""")
def detection_report(spark, d):
    got = metrics.full_report(views.utterances(spark, d)).drop("eer_threshold")
    return _rounded(got, "threshold", "eer", "min_dcf", "auc", "accuracy", "precision", "recall", "f1", "false_alarm_rate", "miss_rate", "balanced_accuracy")


@query(f"""{U}, h AS (SELECT score, count(*) FILTER (label = 'fake') AS f, count(*) FILTER (label = 'real') AS r FROM utterances GROUP BY score)
SELECT score, CAST(sum(f) OVER w AS BIGINT) AS cum_f, CAST(sum(r) OVER w AS BIGINT) AS cum_r FROM h WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""")
def score_prefix_sums(spark, d):
    return metrics.prefix_sums(metrics.histogram(views.utterances(spark, d)), "score", ["f", "r"]).select("score", "cum_f", "cum_r")


@query(f"""{U}, h AS (SELECT source, score, count(*) FILTER (label = 'fake') AS f, count(*) FILTER (label = 'real') AS r FROM utterances GROUP BY ALL),
c AS (SELECT source, score, sum(f) OVER w AS tp, sum(r) OVER w AS fp, sum(f) OVER (PARTITION BY source) AS p FROM h WINDOW w AS (PARTITION BY source ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
SELECT source, score, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS "precision", round(CAST(tp AS DOUBLE) / p, 6) AS recall FROM c""")
def precision_recall(spark, d):
    return _rounded(metrics.precision_recall(metrics.histogram(views.utterances(spark, d), "source"), ["source"]), "precision", "recall")


@query(f"""{U}, e AS (SELECT label, min(score) AS low, max(score) AS top FROM utterances GROUP BY label)
SELECT label, CAST(least(floor((score - low) / ((top - low) / 40)), 39) AS INTEGER) AS bin, count(*) AS n FROM utterances JOIN e USING (label) GROUP BY ALL""")
def score_histogram(spark, d):
    return metrics.score_bins(views.utterances(spark, d))


# ------------------------------------------------------------------ text and ids

SLUG = "substr(coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_replace({0}, '[^\\p{{L}}\\p{{N}}._-]', '-', 'g')), '^-+|-+$', '', 'g'), '-{{2,}}', '-', 'g'), ''), 'unknown'), 1, {1})"


@query(f"""{SI} SELECT key, {SLUG.format('key', 48)} AS slug, substr(sha1(concat_ws({CH}, source, speaker, key)), 1, 12) AS id,
{SLUG.format('source', 20)} || '-' || substr(sha1(concat_ws({CH}, source, speaker, key)), 1, 12) || CASE WHEN n_chars % 3 > 0 THEN '-' || CAST(n_chars % 3 AS VARCHAR) ELSE '' END AS utt_id FROM source_items""")
def utterance_ids(spark, d):
    s, p, k = F.col("source"), F.col("speaker"), F.col("key")
    return views.source_items(spark, d).select("key", X.slugify(k).alias("slug"), X.stable_id(s, p, k).alias("id"), X.utterance_id(s, p, k, F.col("n_chars") % 3).alias("utt_id"))


@query(f"""{U} SELECT utt_id, CASE WHEN augment <> '' THEN 'aug/' || utt_id || '.wav'
 WHEN label = 'fake' THEN 'fake/' || {SLUG.format("split_part(generator, ':', 1)", 48)} || '/' || {SLUG.format("coalesce(nullif(split_part(generator, ':', 2), ''), 'default')", 48)} || '/' || utt_id || '.wav'
 ELSE 'real/' || {SLUG.format('source', 48)} || '/' || {SLUG.format("coalesce(nullif(speaker, ''), 'unknown')", 48)} || '/' || utt_id || '.wav' END AS path,
 split_part(generator, ':', 1) AS engine, CASE label WHEN 'real' THEN 0 ELSE 1 END AS y FROM utterances""")
def audio_paths(spark, d):
    c = F.col
    path = X.audio_path(c("utt_id"), c("label"), c("source"), c("speaker"), c("generator"), c("augment"))
    return views.utterances(spark, d).select("utt_id", path.alias("path"), engine(c("generator")).alias("engine"), label_code(c("label")).alias("y"))


BROKEN = """broken AS (SELECT utt_id, CASE WHEN hash_ % 5 = 0 THEN 'odd' ELSE label END AS label, CASE WHEN hash_ % 7 = 0 THEN 'x:y' WHEN hash_ % 3 = 0 THEN '' ELSE generator END AS generator
 FROM (SELECT *, CAST(regexp_extract(utt_id, '[0-9]+') AS BIGINT) AS hash_ FROM utterances))"""


def _broken(spark, d):
    h = F.regexp_extract("utt_id", "[0-9]+", 0).cast("long")
    return views.utterances(spark, d).select("utt_id", F.when(h % 5 == 0, "odd").otherwise(F.col("label")).alias("label"), F.when(h % 7 == 0, "x:y").when(h % 3 == 0, "").otherwise(F.col("generator")).alias("generator"))


@query(f"""{U}, {BROKEN}, i AS (SELECT unnest([CASE WHEN label NOT IN ('real', 'fake') THEN 'unknown label' END, CASE WHEN label = 'fake' AND generator = '' THEN 'fake without generator' END, CASE WHEN label = 'real' AND generator <> '' THEN 'real with generator' END]) AS code FROM broken)
SELECT code, count(*) AS n FROM i WHERE code IS NOT NULL GROUP BY code""")
def schema_issue_counts(spark, d):
    return corpus.issue_counts(_broken(spark, d))


@query(f"""{U}, {BROKEN} SELECT utt_id, concat_ws(';', CASE WHEN label NOT IN ('real', 'fake') THEN 'unknown label' END, CASE WHEN label = 'fake' AND generator = '' THEN 'fake without generator' END, CASE WHEN label = 'real' AND generator <> '' THEN 'real with generator' END) AS problems FROM broken""")
def row_problems(spark, d):
    rows = _broken(spark, d)
    return rows.select("utt_id", F.array_join(problems(rows), ";").alias("problems"))


DWORDS = "len(list_filter(regexp_split_to_array(trim(text, ' '), '\\s+'), lambda w: w <> ''))"


@query(f"{U} SELECT utt_id, {DWORDS} BETWEEN 20 AND 50 AS usable, CAST({DWORDS} AS INTEGER) AS n_words FROM utterances")
def usable_sentences(spark, d):
    return views.utterances(spark, d).select("utt_id", X.is_usable(F.col("text"), 20, 50).alias("usable"), X.n_words(F.col("text")).alias("n_words"))


SHOUT = "CASE WHEN regexp_matches(b, '\\p{L}') AND NOT regexp_matches(b, '\\p{Ll}') THEN lower(b) ELSE b END"


@query(f"""{HY}, t AS (SELECT conv_id, turn, trim(CASE WHEN turn % 2 = 0 THEN upper(replace(ref_text, 'ß', 'ss')) ELSE ref_text END, ' ') AS b FROM hypotheses), s AS (SELECT *, {SHOUT} AS calm FROM t)
SELECT conv_id, turn, CASE WHEN regexp_matches(calm, '[.!?…]$') THEN calm ELSE calm || '.' END AS target, CASE WHEN b <> '' THEN calm END AS reference, CASE WHEN regexp_matches(b, '[.!?…,;:]$') THEN b ELSE b || '.' END AS sentence FROM s""")
def cleaned_texts(spark, d):
    t = F.when(F.col("turn") % 2 == 0, F.upper(F.replace("ref_text", F.lit("ß"), F.lit("ss")))).otherwise(F.col("ref_text"))
    return views.hypotheses(spark, d).select("conv_id", "turn", X.target_text(t).alias("target"), X.reference_text(t).alias("reference"), X.as_sentence(t).alias("sentence"))


@query(f"""{U} SELECT utt_id, concat_ws(':', 'eng', nullif(split_part(generator, ':', 2), ''), CASE WHEN duration > 6 THEN 'big' END) AS tag,
concat_ws('|', CASE WHEN ref_utt_id <> '' THEN ref_utt_id ELSE 'fallback:' || substr(sha1(text), 1, 12) END, split_part(generator, ':', 2), CASE WHEN duration > 6 THEN 'big' END) AS key FROM utterances""")
def synthesis_keys(spark, d):
    voice = F.when(F.instr("generator", ":") > 0, F.split("generator", ":")[1]).otherwise("")
    big = F.when(F.col("duration") > 6, "big").otherwise("")
    return views.utterances(spark, d).select("utt_id", X.generator_tag(F.lit("eng"), voice, big).alias("tag"), X.synthesis_key(F.col("ref_utt_id"), F.col("text"), voice, big).alias("key"))


DTOK = "list_filter(regexp_split_to_array(trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), ' '), '\\s+'), lambda w: w <> '')"


@query(f"{HY} SELECT conv_id, turn, CAST(len({DTOK.format('ref_text')}) AS INTEGER) AS n_ref, array_to_string({DTOK.format('ref_text')}, ' ') AS words FROM hypotheses")
def word_tokens(spark, d):
    w = X.words(F.col("ref_text"))
    return views.hypotheses(spark, d).select("conv_id", "turn", F.size(w).alias("n_ref"), F.array_join(w, " ").alias("words"))


# edit distances row by row: a row's cell is the least of what the row before allows at any cell to its left
WER = f"""{HY.replace('WITH', 'WITH RECURSIVE', 1)}, t AS (SELECT conv_id, turn, {DTOK.format('ref_text')} AS r, {DTOK.format('hyp_text')} AS h FROM hypotheses),
dp AS (SELECT conv_id, turn, 0 AS i, CAST(unnest(range(len(h) + 1)) AS INTEGER) AS j, CAST(unnest(range(len(h) + 1)) AS INTEGER) AS d FROM t UNION ALL
  SELECT conv_id, turn, i + 1, j, j + min(best - j) OVER (PARTITION BY conv_id, turn ORDER BY j) FROM (
    SELECT conv_id, turn, i, j, CASE WHEN j = 0 THEN i + 1 ELSE least(d + 1, lag(d) OVER (PARTITION BY conv_id, turn ORDER BY j) + CASE WHEN r[i + 1] = h[j] THEN 0 ELSE 1 END) END AS best
    FROM dp JOIN t USING (conv_id, turn) WHERE i < len(r))),
s AS (SELECT conv_id, turn, len(r) AS n, d FROM t LEFT JOIN dp USING (conv_id, turn) WHERE i = len(r) AND j = len(h))"""


@query(f"{WER} SELECT conv_id, turn, CASE WHEN n > 0 THEN round(CAST(d AS DOUBLE) / n, 6) END AS wer FROM s")
def word_error_rates(spark, d):
    rate = X.word_error_rate(X.words(F.col("ref_text")), X.words(F.col("hyp_text")))
    return views.hypotheses(spark, d).select("conv_id", "turn", F.round(rate, 6).alias("wer"))


@query(f"""{U} SELECT utt_id, label, round(score, 6) AS score, CASE WHEN score >= 0.5 THEN 'fake' ELSE 'real' END AS predicted, (CASE WHEN score >= 0.5 THEN 'fake' ELSE 'real' END) = label AS correct,
round(abs(score - 0.5) / 0.5, 4) AS confidence, CASE WHEN augment = '' THEN 'clean' ELSE 'augmented' END AS condition, round(CAST(1 AS DOUBLE) / (1 + exp(-score)), 6) AS squashed FROM utterances""")
def predictions(spark, d):
    s = F.col("score")
    said = X.predicted(s, 0.5)
    return views.utterances(spark, d).select("utt_id", "label", F.round(s, 6).alias("score"), said.alias("predicted"), (said == F.col("label")).alias("correct"), X.confidence(s, 0.5).alias("confidence"), X.condition(F.col("augment")).alias("condition"), F.round(X.sigmoid(s), 6).alias("squashed"))


# ------------------------------------------------------------------ filters, joins


@query(f"{U} SELECT utt_id, source FROM utterances WHERE label = 'fake' AND source = 'building' AND augment = ''")
def equality_filter(spark, d):
    return corpus.where_equal(views.utterances(spark, d), label="fake", source="building", augment="").select("utt_id", "source")


@query(f"{U} SELECT DISTINCT speaker FROM utterances WHERE label = 'real' AND speaker <> ''")
def real_speakers(spark, d):
    return corpus.speakers(views.utterances(spark, d), "real")


SPLIT3 = "CASE WHEN CAST(regexp_extract(utt_id, '[0-9]+') AS BIGINT) % 10 < 6 THEN 'train' WHEN CAST(regexp_extract(utt_id, '[0-9]+') AS BIGINT) % 10 = 6 THEN '' ELSE 'test' END"
US = f"{U}, split_rows AS (SELECT *, {SPLIT3} AS split FROM utterances)"


def _split_rows(spark, d):
    k = F.regexp_extract("utt_id", "[0-9]+", 0).cast("long") % 10
    return views.utterances(spark, d).withColumn("split", F.when(k < 6, "train").when(k == 6, "").otherwise("test"))


@query(f"{US} SELECT utt_id, split FROM split_rows WHERE augment = '' AND split IN ('', 'train')")
def augmentable_rows(spark, d):
    return corpus.augmentable(_split_rows(spark, d)).select("utt_id", "split")


@query(f"{U} SELECT utt_id FROM utterances WHERE label = 'real' AND augment = '' AND text <> '' AND {DWORDS} BETWEEN 20 AND 50")
def synthesis_pool(spark, d):
    return corpus.synthesis_pool(views.utterances(spark, d), 20, 50).select("utt_id")


@query(f"""{U}, batch AS (SELECT utt_id, 'new' AS label, 0.0::DOUBLE AS score FROM utterances WHERE duration > 8)
SELECT utt_id, label, score FROM utterances WHERE utt_id NOT IN (SELECT utt_id FROM batch) UNION ALL SELECT * FROM batch""")
def upsert_rows(spark, d):
    rows = views.utterances(spark, d).select("utt_id", "label", "score", "duration")
    batch = rows.where("duration > 8").select("utt_id", F.lit("new").alias("label"), F.lit(0.0).alias("score"))
    return corpus.upsert(rows.drop("duration"), batch)


@query(f"{U} SELECT utt_id FROM utterances WHERE NOT (duration < 4)")
def delete_by_key(spark, d):
    rows = views.utterances(spark, d)
    return corpus.without(rows, rows.where("duration < 4")).select("utt_id")


@query(f"""{U}, k AS (SELECT utt_id FROM utterances WHERE label = 'fake') SELECT count(*) FILTER (utt_id NOT IN (SELECT utt_id FROM k)) AS todo, count(*) FILTER (utt_id IN (SELECT utt_id FROM k)) AS skip_exists FROM utterances""")
def skip_existing(spark, d):
    rows = views.utterances(spark, d)
    known = rows.where("label = 'fake'").select("utt_id", F.lit(True).alias("known"))
    status = F.when(F.col("known"), "skip_exists").otherwise("todo")
    return corpus.counters(rows.join(known, "utt_id", "left"), status, ("todo", "skip_exists"))


@query(f"{US} SELECT c.utt_id, coalesce(p.split, c.split) AS split FROM split_rows c LEFT JOIN split_rows p ON p.utt_id = c.parent_utt_id AND p.augment = ''")
def inherited_split(spark, d):
    return corpus.with_parent(_split_rows(spark, d), ["split"]).select("utt_id", "split")


@query(f"{U} SELECT f.utt_id, f.ref_utt_id, r.speaker AS real_speaker FROM utterances f JOIN utterances r ON r.utt_id = f.ref_utt_id AND r.label = 'real' WHERE f.label = 'fake'")
def fake_real_pairs(spark, d):
    return corpus.pairs(views.utterances(spark, d)).select("utt_id", "ref_utt_id", "real_speaker")


@query(f"{U} SELECT utt_id, ref_utt_id FROM utterances WHERE label = 'fake' AND ref_utt_id NOT IN (SELECT utt_id FROM utterances)")
def unpaired_fakes(spark, d):
    return corpus.unpaired(views.utterances(spark, d)).select("utt_id", "ref_utt_id")


CHUNKED = """pieces AS (SELECT utt_id FROM utterances UNION ALL SELECT utt_id || '-1' FROM utterances WHERE duration > 9 UNION ALL SELECT utt_id || '-2' FROM utterances WHERE duration > 9.5)"""


def _pieces(spark, d):
    rows = views.utterances(spark, d)
    more = [rows.where(F.col("duration") > t).select(F.concat("utt_id", F.lit(f"-{k}")).alias("utt_id")) for k, t in ((1, 9), (2, 9.5))]
    return rows.select("utt_id").union(more[0]).union(more[1])


@query(f"""{U}, {CHUNKED} SELECT DISTINCT utt_id FROM pieces WHERE utt_id || '-1' IN (SELECT utt_id FROM pieces) OR (regexp_matches(utt_id, '-[0-9]+$') AND regexp_replace(utt_id, '-[0-9]+$', '') IN (SELECT utt_id FROM pieces))""")
def chunk_members(spark, d):
    return corpus.chunk_members(_pieces(spark, d))


@query(f"{US} SELECT speaker, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM split_rows WHERE speaker <> '' AND split <> '' GROUP BY speaker HAVING count(DISTINCT split) > 1")
def speaker_leaks(spark, d):
    return corpus.speaker_leaks(_split_rows(spark, d))


@query(f"{FE} SELECT split, label, count(*) AS n, count(*) FILTER (embedding IS NULL) AS dropped FROM features GROUP BY ALL")
def features_by_split(spark, d):
    rows = views.features(spark, d)
    return model.feature_gaps(rows, rows)


@query(f"{FE} SELECT split, label, count(*) AS n, count(*) FILTER (embedding IS NULL OR speaker IN ('spk-3', 'spk-7')) AS dropped FROM features GROUP BY ALL")
def feature_gaps(spark, d):
    rows = views.features(spark, d)
    return model.feature_gaps(rows, rows.where("speaker not in ('spk-3', 'spk-7')"))


@query(f"{US} SELECT speaker FROM split_rows WHERE split = 'train' INTERSECT SELECT speaker FROM split_rows WHERE split = 'test'")
def speakers_in_both(spark, d):
    rows = _split_rows(spark, d)
    return rows.where("split = 'train'").select("speaker").intersect(rows.where("split = 'test'").select("speaker"))


@query(f"""{U}, s AS (SELECT utt_id, source FROM utterances WHERE label = 'real' UNION ALL SELECT utt_id, 'again' FROM utterances WHERE duration > 6) SELECT utt_id, min(source) AS source FROM s GROUP BY utt_id""")
def union_of_sources(spark, d):
    rows = views.utterances(spark, d)
    a, b = rows.where("label = 'real'").select("utt_id", "source"), rows.where("duration > 6").select("utt_id", F.lit("again").alias("source"))
    return corpus.upsert(a, b)


# ------------------------------------------------------------------ aggregations


@query(f"""{US} SELECT 'total' AS stat, '' AS value, count(*) AS n, round(sum(duration) / 3600, 2) AS hours FROM split_rows
UNION ALL SELECT 'label', label, count(*), round(sum(duration) / 3600, 2) FROM split_rows GROUP BY label
UNION ALL SELECT 'source', source, count(*), round(sum(duration) / 3600, 2) FROM split_rows WHERE label = 'real' GROUP BY source
UNION ALL SELECT 'generator', generator, count(*), round(sum(duration) / 3600, 2) FROM split_rows WHERE generator <> '' GROUP BY generator
UNION ALL SELECT 'split', split || '/' || label, count(*), round(sum(duration) / 3600, 2) FROM split_rows GROUP BY split, label""")
def corpus_statistics(spark, d):
    return corpus.statistics(_split_rows(spark, d))


@query(f"{US} SELECT split, count(*) FILTER (label = 'real') AS n_real, count(*) FILTER (label = 'fake') AS n_fake, count(DISTINCT nullif(speaker, '')) AS n_speakers FROM split_rows GROUP BY split")
def split_report(spark, d):
    return corpus.split_report(_split_rows(spark, d))


@query(f"""{U} SELECT count(*) FILTER (label = 'real') AS n_real, count(DISTINCT speaker) FILTER (label = 'real' AND speaker <> '') AS n_speakers, count(*) FILTER (label = 'real' AND trim(text, ' ') <> '') AS n_text,
count(*) FILTER (label = 'real') >= 10 AND count(DISTINCT speaker) FILTER (label = 'real' AND speaker <> '') >= 3 AND count(*) FILTER (label = 'real' AND trim(text, ' ') <> '') >= 1 AS ready FROM utterances""")
def preflight(spark, d):
    return corpus.preflight(views.utterances(spark, d))


@query(f"""{U}, c AS (SELECT count(*) FILTER (label = 'real') AS n_real, count(*) FILTER (label = 'fake') AS n_fake, min(duration) AS shortest, round(avg(duration), 6) AS mean_duration, max(duration) AS longest,
count(*) FILTER (label = 'fake' AND ref_utt_id IN (SELECT utt_id FROM utterances WHERE label = 'real')) AS n_paired, count(*) FILTER (label = 'real' AND trim(text, ' ') = '') AS n_no_text FROM utterances)
SELECT *, greatest(n_real, n_fake) > 1.3 * least(n_real, n_fake) AS unbalanced FROM c""")
def corpus_profile(spark, d):
    return corpus.profile(views.utterances(spark, d))


@query(f"{U} SELECT count(*) FILTER (label = 'real') AS n_real, count(*) FILTER (label = 'fake') AS n_fake, round(CAST(count(*) FILTER (label = 'real') AS DOUBLE) / count(*) FILTER (label = 'fake'), 6) AS pos_weight FROM utterances")
def class_balance(spark, d):
    return _rounded(corpus.class_balance(views.utterances(spark, d)), "pos_weight")


@query(f"""{FE}, x AS (SELECT unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x FROM features WHERE split = 'train')
SELECT CAST(dim AS INTEGER) AS dim, round(avg(x), 6) AS mean, round(stddev_pop(x) + CAST(0.000001 AS DOUBLE), 6) AS std FROM x GROUP BY dim""")
def dimension_statistics(spark, d):
    return _rounded(features.dimension_stats(views.features(spark, d).where("split = 'train'")), "mean", "std")


@query(f"""{FE}, x AS (SELECT unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x FROM features WHERE split = 'train'), s AS (SELECT dim, avg(x) AS m, stddev_pop(x) + CAST(0.000001 AS DOUBLE) AS sd FROM x GROUP BY dim),
v AS (SELECT utt_id, unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x FROM features WHERE split = 'val') SELECT utt_id, round(sum(abs((x - m) / sd)), 4) AS size FROM v JOIN s USING (dim) GROUP BY utt_id""")
def standardised_vectors(spark, d):
    rows = views.features(spark, d)
    got = features.standardised(rows.where("split = 'val'"), features.dimension_stats(rows.where("split = 'train'")))
    return got.select("utt_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.abs(x)), 4).alias("size"))


@query(f"{U} SELECT generator, round(median(score), 6) AS median_score, count(*) AS n FROM utterances GROUP BY generator")
def median_scores(spark, d):
    return views.utterances(spark, d).groupBy("generator").agg(F.round(F.percentile("score", F.lit(0.5)), 6).alias("median_score"), F.count("*").alias("n"))


@query("""WITH c AS (SELECT conv_id AS key, turn AS chunk, CAST(length(text) % 101 AS DOUBLE) / 100 AS score FROM conversations)
SELECT key, round(avg(score), 6) AS score, array_to_string(list(CAST(CAST(score * 100 AS INTEGER) AS VARCHAR) ORDER BY chunk, score), ',') AS chunks, CASE WHEN avg(score) >= 0.5 THEN 'fake' ELSE 'real' END AS label FROM c GROUP BY key""")
def chunk_means(spark, d):
    from .operators.detect import decide

    rows = spark.read.parquet(f"{d}/conversations.parquet").select(F.col("conv_id").alias("key"), F.col("turn").alias("chunk"), ((F.length("text") % 101).cast("double") / 100).alias("score"))
    got = decide(rows, 0.5)
    return got.select("key", F.round("score", 6).alias("score"), F.array_join(F.transform("chunk_scores", lambda x: F.round(x * 100).cast("int").cast("string")), ",").alias("chunks"), "label")


@query(f"""{US}, v AS (SELECT speaker, split, count(*) AS n FROM split_rows WHERE speaker <> '' AND split IN ('train', 'test') GROUP BY ALL)
SELECT speaker, split AS hint FROM v QUALIFY row_number() OVER (PARTITION BY speaker ORDER BY n DESC, CASE split WHEN 'train' THEN 1 ELSE 3 END) = 1""")
def split_hints(spark, d):
    order = F.when(F.col("split") == "train", 1).otherwise(3)
    votes = _split_rows(spark, d).where("speaker <> '' and split <> ''").groupBy("speaker", "split").agg(F.count("*").alias("n"))
    return votes.groupBy("speaker").agg(F.max_by("split", F.struct("n", -order)).alias("hint"))


@query(f"{U} SELECT generator, count(*) AS n FROM utterances GROUP BY generator ORDER BY n DESC, generator LIMIT 3")
def top_generators(spark, d):
    return corpus.top_groups(views.utterances(spark, d), "generator", 3)


# ------------------------------------------------------------------ windows, orders


@query(f"{U} SELECT utt_id, speaker FROM utterances QUALIFY row_number() OVER (PARTITION BY speaker ORDER BY utt_id) <= 3")
def per_speaker_cap(spark, d):
    return corpus.per_speaker_cap(views.utterances(spark, d), 3).select("utt_id", "speaker")


@query("SELECT doc_id FROM (SELECT doc_id, coalesce(sum(1 + n_chars // 2000) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) WHERE before < 500")
def running_limit(spark, d):
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", (1 + F.floor(F.col("n_chars") / 2000)).alias("chunks"))
    return corpus.running_limit(rows, "chunks", 500, "doc_id").select("doc_id")


TARGETS = f"""pool AS (SELECT * FROM utterances WHERE label = 'real' AND augment = '' AND text <> '' AND {DWORDS} BETWEEN 6 AND 60),
rounds AS (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY utt_id) AS rnd, sha1(concat_ws({CH}, 'targets', 'eng_x', speaker)) AS h FROM pool),
targets AS (SELECT *, row_number() OVER (ORDER BY rnd, h, speaker) - 1 AS "at" FROM rounds ORDER BY rnd, h, speaker LIMIT 2000)"""


@query(f"""{U}, {TARGETS} SELECT utt_id, CAST("at" AS INTEGER) AS "at", 'v' || CAST("at" % 3 AS VARCHAR) AS voice FROM targets""")
def round_robin_targets(spark, d):
    return synthesis.targets(views.utterances(spark, d), 2000, "eng_x", 6, 60).select("utt_id", "at", F.concat(F.lit("v"), (F.col("at") % 3).cast("string")).alias("voice"))


REFS = f"""{U}, {TARGETS}, usable AS (SELECT speaker, utt_id AS ref, duration FROM utterances WHERE label = 'real' AND augment = '' AND trim(text, ' ') <> '' AND duration BETWEEN 3 AND 25),
asked AS (SELECT utt_id, speaker, source, text, "at", CAST(('0x' || substr(sha1(concat_ws({CH}, 'ref-variant', utt_id)), 1, 8))::BIGINT % 4 AS INTEGER) AS variant FROM targets),
pairs AS (SELECT a.utt_id, u.ref, u.duration, sha1(concat_ws({CH}, 'ref', a.speaker, CAST(a.variant AS VARCHAR), u.ref)) AS h FROM asked a JOIN usable u ON u.speaker = a.speaker AND u.ref <> a.utt_id),
run AS (SELECT *, coalesce(sum(duration + CAST(0.3 AS DOUBLE)) OVER (PARTITION BY utt_id ORDER BY h, ref ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CAST(0.3 AS DOUBLE)) - CAST(0.3 AS DOUBLE) AS before FROM pairs),
refs AS (SELECT utt_id, string_agg(ref, ',' ORDER BY h, ref) AS refs, round(sum(duration) + CAST(0.3 AS DOUBLE) * (count(*) - 1), 6) AS seconds FROM run WHERE before < 12 - 1e-9 GROUP BY utt_id)"""


@query(f"{REFS} SELECT utt_id, refs, seconds FROM refs")
def packed_references(spark, d):
    rows = views.utterances(spark, d)
    got = synthesis.references(rows, synthesis.targets(rows, 2000, "eng_x", 6, 60))
    return got.select("utt_id", F.array_join("refs", ",").alias("refs"), F.round("seconds", 6).alias("seconds"))


@query(f"""{REFS}, p AS (SELECT asked.*, 'v' || CAST("at" % 2 AS VARCHAR) AS voice, refs FROM asked JOIN refs USING (utt_id))
SELECT 'eng_x-' || substr(sha1(concat_ws({CH}, 'eng_x', speaker, utt_id || '|' || voice)), 1, 12) AS utt_id, utt_id AS ref_utt_id, voice, 'eng_x:' || voice AS generator, refs FROM p""")
def synthesis_plan(spark, d):
    got = synthesis.plan(views.utterances(spark, d), "eng_x", ["v0", "v1"], 2000, clone=True, least=6, most=60)
    return got.select("utt_id", "ref_utt_id", "voice", "generator", F.array_join("refs", ",").alias("refs"))


# the same with clips of up to 25 s, of which one that doesn't fit is passed over: a target's candidates are gone through in order
LONG = f"""WITH RECURSIVE every_length AS ({views.in_duckdb(views.UTTERANCES)}), utterances AS (SELECT * REPLACE (duration * CAST(2.5 AS DOUBLE) AS duration) FROM every_length),
{REFS.removeprefix(U + ', ').split('run AS', 1)[0]}
ranked AS (SELECT utt_id, ref, duration, row_number() OVER (PARTITION BY utt_id ORDER BY h, ref) AS i FROM pairs),
walk AS (SELECT utt_id, 0 AS i, CAST(0 AS DOUBLE) AS seconds, CAST([] AS VARCHAR[]) AS refs FROM (SELECT DISTINCT utt_id FROM ranked) UNION ALL
  SELECT w.utt_id, w.i + 1, CASE WHEN skip THEN seconds ELSE seconds + more END, CASE WHEN skip THEN refs ELSE list_append(refs, ref) END
  FROM (SELECT w.*, r.ref, r.duration + CASE WHEN len(refs) > 0 THEN CAST(0.3 AS DOUBLE) ELSE 0 END AS more, len(refs) > 0 AND seconds + (r.duration + CASE WHEN len(refs) > 0 THEN CAST(0.3 AS DOUBLE) ELSE 0 END) > 25 AS skip
        FROM walk w JOIN ranked r ON r.utt_id = w.utt_id AND r.i = w.i + 1 WHERE w.seconds < 12) w)
SELECT utt_id, array_to_string(arg_max(refs, i), ',') AS refs, round(arg_max(seconds, i), 6) AS seconds FROM walk GROUP BY utt_id HAVING len(arg_max(refs, i)) > 0"""


@query(LONG)
def long_references(spark, d):
    rows = views.utterances(spark, d).withColumn("duration", F.col("duration") * 2.5)
    got = synthesis.references(rows, synthesis.targets(rows, 2000, "eng_x", 6, 60))
    return got.select("utt_id", F.array_join("refs", ",").alias("refs"), F.round("seconds", 6).alias("seconds"))


@query(f"""{REFS}, one AS (SELECT r.utt_id, r.h, r.ref, u.text, CAST(floor(u.duration * 10) AS BIGINT) AS samples FROM run r JOIN utterances u ON u.utt_id = r.ref WHERE before < 12 - 1e-9)
SELECT utt_id, CASE WHEN count(*) = 1 THEN min(text) ELSE string_agg(CASE WHEN regexp_matches(trim(text, ' '), '[.!?…,;:]$') THEN trim(text, ' ') ELSE trim(text, ' ') || '.' END, ' ' ORDER BY h, ref) END AS ref_text,
CAST(sum(samples) + 3 * (count(*) - 1) AS INTEGER) AS n_samples FROM one GROUP BY utt_id""")
def reference_texts(spark, d):
    """A clip has ten samples a second here, so a gap has three."""
    rows = views.utterances(spark, d)
    clips = rows.select("utt_id", F.array_repeat("score", F.floor(F.col("duration") * 10).cast("int")).alias("signal"))
    chosen = synthesis.references(rows, synthesis.targets(rows, 2000, "eng_x", 6, 60))
    got = synthesis.reference_audio(chosen, clips, rows, SPEC10)
    return got.select("utt_id", "ref_text", F.size("ref_signal").alias("n_samples"))


@query(f"""{REFS}, p AS (SELECT asked.*, refs, seconds FROM asked LEFT JOIN refs USING (utt_id))
SELECT count(*) FILTER ("at" < 300) AS skip_exists, count(*) FILTER ("at" >= 300 AND refs IS NULL) AS skip_no_reference, count(*) FILTER ("at" >= 300 AND refs IS NOT NULL) AS todo, round(avg(seconds) FILTER ("at" >= 300), 6) AS mean_reference FROM p""")
def generation_counters(spark, d):
    """What becomes of the targets of a cloning engine that has made the first 300 already."""
    rows = views.utterances(spark, d)
    options = dict(least=6, most=60)
    made = synthesis.plan_all(rows, "eng_x", ["v0", "v1"], 2000, **options).where("at < 300").select("utt_id")  # ids don't depend on references
    made = held(made)  # the manifest is read in many places, and this plan would be made in each
    got = synthesis.plan_all(rows.unionByName(made, allowMissingColumns=True), "eng_x", ["v0", "v1"], 2000, clone=True, **options)
    mean = F.round(F.avg(F.when(F.col("status") == "todo", F.col("seconds"))), 6).alias("mean_reference")
    return got.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("skip_exists", "skip_no_reference", "todo")), mean)


@query(f"{U} SELECT utt_id, generator FROM utterances WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY generator ORDER BY sha1(concat_ws({CH}, '7', utt_id)), utt_id) <= 15")
def seeded_sample(spark, d):
    return corpus.seeded_sample(views.utterances(spark, d).where("text <> ''"), "generator", 15, 7).select("utt_id", "generator")


@query(f"{U}, q AS (SELECT count(*) FILTER (label = 'real') AS n FROM utterances) SELECT n, greatest(1, CAST(floor(n * CAST(0.5 AS DOUBLE) / 3) AS BIGINT)) AS quota FROM q")
def engine_quota(spark, d):
    n = views.utterances(spark, d).agg(F.count_if(F.col("label") == "real").alias("n"))
    return n.select("n", synthesis.quota(F.col("n"), 0.5, 3).alias("quota"))


# ------------------------------------------------------------------ splits

ASSIGNED = f"""{U}, spk AS (SELECT DISTINCT speaker FROM utterances WHERE speaker <> ''),
rs AS (SELECT speaker, row_number() OVER (ORDER BY sha1(concat_ws({CH}, '42', speaker)), speaker) - 1 AS i, count(*) OVER () AS n FROM spk),
hs AS (SELECT utt_id, row_number() OVER (ORDER BY sha1(concat_ws({CH}, 'homeless-42', utt_id)), utt_id) - 1 AS i, count(*) OVER () AS n FROM utterances WHERE speaker = '' AND augment = ''),
s1 AS (SELECT speaker, CASE WHEN i < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN i < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM rs),
s2 AS (SELECT utt_id, CASE WHEN i < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN i < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM hs),
assigned AS (SELECT u.utt_id, u.speaker, u.label, u.generator, u.ref_utt_id, CASE WHEN u.label = 'fake' AND lower(split_part(u.generator, ':', 1)) = 'eng_b' THEN 'test' ELSE coalesce(s1.split, s2.split, 'train') END AS split
 FROM utterances u LEFT JOIN s1 ON s1.speaker = u.speaker LEFT JOIN s2 ON s2.utt_id = CASE WHEN u.parent_utt_id <> '' THEN u.parent_utt_id ELSE u.utt_id END)"""


def _assigned(spark, d):
    return splits.assign(views.utterances(spark, d), holdout=("ENG_B",))


@query(f"{ASSIGNED} SELECT utt_id, split FROM assigned")
def assigned_splits(spark, d):
    return _assigned(spark, d).select("utt_id", "split")


@query(f"""{ASSIGNED}, w AS (SELECT speaker, split, min(CASE WHEN split_part(generator, ':', 1) = 'eng_b' THEN 1 ELSE 0 END) AS held FROM assigned WHERE speaker <> '' GROUP BY ALL)
SELECT a.speaker, a.split AS split_a, b.split AS split_b, CASE WHEN a.held + b.held > 0 THEN 'holdout' ELSE 'true_leak' END AS cause FROM w a JOIN w b ON a.speaker = b.speaker AND a.split < b.split""")
def split_leaks(spark, d):
    return splits.leaks(_assigned(spark, d), ("eng_b",))


# ------------------------------------------------------------------ signals

FINITE = "list_transform(signal, lambda x: CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN CAST(0 AS DOUBLE) ELSE x END)"


@query(f"""{SG}, r AS (SELECT utt_id, signal, sqrt(list_sum(list_transform(signal, lambda x: x * x)) / len(signal)) AS loud, list_max(list_transform(signal, lambda x: abs(x))) AS top FROM signals),
g AS (SELECT *, CASE WHEN loud > 1e-8 THEN pow(CAST(10 AS DOUBLE), CAST(-23 AS DOUBLE) / 20) / loud ELSE 1 END AS g, pow(CAST(10 AS DOUBLE), CAST(-1 AS DOUBLE) / 20) AS ceiling FROM r),
s AS (SELECT *, CASE WHEN top * g > ceiling THEN g * ceiling / (top * g) ELSE g END AS scale FROM g)
SELECT utt_id, round(list_sum(list_transform(signal, lambda x: abs(greatest(-1, least(1, x * scale))))), 5) AS total, round(list_max(list_transform(signal, lambda x: abs(x * scale))), 6) AS peak FROM s""")
def levelled_signals(spark, d):
    own = signal.levelled(signal.sanitized(F.col("signal")))
    return views.signals(spark, d).select("utt_id", own.alias("s")).select("utt_id", F.round(F.aggregate("s", F.lit(0.0), lambda a, x: a + F.abs(x)), 5).alias("total"), F.round(signal.peak(F.col("s")), 6).alias("peak"))


@query(f"""{SG}, n AS (SELECT utt_id, list_concat(list_concat(signal, signal), signal) AS s FROM signals), k AS (SELECT utt_id, s, unnest(range(0, len(s), 100)) AS a FROM n WHERE len(s) > 100 UNION ALL SELECT utt_id, s, 0 FROM n WHERE len(s) BETWEEN 30 AND 100)
SELECT utt_id, CAST(a // 100 AS INTEGER) AS chunk, CAST(least(100, len(s) - a) AS INTEGER) AS samples, round(list_sum(list_slice(s, a + 1, a + 100)), 5) AS total FROM k WHERE least(100, len(s) - a) >= 30""")
def signal_chunks(spark, d):
    three = F.concat("signal", "signal", "signal")
    rows = views.signals(spark, d).select("utt_id", F.posexplode(signal.chunks(three, SPEC10)).alias("chunk", "s"))
    return rows.select("utt_id", "chunk", F.size("s").alias("samples"), F.round(F.aggregate("s", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


@query(f"""{SG}, q AS (SELECT utt_id, len(signal) AS n, sqrt(list_sum(list_transform(signal, lambda x: x * x)) / len(signal)) AS loud, CAST(len(list_filter(signal, lambda x: abs(x) >= 0.9)) AS DOUBLE) / len(signal) AS clipped FROM signals)
SELECT utt_id, concat_ws(',', CASE WHEN CAST(n AS DOUBLE) / 10 < 6 - 0.001 THEN 'too_short' END, CASE WHEN CAST(n AS DOUBLE) / 10 > 8 + 0.001 THEN 'too_long' END, CASE WHEN clipped > 0.001 THEN 'clipping' END, CASE WHEN loud < 0.00001 THEN 'silent' END) AS issues FROM q""")
def signal_quality(spark, d):
    spec = signal.AudioSpec(sample_rate=10, min_seconds=6.0, max_seconds=8.0, clipping_threshold=0.9)
    return views.signals(spark, d).select("utt_id", F.array_join(signal.quality(F.col("signal"), spec), ",").alias("issues"))


CHANCES = {"gain": 0.5, "reverb": 0.3, "speed_perturb": 0.4}


def _draw(op: str, what: str) -> str:
    return f"sha1(concat_ws({CH}, '42', utt_id, CAST(copy AS VARCHAR), '{op}', '{what}'))"


@query(f"""{US}, rows AS (SELECT utt_id, unnest([0, 1]) AS copy FROM split_rows WHERE augment = '' AND split IN ('', 'train')),
drawn AS (""" + " UNION ALL ".join(f"SELECT utt_id, copy, '{op}' AS op, {_draw(op, 'order')} AS h FROM rows WHERE CAST(('0x' || substr({_draw(op, 'draw')}, 1, 8))::BIGINT AS DOUBLE) / 4294967296 < {p}" for op, p in CHANCES.items()) + """),
best AS (SELECT * FROM drawn QUALIFY row_number() OVER (PARTITION BY utt_id, copy ORDER BY h) <= 2)
SELECT rows.utt_id, rows.copy, coalesce(string_agg(op, '+' ORDER BY h), '') AS ops FROM rows LEFT JOIN best USING (utt_id, copy) GROUP BY ALL""")
def augmentation_plan(spark, d):
    got = augment.chain(corpus.augmentable(_split_rows(spark, d)), CHANCES, copies=2)
    return got.select("utt_id", "copy", F.array_join("ops", "+").alias("ops"))


# ------------------------------------------------------------------ features

FRAMES = "f AS (SELECT utt_id, list_transform(range(8), lambda i: list_slice(embedding, i * 8 + 1, i * 8 + 8)) AS frames FROM features), d AS (SELECT utt_id, unnest(range(8)) AS dim, frames FROM f), x AS (SELECT utt_id, dim, list_transform(frames, lambda v: CAST(v[dim + 1] AS DOUBLE)) AS v FROM d)"


@query(f"{FE}, {FRAMES} SELECT utt_id, CAST(dim AS INTEGER) AS dim, round(list_avg(v), 6) AS mean, round(list_stddev_pop(v), 5) AS std, round(list_max(v), 6) AS top FROM x")
def pooled_frames(spark, d):
    frames = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8))
    rows = views.features(spark, d).select("utt_id", frames.alias("f"))
    both, top = features.pooled(F.col("f"), "mean_std"), features.pooled(F.col("f"), "max")
    one = rows.select("utt_id", F.posexplode(F.arrays_zip(F.slice(both, 1, 8).alias("mean"), F.slice(both, 9, 8).alias("std"), top.alias("top"))).alias("dim", "x"))
    return one.select("utt_id", "dim", F.round("x.mean", 6).alias("mean"), F.round("x.std", 5).alias("std"), F.round("x.top", 6).alias("top"))


COS = "list_sum(list_transform(list_zip({0}, {1}), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))"


def _cos(a: str, b: str) -> str:
    return f"{COS.format(a, b)} / sqrt({COS.format(a, a)} * {COS.format(b, b)})"


SAME = f"""few AS (SELECT * FROM features WHERE label = 'real' QUALIFY row_number() OVER (PARTITION BY speaker ORDER BY utt_id) <= 4),
same AS (SELECT a.utt_id AS a, b.utt_id AS b, {_cos('a.embedding', 'b.embedding')} AS similarity FROM few a JOIN few b ON a.speaker = b.speaker AND a.utt_id < b.utt_id),
one AS (SELECT * FROM features WHERE label = 'real' QUALIFY row_number() OVER (PARTITION BY speaker ORDER BY utt_id) = 1),
cross_ AS (SELECT a.utt_id AS a, b.utt_id AS b, {_cos('a.embedding', 'b.embedding')} AS similarity FROM one a JOIN one b ON a.speaker < b.speaker),
fakes AS (SELECT generator, {_cos('f.embedding', 'r.embedding')} AS similarity FROM (SELECT *, CAST(substr(speaker, 5) AS INTEGER) - 5 AS k FROM features WHERE label = 'fake') f JOIN (SELECT CAST(substr(speaker, 5) AS INTEGER) AS k, embedding FROM one) r USING (k))"""


@query(f"{FE}, {SAME} SELECT 'same' AS kind, a, b, round(similarity, 6) AS similarity FROM same UNION ALL SELECT 'cross', a, b, round(similarity, 6) FROM cross_")
def similarity_pairs(spark, d):
    rows = views.features(spark, d)
    both = features.same_speaker_pairs(rows).withColumn("kind", F.lit("same")).unionByName(features.cross_speaker_pairs(rows).withColumn("kind", F.lit("cross")))
    return both.select("kind", "a", "b", F.round("similarity", 6).alias("similarity"))


@query(f"""{FE}, {SAME}, g AS (SELECT '(ceiling)' AS grp, similarity FROM same UNION ALL SELECT '(floor)', similarity FROM cross_ UNION ALL SELECT generator, similarity FROM fakes),
m AS (SELECT grp, count(*) AS n, median(similarity) AS s FROM g GROUP BY grp), e AS (SELECT max(s) FILTER (grp = '(ceiling)') AS c, max(s) FILTER (grp = '(floor)') AS f FROM m)
SELECT grp, n, round(s, 6) AS similarity, CASE WHEN grp LIKE '(%' THEN '' WHEN s >= c - 0.05 THEN 'keep' WHEN s <= f + 0.05 THEN 'other' ELSE 'between' END AS verdict FROM m, e""")
def identity_audit(spark, d):
    rows = views.features(spark, d)
    one = rows.where("label = 'real'").groupBy("speaker").agg(F.min_by("embedding", "utt_id").alias("r")).select(F.substring("speaker", 5, 9).cast("int").alias("k"), "r")
    fakes = rows.where("label = 'fake'").withColumn("k", F.substring("speaker", 5, 9).cast("int") - 5).join(one, "k").select("generator", features.cosine(F.col("embedding"), F.col("r")).alias("similarity"))
    return _rounded(features.identity_audit(rows, fakes), "similarity")


@query(f"""{WER}, p AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS utt_id, CASE WHEN turn % 4 = 0 THEN '(real)' ELSE 'eng_' || CAST(conv_id % 3 AS VARCHAR) END AS grp, CAST(d AS DOUBLE) / n AS wer FROM s WHERE n > 0),
f AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY grp ORDER BY sha1(concat_ws({CH}, '42', utt_id)), utt_id) <= CASE WHEN grp = '(real)' THEN 20 ELSE 15 END),
m AS (SELECT grp, count(*) AS n, median(wer) AS w FROM f GROUP BY grp), worst AS (SELECT grp, utt_id AS worst FROM f QUALIFY row_number() OVER (PARTITION BY grp ORDER BY wer DESC, utt_id DESC) = 1), e AS (SELECT max(w) FILTER (grp = '(real)') AS fl FROM m)
SELECT grp, n, round(w, 6) AS wer, worst, CASE WHEN grp = '(real)' OR fl IS NULL THEN CASE WHEN grp = '(real)' THEN '' ELSE 'poor' END WHEN w - fl <= 0.1 THEN 'good' WHEN w - fl <= 0.3 THEN 'fair' ELSE 'poor' END AS verdict FROM m JOIN worst USING (grp), e""")
def pronunciation_audit(spark, d):
    return _rounded(features.pronunciation_audit(_spoken(spark, d)), "wer")


def _spoken(spark, d):
    grp = F.when(F.col("turn") % 4 == 0, "(real)").otherwise(F.concat(F.lit("eng_"), (F.col("conv_id") % 3).cast("string")))
    return views.hypotheses(spark, d).select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("utt_id"), grp.alias("grp"), "ref_text", "hyp_text")


@query(f"""{WER}, p AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS utt_id, CASE WHEN turn % 4 = 0 THEN '(real)' ELSE 'eng_' || CAST(conv_id % 3 AS VARCHAR) END AS grp, CAST(d AS DOUBLE) / n AS wer FROM s WHERE n > 0),
f AS (SELECT * FROM p WHERE grp <> '(real)' QUALIFY row_number() OVER (PARTITION BY grp ORDER BY sha1(concat_ws({CH}, '42', utt_id)), utt_id) <= 15)
SELECT grp, utt_id, round(wer, 6) AS wer FROM f ORDER BY f.wer DESC, utt_id DESC LIMIT 1""")
def worst_pronunciation(spark, d):
    return _rounded(features.worst_sample(features.rated_sample(_spoken(spark, d))), "wer")


# the names under which whole texts were rated while the two above rated their first words
word_error_rates_whole, pronunciation_audit_whole = word_error_rates, pronunciation_audit
for _name in ("word_error_rates", "pronunciation_audit"):
    QUERIES[f"{_name}_whole"], ORACLE[f"{_name}_whole"] = QUERIES[_name], ORACLE[_name]


# one speaker for each of 97 sets of vectors: more than twice as many as the partners asked for
@query(f"""{FE}, set_ AS (SELECT 'v' || CAST(CAST(substr(utt_id, 5) AS BIGINT) % 97 AS VARCHAR) AS speaker, utt_id, embedding FROM features),
one AS (SELECT * FROM set_ QUALIFY row_number() OVER (PARTITION BY speaker ORDER BY utt_id) = 1),
p AS (SELECT *, row_number() OVER (ORDER BY sha1(speaker)) - 1 AS at, count(*) OVER () AS n FROM one),
d AS (SELECT a.speaker < b.speaker AS f, a.utt_id AS ua, b.utt_id AS ub, {_cos('a.embedding', 'b.embedding')} AS s FROM p a JOIN p b ON (b.at - a.at + a.n) % a.n BETWEEN 1 AND least(20, a.n // 2) AND (((b.at - a.at + a.n) % a.n) * 2 <> a.n OR a.at < b.at))
SELECT CASE WHEN f THEN ua ELSE ub END AS a, CASE WHEN f THEN ub ELSE ua END AS b, round(s, 6) AS similarity FROM d""")
def speaker_circle(spark, d):
    set_ = F.concat(F.lit("v"), (F.substring("utt_id", 5, 20).cast("long") % 97).cast("string"))
    rows = views.features(spark, d).withColumns({"speaker": set_, "label": F.lit("real")})
    return _rounded(features.cross_speaker_pairs(rows, partners=20), "similarity")


# ------------------------------------------------------------------ rows that a head is fitted on

TR = "t AS (SELECT utt_id, CAST(CASE WHEN label = 'fake' THEN 1 ELSE 0 END AS DOUBLE) AS y, embedding FROM features WHERE split = 'train' AND embedding IS NOT NULL), c AS (SELECT count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1 FROM t)"


@query(f"{FE}, {TR} SELECT utt_id, y, round(CASE WHEN y = 1 THEN CAST(n0 AS DOUBLE) / n1 ELSE 1 END, 6) AS weight FROM t, c")
def training_weights(spark, d):
    rows = views.features(spark, d)
    return _rounded(model.balanced(model.training_rows(rows, rows, "train"), "linear", 42).select("utt_id", "y", "weight"), "weight")


@query(f"""{FE}, {TR}, r AS (SELECT *, CASE WHEN n0 < n1 OR n0 = n1 AND y = 0 THEN 0 ELSE 1 END AS few, CAST(greatest(n0, n1) AS DOUBLE) / least(n0, n1) AS ratio FROM t, c)
SELECT utt_id, y, CASE WHEN n0 <> n1 AND y = few THEN CAST(floor(ratio) AS BIGINT) + CASE WHEN CAST('0x' || substr(sha1(concat_ws({CH}, '42', utt_id)), 1, 8) AS BIGINT) / 4294967296.0 < ratio - floor(ratio) THEN 1 ELSE 0 END ELSE 1 END AS n FROM r""")
def oversampled_rows(spark, d):
    rows = views.features(spark, d)
    return model.balanced(model.training_rows(rows, rows, "train"), "mlp", 42).groupBy("utt_id", "y").agg(F.count("*").alias("n"))


@query(f"""{FE}, v AS (SELECT utt_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM features), m AS (SELECT utt_id, e, list_avg(e) AS a, list_var_pop(e) AS q FROM v)
SELECT utt_id, round(e[1], 5) AS x, round((e[1] - a) / sqrt(q + 1e-5), 5) AS first, round((e[len(e)] - a) / sqrt(q + 1e-5), 5) AS last, round(list_max(list_transform(e, lambda x: (x - a) / sqrt(q + 1e-5))), 5) AS top FROM m""")
def layer_normalised(spark, d):
    got = views.features(spark, d).select("utt_id", F.col("embedding")[0].cast("double").alias("x"), model.layer_norm(F.transform("embedding", lambda x: x.cast("double"))).alias("e"))
    return got.select("utt_id", F.round("x", 5).alias("x"), F.round(F.col("e")[0], 5).alias("first"), F.round(F.element_at("e", -1), 5).alias("last"), F.round(F.array_max("e"), 5).alias("top"))


# ------------------------------------------------------------------ ingest's decisions, with clips counted from the texts' lengths

FILES = """seen AS (SELECT key, speaker, row_number() OVER (ORDER BY key) - 1 AS "at", label = 'fake' AS exists_, n_chars < 60 AS no_audio_, CASE WHEN n_chars < 60 THEN 0 ELSE n_chars // 300 END AS n_clips FROM source_items),
f AS (SELECT *, coalesce(sum(CASE WHEN exists_ OR n_clips > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY speaker ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 3 AS full_ FROM seen),
s AS (SELECT *, CASE WHEN full_ THEN 'skip_speaker_full' WHEN exists_ THEN 'skip_exists' WHEN n_clips > 0 THEN 'kept' WHEN no_audio_ THEN 'skip_no_audio' ELSE 'drop_invalid' END AS status FROM f),
k AS (SELECT *, coalesce(sum(CASE WHEN status = 'kept' THEN n_clips ELSE 0 END) OVER (ORDER BY "at" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)"""


@query(f"{SI}, {FILES} SELECT key, speaker, \"at\", CAST(n_clips AS BIGINT) AS n_clips, CASE WHEN before < 500 THEN status END AS status FROM k")
def ingest_decisions(spark, d):
    return ingest.statuses_in_order(_seen(spark, d), 500, 3).select("key", "speaker", "at", "n_clips", "status")


@query(f"""{SI}, {FILES} SELECT {', '.join(f"CAST(coalesce(sum(CASE WHEN status = 'kept' THEN n_clips ELSE 1 END) FILTER (status = '{c}'), 0) AS BIGINT) AS {c}" for c in ingest.COUNTERS)}, count(DISTINCT speaker) FILTER (status = 'kept') AS n_speakers,
count(*) FILTER (status = 'kept') > 0 AND count(DISTINCT speaker) FILTER (status = 'kept') < 3 AS few_speakers, count(*) FILTER (status = 'skip_speaker_full') > 10 * greatest(coalesce(sum(n_clips) FILTER (status = 'kept'), 0), 1) AS tight_cap FROM k""")
def ingest_counters(spark, d):
    judged = held(ingest.statuses_in_order(_seen(spark, d), None, 3))
    return ingest.ingest_report(judged.where("status = 'kept'"), ingest.counted(judged))


def _seen(spark, d):
    rows = views.source_items(spark, d).select("key", "speaker", (F.col("label") == "fake").alias("exists_"), (F.col("n_chars") < 60).alias("no_audio_"), F.when(F.col("n_chars") < 60, 0).otherwise(F.floor(F.col("n_chars") / 300)).cast("long").alias("n_clips"))
    return metrics.prefix_sums(rows.withColumn("one_", F.lit(1).cast("long")), "key", ["one_"], descending=False).withColumn("at", F.col("cum_one_") - 1).drop("one_", "cum_one_")


@query(f"{U} SELECT utt_id, CASE WHEN duration <= 4 THEN 'missing' WHEN duration > 9 THEN 'unreadable' ELSE 'ok' END AS status FROM utterances")
def file_statuses(spark, d):
    rows = views.utterances(spark, d).withColumn("path", F.concat("utt_id", F.lit(".wav")))
    decoded = rows.select(F.col("path").alias("key"), F.when(F.col("duration") > 9, "no audio").alias("error"))
    return ingest.file_status(rows, rows.where("duration > 4").select(F.col("path").alias("rel")), decoded)


# ------------------------------------------------------------------ kernels: no SQL; tests hold them against plain code


def without_sql(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@without_sql
def band_embeddings(spark, d):
    got = features.embed(views.signals(spark, d), rate=10)
    return got.select("utt_id", F.size("embedding").alias("width"), F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))
