"""Ingest: source items to manifest rows and clips."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import audio_path, utterance_id
from ..operators.metrics import prefix_sums
from ..operators.signal import NO_AUDIO, SPEC, AudioSpec, encode_wav, normalise
from ..schema import conformed
from ..tables import held

COUNTERS = ("kept", "drop_invalid", "skip_exists", "skip_no_audio", "skip_speaker_full")
#: Fewer speakers can't be split three ways; so many times more files over the cap than clips kept: the cap is too tight.
FEW_SPEAKERS, TIGHT_CAP = 3, 10


def statuses_in_order(seen: DataFrame, limit: int | None, per_speaker: int | None) -> DataFrame:
    """seen: key, speaker, at (place in the source's order), exists_, no_audio_, n_clips (null: not decoded). With the
    status of each file as if they had come one after another: null from where the limit was reached."""
    there = F.col("exists_") | (F.coalesce("n_clips", F.lit(0)) > 0)
    rows = seen.withColumn("counts_", there.cast("long"))
    if per_speaker is None:
        rows = rows.withColumn("full_", F.lit(False))
    else:
        rows = prefix_sums(rows, "at", ["counts_"], descending=False, by=["speaker"])
        rows = rows.withColumn("full_", F.col("cum_counts_") - F.col("counts_") >= per_speaker).drop("cum_counts_")
    status = F.when(F.col("full_"), "skip_speaker_full").when(F.col("exists_"), "skip_exists").when(F.coalesce("n_clips", F.lit(0)) > 0, "kept").when(F.col("no_audio_"), "skip_no_audio").otherwise("drop_invalid")
    rows = rows.withColumn("status", status)
    if limit is None:
        return rows.drop("counts_", "full_")
    rows = prefix_sums(rows.withColumn("new_", F.when(F.col("status") == "kept", F.col("n_clips")).otherwise(F.lit(0))), "at", ["new_"], descending=False)
    return rows.withColumn("status", F.when(F.col("cum_new_") - F.col("new_") < limit, F.col("status"))).drop("counts_", "full_", "new_", "cum_new_")


def ingest(items: DataFrame, manifest: DataFrame, source: str, limit: int | None = None, per_speaker: int | None = None, overwrite: bool = False, language: str = "vi", spec: AudioSpec = SPEC) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, clips, counters) as if files came one after another in the order of their keys: one is taken if fewer than
    `limit` clips have been kept before it and fewer than per_speaker files of its speaker are there already or have
    been kept. Counters: clips kept, and files for each reason to leave one out, up to where the limit was reached.

    Decoding stops early. Files are placed by a prefix sum over the keys, without their contents; then, wave by wave,
    those that may still be taken are decoded: as many as the limit lacks clips (a usable file has one at least), or
    as the clips so far say it takes; of each speaker as many as the cap lacks. What is decoded is held, so no file is
    decoded twice, and a lost executor costs no wave. Keys are distinct within a source; existing files aren't decoded."""
    ids = items.withColumn("utt_id", utterance_id(F.lit(source), F.col("speaker"), F.col("key")))
    known = manifest.select("utt_id").withColumn("exists_", F.lit(True))
    marked = ids.select("key", F.coalesce("speaker", F.lit("")).alias("speaker"), "utt_id").join(known, "utt_id", "left").select("key", "speaker", (F.coalesce("exists_", F.lit(False)) & F.lit(not overwrite)).alias("exists_"))
    order = held(prefix_sums(marked.withColumn("one_", F.lit(1).cast("long")), "key", ["one_"], descending=False).withColumn("at", F.col("cum_one_") - 1).drop("one_", "cum_one_"))
    if per_speaker is not None:
        nth = prefix_sums(order.withColumn("one_", F.lit(1).cast("long")), "at", ["one_"], descending=False, by=["speaker"])
        order = held(nth.withColumn("nth_", F.col("cum_one_") - 1).drop("one_", "cum_one_"))
    total, end, wave, clips, facts, front = order.count(), 0, 0, [], None, None
    while True:
        known = order.where(F.col("at") < end)
        known = known.join(facts, "key", "left") if facts is not None else known.withColumns({"n_clips": F.lit(None).cast("long"), "no_audio_": F.lit(False)})
        if per_speaker is not None and end:
            # of each speaker the files up to its front are decoded; it moves on by what they lack
            there = F.col("exists_") | (F.coalesce("n_clips", F.lit(0)) > 0)
            if front is None:
                front = held(order.select("speaker").distinct().withColumn("upto_", F.lit(per_speaker - 1).cast("long")))
            elif wave:
                lacks = known.join(front, "speaker").groupBy("speaker", "upto_").agg((per_speaker - F.count_if(there & (F.col("nth_") <= F.col("upto_")))).alias("short_"), F.max("nth_").alias("last_"))
                moved = F.when((F.col("last_") > F.col("upto_")) & (F.col("short_") > 0), F.col("upto_") + F.col("short_") * (1 << min(wave, 20))).otherwise(F.col("upto_"))
                front = held(front.join(lacks.select("speaker", moved.alias("moved_")), "speaker", "left").select("speaker", F.coalesce("moved_", "upto_").alias("upto_")))
            known = known.join(front, "speaker").where("nth_ <= upto_")
        todo = known.where(~F.col("exists_") & F.col("n_clips").isNull())
        todo = todo.select("key") if end else todo.select("key").limit(0)
        part = held(normalise(items.join(todo, "key"), spec)) if end and not todo.isEmpty() else None
        if part is not None:
            clips.append(part.where("error is null"))
            usable = part.groupBy("key").agg(F.count_if(F.col("error").isNull()).cast("long").alias("n_clips"), F.bool_and(F.coalesce(F.col("error") == NO_AUDIO, F.lit(False))).alias("no_audio_"))
            facts = held(usable) if facts is None else held(facts.union(usable))
            wave += 1
            if per_speaker is not None:
                continue  # a speaker may still lack files within the same places
        seen = order.where(F.col("at") < end)
        seen = seen.join(facts, "key", "left") if facts is not None else seen.withColumns({"n_clips": F.lit(None).cast("long"), "no_audio_": F.lit(False)})
        judged = held(statuses_in_order(seen, limit, per_speaker))
        kept, looked = judged.agg(F.coalesce(F.sum(F.when(F.col("status") == "kept", F.col("n_clips"))), F.lit(0)), F.count("*")).head()
        if end >= total or (limit is not None and kept >= limit):
            break
        # as many further files as the limit lacks clips, by what the files so far have given
        more = total if limit is None else math.ceil((limit - kept) * max(1.0, looked / kept)) if kept else max(limit, 4 * looked)
        end, wave = min(total, end + max(1, more)), 0
    chosen = judged.where("status = 'kept'").select("key")
    made = reduce(DataFrame.union, clips) if clips else normalise(items.limit(0), spec)
    made = made.join(chosen, "key").join(items.drop("content", "path"), "key")
    made = made.withColumn("utt_id", utterance_id(F.lit(source), F.col("speaker"), F.col("key"), F.col("chunk")))
    label = F.col("label") if "label" in items.columns else F.lit("real")
    generator = F.col("generator") if "generator" in items.columns else F.lit("")
    split = F.col("split_hint") if "split_hint" in items.columns else F.lit("")
    rows = made.select("utt_id", label.alias("label"), F.lit(source).alias("source"), "speaker", "text", generator.alias("generator"), F.lit(language).alias("language"), F.round(F.size("signal") / spec.sample_rate, 3).alias("duration"), F.lit(spec.sample_rate).alias("sample_rate"), split.alias("split"))
    rows = conformed(rows.withColumn("path", audio_path(F.col("utt_id"), F.col("label"), F.col("source"), F.col("speaker"), F.col("generator"), F.lit(""))))
    return rows, made.select("utt_id", "signal"), counted(judged)


def counted(judged: DataFrame) -> DataFrame:
    """One row, the counters of statuses_in_order(): clips kept, and files of each other status."""
    n = F.when(F.col("status") == "kept", F.col("n_clips")).otherwise(1)
    return judged.agg(*(F.coalesce(F.sum(F.when(F.col("status") == c, n)), F.lit(0)).alias(c) for c in COUNTERS))


def ingest_report(rows: DataFrame, counters: DataFrame) -> DataFrame:
    """One row: the counters, n_speakers among the rows, few_speakers (some rows, but fewer than three speakers: no
    split without leaks) and tight_cap (more than ten times as many files over the cap as clips kept)."""
    n = rows.agg(F.count_distinct("speaker").alias("n_speakers"))
    few = (F.col("kept") > 0) & (F.col("n_speakers") < FEW_SPEAKERS)
    return counters.crossJoin(n).withColumns({"few_speakers": few, "tight_cap": F.col("skip_speaker_full") > TIGHT_CAP * F.greatest("kept", F.lit(1))})  # one row each


def write_clips(clips: DataFrame, path: str) -> None:
    """Adds clips (utt_id, signal) to the table of clips."""
    clips.select("utt_id", F.col("signal").cast("array<float>")).write.mode("append").parquet(path)


def export_wav(clips: DataFrame, manifest: DataFrame, spec: AudioSpec = SPEC) -> DataFrame:
    """path, content: the clips as WAV files, for a sink of files."""
    from collections.abc import Iterator

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "content": [encode_wav(s, spec.sample_rate) for s in b["signal"]]})

    return clips.join(manifest.select("utt_id", "path"), "utt_id").select("path", "signal").mapInPandas(run, "path string, content binary")


def file_status(manifest: DataFrame, files: DataFrame, decoded: DataFrame | None = None) -> DataFrame:
    """utt_id, status: missing (no such file), unreadable (decoded: key, error), ok. files: rel."""
    rows = manifest.select("utt_id", F.col("path").alias("rel")).join(files.select("rel", F.lit(True).alias("there_")), "rel", "left")
    bad = decoded.where("error is not null").select(F.col("key").alias("rel"), F.lit(True).alias("bad_")).distinct() if decoded is not None else None
    rows = rows.join(bad, "rel", "left") if bad is not None else rows.withColumn("bad_", F.lit(None).cast("boolean"))
    return rows.select("utt_id", F.when(F.col("there_").isNull(), "missing").when(F.col("bad_"), "unreadable").otherwise("ok").alias("status"))


def prune_missing(manifest: DataFrame, files: DataFrame) -> DataFrame:
    return manifest.join(files.select(F.col("rel").alias("path")), "path", "left_semi").select(*manifest.columns)


def validate(manifest: DataFrame, clips: DataFrame, spec: AudioSpec = SPEC) -> tuple[DataFrame, DataFrame]:
    """(issues: utt_id, code; the manifest without rows whose clip is missing or bad). Rows that only break the
    manifest's rules are reported but stay."""
    from ..operators.signal import quality
    from ..schema import problems

    rows = manifest.join(clips.select("utt_id", "signal"), "utt_id", "left")
    audio = F.when(F.col("signal").isNull(), F.array(F.lit("missing"))).otherwise(quality(F.col("signal"), spec))
    schema = F.transform(problems(manifest), lambda m: F.concat(F.lit("schema:"), m))
    codes = rows.select("utt_id", audio.alias("audio"), schema.alias("schema"))
    issues = codes.select("utt_id", F.explode(F.concat("audio", "schema")).alias("code"))
    broken = codes.where(F.size("audio") > 0).select("utt_id")
    return issues, manifest.join(broken, "utt_id", "left_anti").select(*manifest.columns)
