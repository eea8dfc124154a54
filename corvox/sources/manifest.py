"""The manifest as CSV or Parquet, corpus snapshots, and report sinks."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import canonical_order, pending, without
from ..schema import MANIFEST, conformed, empty_manifest, lenient


def read_csv(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """Every cell is read as text and then typed leniently. A path that doesn't exist is an empty manifest, or an
    error if it is required."""
    try:
        return lenient(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path))
    except AnalysisException:
        if required:
            raise
        return empty_manifest(spark)


def write_csv(df: DataFrame, path: str) -> None:
    canonical_order(conformed(df)).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def save(df: DataFrame, root: str) -> str:
    """Writes a new snapshot below root and then makes the pointer name it, so that readers see the old rows or the
    new ones. Rows are sorted within range partitions. Returns the snapshot's path."""
    spark, path = df.sparkSession, f"{root}/snapshot-{uuid.uuid4().hex}"
    canonical_order(conformed(df)).write.parquet(path)
    spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("overwrite").json(f"{root}/current")
    return path


def load(spark: SparkSession, root: str, required: bool = False) -> DataFrame:
    try:
        path = spark.read.json(f"{root}/current", schema="path string").head().path
    except (AnalysisException, AttributeError):
        if required:
            raise FileNotFoundError(f"no manifest at {root}") from None
        return empty_manifest(spark)
    return spark.read.schema(MANIFEST).parquet(path)


def export_corpus(manifest: DataFrame, clips: DataFrame | None, out: str, files: int = 8, compression: str = "zstd") -> None:
    """Manifest and the clips that belong to it; without clips, the manifest alone."""
    manifest.coalesce(files).write.option("compression", compression).parquet(f"{out}/manifest")
    if clips is not None:
        clips.join(manifest.select("utt_id"), "utt_id", "left_semi").coalesce(files).write.option("compression", compression).parquet(f"{out}/clips")


def import_corpus(spark: SparkSession, path: str, manifest: DataFrame, clips: DataFrame, overwrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """(manifest, clips) with what the export has in addition, or, to overwrite, instead; rows without a clip go."""
    try:
        got = spark.read.parquet(f"{path}/manifest")
    except AnalysisException:
        raise FileNotFoundError(f"{path} has no manifest") from None
    try:
        got_clips = spark.read.parquet(f"{path}/clips")
    except AnalysisException:
        got_clips = clips.limit(0)
    if overwrite:
        all_clips = without(clips, got_clips).unionByName(got_clips)
        rows = without(manifest, got).unionByName(got)
    else:
        all_clips = clips.unionByName(pending(got_clips, clips))
        rows = manifest.unionByName(pending(got, manifest))
    return rows.join(all_clips.select("utt_id"), "utt_id", "left_semi"), all_clips


def predictions(scores: DataFrame, threshold: float) -> DataFrame:
    """utt_id, label, score (6 places), predicted, correct and the five dimensions, as a sink takes them."""
    said = F.when(F.col("score") >= threshold, "fake").otherwise("real")
    dims = [F.col(c) for c in ("generator", "source", "speaker", "augment", "split") if c in scores.columns]
    return scores.select("utt_id", "label", F.round("score", 6).alias("score"), said.alias("predicted"), (said == F.col("label")).alias("correct"), *dims)


def report_json(report: DataFrame) -> DataFrame:
    """One JSON document a row."""
    return report.select(F.to_json(F.struct("*")).alias("value"))
