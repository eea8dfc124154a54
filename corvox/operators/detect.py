"""Detection over files: normalise, embed, score the pieces, decide."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import confidence, predicted
from .features import embed
from .model import score
from .signal import SPEC, AudioSpec, normalise


def threshold_of(explicit: float | None, facts: dict) -> float:
    return explicit if explicit is not None else facts.get("threshold") if facts.get("threshold") is not None else 0.5


def decide(chunk_scores: DataFrame, threshold: float) -> DataFrame:
    """key, score (mean of its pieces), chunk_scores (in order), label, confidence. chunk_scores: key, chunk, score."""
    got = chunk_scores.groupBy("key").agg(F.avg("score").alias("score"), F.transform(F.array_sort(F.collect_list(F.struct("chunk", "score"))), lambda x: x["score"]).alias("chunk_scores"))
    return got.withColumns({"label": predicted(F.col("score"), threshold), "confidence": confidence(F.col("score"), threshold)})


def detect(items: DataFrame, model: PipelineModel, stats: DataFrame, facts: dict, threshold: float | None = None, backbone: str = "bands", spec: AudioSpec = SPEC) -> DataFrame:
    """items: key, content. key, score, chunk_scores, label, confidence, warning (shorter than usable), error. Files are
    decoded once; short ones are padded; a file that can't be read is a row with an error."""
    clips = normalise(items, replace(spec, short_policy="pad"))
    ids = F.concat_ws("#", "key", F.col("chunk").cast("string"))
    vectors = embed(clips.where("error is null").select(ids.alias("utt_id"), "signal"), backbone, spec.sample_rate)
    scored = score(model, stats, vectors, facts["head"]).select(F.regexp_extract("utt_id", r"^(.*)#(\d+)$", 1).alias("key"), F.regexp_extract("utt_id", r"#(\d+)$", 1).cast("int").alias("chunk"), "score")
    files = clips.groupBy("key").agg(F.max("raw_seconds").alias("raw"), F.max("error").alias("error"))
    warning = F.when(F.col("raw") < spec.min_seconds, "shorter than the least length")
    return files.join(decide(scored, threshold_of(threshold, facts)), "key", "left").select("key", "score", "chunk_scores", "label", "confidence", warning.alias("warning"), "error")
