"""Embeddings: extraction, pooling, similarity and the audits that rest on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import once
from ..functions.text import slugify, word_error_rate, words
from ..tables import held
from .corpus import pending, seeded_sample
from .metrics import prefix_sums

POOLING = ("mean", "mean_std", "max", "first")


def cache_key(backbone: str, checkpoint: str, layer: int | str, pooling: str) -> Column:
    """Another backbone, checkpoint, layer or pooling is another set of features."""
    return slugify(F.lit(f"{backbone}-{checkpoint}-{layer}-{pooling}"), 96)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def pooled(frames: Column, how: str = "mean") -> Column:
    """One vector of ragged frames (an array of arrays); mean_std is twice as wide. No padding takes part."""
    if how not in POOLING:
        raise KeyError(f"no pooling {how}")
    n, wide = F.size(frames).cast("double"), frames[0]
    zero = F.transform(wide, lambda x: F.lit(0.0))
    if how == "first":
        return F.transform(wide, lambda x: x.cast("double"))
    if how == "max":
        return F.aggregate(frames, F.transform(wide, lambda x: F.lit(float("-inf"))), lambda s, v: F.zip_with(s, v, lambda a, b: F.greatest(a, b.cast("double"))))
    mean = F.transform(F.aggregate(frames, zero, lambda s, v: F.zip_with(s, v, lambda a, b: a + b.cast("double"))), lambda x: x / n)
    if how == "mean":
        return mean
    squares = lambda own: F.aggregate(frames, zero, lambda s, v: F.zip_with(s, F.zip_with(v, own, lambda b, m: (b - m) * (b - m)), lambda a, b: a + b))
    return once(mean, lambda own: F.concat(own, F.transform(squares(own), lambda x: F.sqrt(F.greatest(x / n, F.lit(1e-8))))))


Backbone = Callable[[list[np.ndarray], int], np.ndarray]


def bands(waveforms: list[np.ndarray], rate: int, n: int = 16) -> np.ndarray:
    """The built-in embedding: log of the mean magnitude in n equal bands of the first three seconds' spectrum."""
    out = []
    for x in waveforms:
        part = np.abs(np.fft.rfft(np.pad(x[: 3 * rate], (0, max(0, 3 * rate - len(x))))))
        out.append([np.log1p(p.mean()) for p in np.array_split(part, n)])
    return np.array(out, dtype=np.float32).reshape(-1, n)


BACKBONES: dict[str, Backbone] = {"bands": bands}


def register(name: str, fn: Backbone) -> None:
    if name in BACKBONES:
        raise ValueError(f"{name} exists already")
    BACKBONES[name] = fn


def embed(clips: DataFrame, backbone: str = "bands", rate: int = 16_000, existing: DataFrame | None = None) -> DataFrame:
    """utt_id, embedding for clips (utt_id, signal) that have none yet; clips without a signal are left out."""
    if backbone not in BACKBONES:
        raise KeyError(f"no backbone {backbone}")
    fn = BACKBONES[backbone]
    todo = clips.where("signal is not null and size(signal) > 0")
    todo = pending(todo, existing) if existing is not None else todo

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = fn([np.asarray(s, dtype=np.float32) for s in b["signal"]], rate)
            yield pd.DataFrame({"utt_id": b["utt_id"], "embedding": [v.tolist() for v in got]})

    return todo.select("utt_id", "signal").mapInPandas(run, "utt_id string, embedding array<float>")


def store(features: DataFrame, path: str, key: str) -> None:
    """Adds features (utt_id, embedding) under a cache key; only that partition is written."""
    out = features.select("utt_id", F.col("embedding").cast("array<float>"), F.lit(key).alias("cache_key"))
    out.write.mode("append").partitionBy("cache_key").parquet(path)


def dimension_stats(features: DataFrame) -> DataFrame:
    """dim, mean, std (of the population, plus 1e-6) over all vectors."""
    rows = features.select(F.posexplode("embedding").alias("dim", "x")).select("dim", F.col("x").cast("double").alias("x"))
    return rows.groupBy("dim").agg(F.avg("x").alias("mean"), (F.stddev_pop("x") + 1e-6).alias("std"))


def standardised(features: DataFrame, stats: DataFrame) -> DataFrame:
    """The vectors with each dimension's mean taken off and divided by its deviation. stats has a row a dimension."""
    one = stats.agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "mean", "std"))), lambda s: F.struct(s["mean"].alias("mean"), s["std"].alias("std"))).alias("stats_"))
    scaled = F.zip_with("embedding", "stats_", lambda x, s: (x.cast("double") - s["mean"]) / s["std"])
    return features.crossJoin(F.broadcast(one)).withColumn("embedding", scaled).drop("stats_")  # one row of statistics


def same_speaker_pairs(features: DataFrame, most: int = 4) -> DataFrame:
    """a, b, similarity for pairs among each speaker's first `most` real rows: six pairs a speaker by default."""
    real = features.where("label = 'real' and speaker <> ''")
    few = real.withColumn("at_", F.row_number().over(Window.partitionBy("speaker").orderBy("utt_id"))).where(F.col("at_") <= most)
    a, b = (few.select("speaker", F.col("utt_id").alias(k), F.col("embedding").alias(f"v_{k}")) for k in "ab")
    return a.join(b, "speaker").where("a < b").select("a", "b", cosine(F.col("v_a"), F.col("v_b")).alias("similarity"))


#: Speakers of one stretch of the circle in cross_speaker_pairs().
STRETCH = 256


def cross_speaker_pairs(features: DataFrame, partners: int | None = 100) -> DataFrame:
    """a, b, similarity for pairs of different speakers, the first real row of each; a is of the smaller speaker.

    All speakers take part: they stand in a circle in the order of a hash, and each is paired with as many next ones as
    `partners` says, so with twice as many in all. Up to 2 * partners + 1 speakers these are all pairs; with None they
    are all pairs of any number. Every speaker counts alike, and the pairs are the same in any partitioning.

    Work is linear in the speakers: the circle is cut in stretches, a row goes to its own and to those whose last places
    reach it, and pairs are found within a stretch. No speaker and no row: no pairs."""
    real = features.where("label = 'real' and speaker <> ''")
    one = real.groupBy("speaker").agg(F.min_by(F.struct("utt_id", "embedding"), "utt_id").alias("r"))
    one = one.select("speaker", "r", F.sha1("speaker").alias("h_"), F.lit(1).cast("long").alias("one_"))
    placed = held(prefix_sums(one, "h_", ["one_"], descending=False).select("speaker", "r", (F.col("cum_one_") - 1).alias("at_")))
    half = F.floor(F.col("n_") / 2)
    size = placed.agg(F.count("*").alias("n_"))
    rows = placed.crossJoin(F.broadcast(size)).withColumn("reach_", F.least(F.lit(partners).cast("long"), half) if partners is not None else half)  # one row
    # places whose stretches hold all those that reach a row: every STRETCH-th backwards, the farthest, and, across the
    # circle's seam, the last place, as the last stretch may be a short one
    back = F.transform(F.sequence(F.lit(0).cast("long"), F.col("reach_"), F.lit(STRETCH).cast("long")), lambda k: F.pmod(F.col("at_") - k, F.col("n_")))
    seam = F.when(F.col("at_") < F.col("reach_"), F.array(F.col("n_") - 1)).otherwise(F.array().cast("array<bigint>"))
    places = F.concat(back, F.array(F.pmod(F.col("at_") - F.col("reach_"), F.col("n_"))), seam)
    stretches = F.array_distinct(F.transform(places, lambda p: F.floor(p / STRETCH)))
    a = rows.select(F.floor(F.col("at_") / STRETCH).alias("stretch_"), F.col("at_").alias("at_a"), "n_", "reach_", F.col("speaker").alias("s_a"), F.col("r").alias("r_a"))
    b = rows.select(F.explode(stretches).alias("stretch_"), F.col("at_").alias("at_b"), F.col("speaker").alias("s_b"), F.col("r").alias("r_b"))
    apart = F.pmod(F.col("at_b") - F.col("at_a"), F.col("n_"))
    once = (apart * 2 != F.col("n_")) | (F.col("at_a") < F.col("at_b"))  # opposite places meet from both sides
    near = a.join(b, "stretch_").where(apart.between(F.lit(1), F.col("reach_")) & once)
    first = F.col("s_a") < F.col("s_b")
    ends = [F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("r_a", "r_b"), ("r_b", "r_a"))]
    return near.select(ends[0]["utt_id"].alias("a"), ends[1]["utt_id"].alias("b"), cosine(F.col("r_a.embedding"), F.col("r_b.embedding")).alias("similarity"))


def identity_audit(features: DataFrame, fake_pairs: DataFrame, margin: float = 0.05) -> DataFrame:
    """grp, n, similarity (median), verdict. The ceiling is real rows of one speaker, the floor of different ones; an
    engine's fakes keep the speaker's voice if they come near the ceiling. fake_pairs: generator, similarity."""
    groups = same_speaker_pairs(features).select(F.lit("(ceiling)").alias("grp"), "similarity")
    groups = groups.union(cross_speaker_pairs(features).select(F.lit("(floor)"), "similarity")).union(fake_pairs.select("generator", "similarity"))
    got = groups.groupBy("grp").agg(F.count("similarity").alias("n"), F.percentile("similarity", F.lit(0.5)).alias("similarity"))
    ends = got.agg(F.max(F.when(F.col("grp") == "(ceiling)", F.col("similarity"))).alias("ceil_"), F.max(F.when(F.col("grp") == "(floor)", F.col("similarity"))).alias("floor_"))
    verdict = F.when(F.col("grp").startswith("("), "").when(F.col("similarity") >= F.col("ceil_") - margin, "keep").when(F.col("similarity") <= F.col("floor_") + margin, "other").otherwise("between")
    return got.crossJoin(F.broadcast(ends)).select("grp", "n", "similarity", verdict.alias("verdict"))  # one row


def rated_sample(pairs: DataFrame, per_real: int = 20, per_engine: int = 15, seed: int = 42) -> DataFrame:
    """A seeded sample of each group's rows with their word error rates, wer. pairs: utt_id, grp ('(real)' or an engine),
    ref_text, hyp_text."""
    rows = pairs.where("trim(ref_text) <> ''")
    few = seeded_sample(rows.where("grp = '(real)'"), "grp", per_real, seed).union(seeded_sample(rows.where("grp <> '(real)'"), "grp", per_engine, seed))
    return few.withColumn("wer", word_error_rate(words(F.col("ref_text")), words(F.col("hyp_text"))))


def worst_sample(rated: DataFrame) -> DataFrame:
    """grp, utt_id, wer of the worst rated row of all engines, the greatest id of several; no row without rated ones."""
    worst = F.max_by(F.struct("grp", "utt_id", "wer"), F.struct("wer", "utt_id")).alias("w")
    return rated.where("grp <> '(real)' and wer is not null").agg(worst).where("w is not null").select("w.*")


def pronunciation_audit(pairs: DataFrame, per_real: int = 20, per_engine: int = 15, seed: int = 42) -> DataFrame:
    """grp, n, wer (median), worst (id of the greatest), verdict against the real rows. pairs: utt_id, grp ('(real)' or an
    engine), ref_text, hyp_text."""
    rated = rated_sample(pairs, per_real, per_engine, seed)
    got = rated.groupBy("grp").agg(F.count("wer").alias("n"), F.percentile("wer", F.lit(0.5)).alias("wer"), F.max_by("utt_id", F.struct("wer", "utt_id")).alias("worst"))
    floor = got.where("grp = '(real)'").agg(F.max("wer").alias("floor_"))
    over = F.col("wer") - F.col("floor_")
    verdict = F.when(F.col("grp") == "(real)", "").when(over <= 0.10, "good").when(over <= 0.30, "fair").otherwise("poor")
    return got.crossJoin(F.broadcast(floor)).select("grp", "n", "wer", "worst", verdict.alias("verdict"))  # one row
