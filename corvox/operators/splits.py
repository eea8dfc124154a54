"""Speaker-disjoint splits and what they leak."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stable_hash
from ..schema import SPLITS, engine
from .corpus import split_report, unpaired


def hash_ranks(df: DataFrame, key: str, seed: int | str, digits: int = 2) -> DataFrame:
    """df (distinct keys) with rank_ from 0 in the order of a seeded hash, and n_, the number of rows. Rows are ranked
    within buckets by the hash's first hex digits; the buckets' sizes (16 ** digits rows) give each its start."""
    hashed = df.withColumn("h_", stable_hash(F.lit(seed), F.col(key))).withColumn("b_", F.substring("h_", 1, digits))
    sizes = hashed.groupBy("b_").agg(F.count("*").alias("m_"))
    before = Window.orderBy("b_").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("b_", F.coalesce(F.sum("m_").over(before), F.lit(0)).alias("start_"), F.sum("m_").over(Window.partitionBy(F.lit(0))).alias("n_"))
    within = Window.partitionBy("b_").orderBy("h_", key)
    ranked = hashed.withColumn("at_", F.row_number().over(within)).join(F.broadcast(starts), "b_")
    return ranked.select(*df.columns, (F.col("start_") + F.col("at_") - 1).alias("rank_"), "n_")


def by_ratio(rank: Column, n: Column, ratios: tuple[float, float, float]) -> Column:
    train, val = F.floor(n * F.lit(ratios[0])), F.floor(n * F.lit(ratios[1]))
    return F.when(rank < train, "train").when(rank < train + val, "val").otherwise("test")


def _hinted(rows: DataFrame, hints: Column, ratios: tuple[float, float, float], seed: int) -> DataFrame:
    """speaker, new_split from the splits that the source names: the most frequent one of a speaker's rows (of several
    the first of train, val, test); then a share of the train speakers becomes val, one at least unless there is only
    one. Speakers without hints are train."""
    order = F.array_position(F.array(*(F.lit(s) for s in SPLITS)), F.col("hint"))
    votes = rows.select("speaker", hints.alias("hint")).where(F.col("hint").isin(*SPLITS)).groupBy("speaker", "hint").agg(F.count("*").alias("n"))
    voted = votes.groupBy("speaker").agg(F.max_by("hint", F.struct("n", -order)).alias("hint"))
    every = rows.select("speaker").distinct().join(voted, "speaker", "left").withColumn("hint", F.coalesce("hint", F.lit("train")))
    ranked = hash_ranks(every.where("hint = 'train'"), "speaker", seed)
    carved = F.when(F.col("n_") > 1, F.greatest(F.lit(1), F.floor(F.col("n_") * F.lit(ratios[1])))).otherwise(0)
    train = ranked.select("speaker", F.when(F.col("rank_") < carved, "val").otherwise("train").alias("new_split"))
    return train.union(every.where("hint <> 'train'").select("speaker", "hint"))


def assign(df: DataFrame, ratios: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = 42, holdout: tuple[str, ...] = (), hints: str | None = None) -> DataFrame:
    """df with its split column set: all rows of a speaker in one split, rows without a speaker one by one; augmented
    rows go with their parent. Then fakes of held-out engines (in any case of letters) go to test. hints: a column of
    splits that the source names."""
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError(f"ratios must sum to 1: {ratios}")
    clean = df.where("augment = ''")
    voiced = df.where("speaker <> ''").select("speaker", *([hints] if hints else []))
    if hints and not voiced.where(F.col(hints).isin(*SPLITS)).isEmpty():
        of_speaker = _hinted(voiced, F.col(hints), ratios, seed)
    else:
        ranked = hash_ranks(voiced.select("speaker").distinct(), "speaker", seed)
        of_speaker = ranked.select("speaker", by_ratio(F.col("rank_"), F.col("n_"), ratios).alias("new_split"))
    homeless = hash_ranks(clean.where("speaker = ''").select("utt_id").distinct(), "utt_id", f"homeless-{seed}")
    of_row = homeless.select(F.col("utt_id").alias("base_"), by_ratio(F.col("rank_"), F.col("n_"), ratios).alias("row_split"))
    parents = clean.select(F.col("utt_id").alias("base_"), F.col("speaker").alias("base_speaker_"))
    rows = df.withColumn("base_", F.when(F.col("parent_utt_id") != "", F.col("parent_utt_id")).otherwise(F.col("utt_id")))
    rows = rows.join(parents, "base_", "left").withColumn("of_", F.coalesce("base_speaker_", "speaker"))
    rows = rows.join(of_speaker.withColumnRenamed("speaker", "of_"), "of_", "left").join(of_row, "base_", "left")
    split = F.coalesce("new_split", "row_split", F.lit("train"))
    if holdout:
        held = (F.col("label") == "fake") & F.lower(engine(F.col("generator"))).isin(*(e.lower() for e in holdout))
        split = F.when(held, "test").otherwise(split)
    return rows.withColumn("split", split).select(*df.columns, *([] if "split" in df.columns else ["split"]))


def leaks(df: DataFrame, holdout: tuple[str, ...] = ()) -> DataFrame:
    """speaker, split_a, split_b, cause: speakers that two splits share; "holdout" if only the rows of held-out engines
    make it so, else "true_leak"."""
    held = F.lower(engine(F.col("generator"))).isin(*(e.lower() for e in holdout)) if holdout else F.lit(False)
    where = df.where("speaker <> ''").groupBy("speaker", "split").agg(F.min(held.cast("int")).alias("only_held"))
    a = where.select("speaker", F.col("split").alias("split_a"), F.col("only_held").alias("held_a"))
    b = where.select("speaker", F.col("split").alias("split_b"), F.col("only_held").alias("held_b"))
    both = a.join(b, "speaker").where("split_a < split_b")  # three splits: three pairs a speaker at most
    return both.select("speaker", "split_a", "split_b", F.when(F.col("held_a") + F.col("held_b") > 0, "holdout").otherwise("true_leak").alias("cause"))


def missing_classes(df: DataFrame) -> DataFrame:
    """split, lacks: splits of train, val and test without rows of a class."""
    spark = df.sparkSession
    every = spark.createDataFrame([(s,) for s in SPLITS], "split string").join(split_report(df), "split", "left")
    lacks = F.filter(F.array(F.when(F.coalesce("n_real", F.lit(0)) == 0, F.lit("real")), F.when(F.coalesce("n_fake", F.lit(0)) == 0, F.lit("fake"))), lambda x: x.isNotNull())
    return every.select("split", F.explode(lacks).alias("lacks"))


def assert_complete(df: DataFrame, strict: bool = True) -> list[str]:
    """What is wrong with the splits, as messages; strict: an error if a split lacks a class."""
    found = [f"{r.split} has no {r.lacks} rows" for r in missing_classes(df).collect()]
    if found:
        found.append(f"{unpaired(df).count()} fakes have no real row that they were made from")
        if strict:
            raise ValueError("; ".join(found))
    return found
