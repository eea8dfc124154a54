"""Filters, joins, aggregations and orders over the manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_usable, stable_hash
from ..schema import problems

#: Parts in which rows that have no parent are dealt out.
SPREAD = 1 << 13
#: A number at the very end of an id, and ids with one base that are brought together at most.
PIECE, PIECES = r"-[0-9]+\z", 1 << 15


def where_equal(df: DataFrame, **criteria) -> DataFrame:
    """Rows that have all of these values; a column that doesn't exist is an error at once."""
    unknown = set(criteria) - set(df.columns)
    if unknown:
        raise KeyError(f"no such columns: {', '.join(sorted(unknown))}")
    return df.where(reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in criteria.items()), F.lit(True)))


def speakers(df: DataFrame, label: str | None = None) -> DataFrame:
    rows = df if label is None else df.where(F.col("label") == label)
    return rows.where("speaker <> ''").select("speaker").distinct().orderBy("speaker")


def augmentable(df: DataFrame, splits: tuple[str, ...] = ("train",)) -> DataFrame:
    return df.where((F.col("augment") == "") & ((F.col("split") == "") | F.col("split").isin(*splits)))


def synthesis_pool(df: DataFrame, least: int = 6, most: int = 40) -> DataFrame:
    return df.where((F.col("label") == "real") & (F.col("augment") == "") & (F.col("text") != "") & is_usable(F.col("text"), least, most))


def upsert(manifest: DataFrame, batch: DataFrame, order: str | None = None, key: str = "utt_id") -> DataFrame:
    """manifest with the batch's rows in place of those of the same key; of several in the batch the last by `order`.
    Only the batch is ranked; the manifest is read once and anti-joined."""
    if order:
        last = Window.partitionBy(key).orderBy(F.desc(order))
        batch = batch.withColumn("at_", F.row_number().over(last)).where("at_ = 1").drop("at_", *([] if order in manifest.columns else [order]))
    return manifest.join(batch.select(key), key, "left_anti").unionByName(batch)


def without(df: DataFrame, keys: DataFrame, key: str = "utt_id") -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")


def pending(batch: DataFrame, existing: DataFrame, key: str = "utt_id") -> DataFrame:
    """What is still to do."""
    return without(batch, existing, key)


def with_parent(df: DataFrame, columns: list[str]) -> DataFrame:
    """df, with these columns taken from the parent where a row has one: children follow their parent.

    Most rows name no parent. They are dealt out by their own ids in SPREAD parts, so that they don't meet in one task;
    a parent whose id is empty goes to each part."""
    every = F.when(F.col("utt_id") == "", F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    parent = df.where("augment = ''").select(F.col("utt_id").alias("parent_utt_id"), *(F.col(c).alias(f"parent_{c}") for c in columns), F.explode(every).alias("part_"))
    rows = df.withColumn("part_", F.when(F.coalesce("parent_utt_id", F.lit("")) == "", F.pmod(F.xxhash64("utt_id"), F.lit(SPREAD).cast("long"))).otherwise(F.lit(0).cast("long")))
    joined = rows.join(parent, ["parent_utt_id", "part_"], "left")
    return joined.select(*(F.coalesce(f"parent_{c}", c).alias(c) if c in columns else c for c in df.columns))


def pairs(df: DataFrame) -> DataFrame:
    """Each fake with the real row that it was made from."""
    real = df.where("label = 'real'").select(F.col("utt_id").alias("ref_utt_id"), F.col("text").alias("real_text"), F.col("speaker").alias("real_speaker"))
    return df.where("label = 'fake' and ref_utt_id <> ''").join(real, "ref_utt_id")


def unpaired(df: DataFrame) -> DataFrame:
    known = df.select(F.col("utt_id").alias("ref_utt_id"))
    return df.where("label = 'fake'").join(known, "ref_utt_id", "left_anti")


def chunk_members(df: DataFrame) -> DataFrame:
    """utt_ids that are pieces of a split file: the piece -1 exists, or the id is another's with a number.

    What stands before the number may be the same for most ids ("utt" of utt-7), whether it is an id or not: ids are
    counted by it in each task first, and those of one with more than PIECES are dealt out in parts, or left out where
    it is no id."""
    own = F.col("utt_id")
    base = F.when(own.rlike(PIECE), F.regexp_replace(own, PIECE, ""))
    said = df.select(F.explode(F.array(F.struct(own.alias("base"), F.lit(True).alias("is_"), F.lit(0).alias("n_")), F.struct(base.alias("base"), F.lit(False).alias("is_"), F.lit(1).alias("n_")))).alias("x"))
    counts = said.select("x.*").where("base is not null").groupBy("base").agg(F.bool_or("is_").alias("is_"), F.sum("n_").alias("n_"))
    parts = F.ceil(F.col("n_") / PIECES)
    many = F.broadcast(counts.where(F.col("n_") > PIECES).select("base", "is_", parts.alias("parts_")))  # a row for each PIECES ids at most
    found = counts.where("is_ and n_ > 0").select("base", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part_"))
    rows = df.select(own, base.alias("base")).where("base is not null").join(many, "base", "left").where(F.coalesce("is_", F.lit(True)))
    part = F.coalesce(F.pmod(F.xxhash64("utt_id"), F.col("parts_")), F.lit(0).cast("long"))
    later = rows.select("utt_id", "base", part.alias("part_")).join(found, ["base", "part_"], "left_semi")
    # a first piece that has been found says that of its base too
    return later.select(F.explode(F.array_compact(F.array("utt_id", F.when(own.endswith("-1"), F.col("base"))))).alias("utt_id")).distinct()


def speaker_leaks(df: DataFrame) -> DataFrame:
    """speaker, splits: speakers in more than one split."""
    where = df.where("speaker <> '' and split <> ''").groupBy("speaker").agg(F.sort_array(F.collect_set("split")).alias("s"))
    return where.where(F.size("s") > 1).select("speaker", F.array_join("s", ",").alias("splits"))


def statistics(df: DataFrame) -> DataFrame:
    """stat, value, n, hours: counts in all, by label, source (reals only), generator and split and label, in one pass
    over the rows by grouping sets; sources count reals alone, so labels are part of that set."""
    sets = [[], ["label"], ["label", "source"], ["generator"], ["label", "split"]]
    marks = F.grouping_id().alias("g")
    keys = ["label", "source", "generator", "split"]
    got = df.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in keys)).agg(marks, F.count("*").alias("n"), (F.sum("duration") / 3600).alias("hours"))
    bit = {c: 1 << (len(keys) - 1 - k) for k, c in enumerate(keys)}
    gid = lambda s: sum(b for c, b in bit.items() if c not in s)
    g = F.col("g")
    stat = F.when(g == gid([]), "total").when(g == gid(["label"]), "label").when(g == gid(["label", "source"]), "source").when(g == gid(["generator"]), "generator").otherwise("split")
    value = F.when(g == gid([]), "").when(g == gid(["label"]), F.col("label")).when(g == gid(["label", "source"]), F.col("source")).when(g == gid(["generator"]), F.col("generator")).otherwise(F.concat_ws("/", "split", "label"))
    kept = ~((stat == "source") & (F.col("label") != "real")) & ~((stat == "generator") & (F.col("generator") == ""))
    return got.where(kept).select(stat.alias("stat"), value.alias("value"), "n", F.round("hours", 2).alias("hours"))


def split_report(df: DataFrame) -> DataFrame:
    """split, n_real, n_fake, n_speakers."""
    return df.groupBy("split").agg(F.count_if(F.col("label") == "real").alias("n_real"), F.count_if(F.col("label") == "fake").alias("n_fake"), F.count_distinct(F.nullif("speaker", F.lit(""))).alias("n_speakers"))


def issue_counts(df: DataFrame, issues: Column | None = None) -> DataFrame:
    """code, n: how many rows have each issue, the most frequent first."""
    codes = problems(df) if issues is None else issues
    return df.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def counters(df: DataFrame, status: Column, names: tuple[str, ...]) -> DataFrame:
    """One row with the number of rows of each status, 0 where there are none."""
    return df.select(status.alias("status_")).agg(*(F.count_if(F.col("status_") == s).alias(s) for s in names))


def preflight(df: DataFrame, reals: int = 10, voices: int = 3, transcripts: int = 1) -> DataFrame:
    """One row: counts and whether they are enough to go on."""
    real = F.col("label") == "real"
    got = df.agg(F.count_if(real).alias("n_real"), F.count_distinct(F.when(real & (F.col("speaker") != ""), F.col("speaker"))).alias("n_speakers"), F.count_if(real & (F.trim("text") != "")).alias("n_text"))
    return got.withColumn("ready", (F.col("n_real") >= reals) & (F.col("n_speakers") >= voices) & (F.col("n_text") >= transcripts))


def profile(df: DataFrame) -> DataFrame:
    """One row: class balance, durations, paired fakes, reals without text."""
    real, fake = F.col("label") == "real", F.col("label") == "fake"
    known = df.where(real).select(F.col("utt_id").alias("ref_utt_id"), F.lit(1).alias("paired_"))
    rows = df.join(known, "ref_utt_id", "left")
    got = rows.agg(
        F.count_if(real).alias("n_real"), F.count_if(fake).alias("n_fake"), F.min("duration").alias("shortest"), F.round(F.avg("duration"), 6).alias("mean_duration"), F.max("duration").alias("longest"),
        F.count_if(fake & F.col("paired_").isNotNull()).alias("n_paired"), F.count_if(real & (F.trim("text") == "")).alias("n_no_text"),
    )
    ratio = F.greatest("n_real", "n_fake") / F.greatest(F.least("n_real", "n_fake"), F.lit(1))
    return got.withColumn("unbalanced", ratio > 1.3)


def class_balance(df: DataFrame) -> DataFrame:
    got = df.agg(F.greatest(F.count_if(F.col("label") == "real"), F.lit(1)).alias("n_real"), F.greatest(F.count_if(F.col("label") == "fake"), F.lit(1)).alias("n_fake"))
    return got.withColumn("pos_weight", F.col("n_real") / F.col("n_fake"))


def top_groups(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def seeded_sample(df: DataFrame, group: str, n: int, seed: int, key: str = "utt_id") -> DataFrame:
    """n rows of each group at most, in the order of a seeded hash of the key: the same rows however df is
    partitioned. Only n rows a group leave each task."""
    order = Window.partitionBy(group).orderBy(stable_hash(F.lit(seed), F.col(key)), key)
    return df.withColumn("at_", F.row_number().over(order)).where(F.col("at_") <= n).drop("at_")


def canonical_order(df: DataFrame) -> DataFrame:
    return df.orderBy("label", "source", "speaker", "utt_id")


def per_speaker_cap(df: DataFrame, most: int, order: str = "utt_id") -> DataFrame:
    """The first `most` rows of each speaker."""
    return df.withColumn("at_", F.row_number().over(Window.partitionBy("speaker").orderBy(order))).where(F.col("at_") <= most).drop("at_")


def running_limit(df: DataFrame, chunks: str, limit: int, order: str) -> DataFrame:
    """Rows before which fewer than `limit` chunks have been kept. The order's column has distinct values of a number;
    bucket totals replace a window over all rows."""
    from .metrics import prefix_sums

    return prefix_sums(df, order, [chunks], descending=False).where(F.col(f"cum_{chunks}") - F.col(chunks) < limit).drop(f"cum_{chunks}")
