"""Detection metrics from score histograms: work and shuffles follow distinct scores, not rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import condition, or_placeholder
from ..schema import engine
from ..tables import held


def histogram(scores: DataFrame, *by: str) -> DataFrame:
    """by..., score, f (fakes) and r (reals) of that score. Rows without a score take no part."""
    fake = F.count_if(F.col("label") == "fake").alias("f")
    return scores.where("score is not null").groupBy(*by, "score").agg(fake, F.count_if(F.col("label") == "real").alias("r"))


#: Rows of one range of a scan: what one task sorts.
RANGE_ROWS = 1 << 20


def scanned(df: DataFrame, by: list[str], order: str, values: list[str], descending: bool = True, range_rows: int = RANGE_ROWS) -> DataFrame:
    """df with, for each value, cum_<value> (its sum up to the row in the group's order), total_<value> (of the group)
    and next_<value> (of the group's next row; null at its end), and first_ (whether the row is its group's first). The
    order's column has distinct values within a group.

    No task gets all rows of a group: rows are dealt in ranges of (group, order), as many as the number of rows asks
    for; within a range and group a window sums up, and each range's totals and first row, a row for each group of a
    range, give the ranges after and before it what they lack. Rows and ranges are fixed by held(), so both passes see
    the same ranges whatever is computed again. Null groups are groups; a null order is the last."""
    n = held(df)
    ranges = max(1, math.ceil(n.count() / range_rows))
    at = F.desc_nulls_last(order) if descending else F.asc_nulls_last(order)
    rows = n.withColumn("range_", F.lit(0)) if ranges == 1 else held(n.repartitionByRange(ranges, *by, at).withColumn("range_", F.spark_partition_id()))
    within = Window.partitionBy("range_", *by).orderBy(at)
    sums = {f"cum_{v}": F.sum(v).over(within.rowsBetween(Window.unboundedPreceding, 0)) for v in values}
    nexts = {f"next_{v}": F.lead(v).over(within) for v in values}
    rows = rows.withColumns(sums | nexts | {"at_": F.row_number().over(within)})
    # a row for each group of each range; the window over them sees as many rows of a group as it has ranges
    head = F.min_by(F.struct(*values), F.col("at_")).alias("head_")
    totals = rows.groupBy("range_", *by).agg(*(F.sum(v).alias(f"sum_{v}") for v in values), head)
    group = Window.partitionBy(*by)
    ahead = group.orderBy("range_")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("range_").alias("its_"), *(F.col(c).alias(f"its_{c}") for c in by),
        *(F.coalesce(F.sum(f"sum_{v}").over(before), F.lit(0)).alias(f"before_{v}") for v in values), *(F.sum(f"sum_{v}").over(group).alias(f"total_{v}") for v in values),
        F.lead("head_").over(ahead).alias("after_"), (F.row_number().over(ahead) == 1).alias("opens_"),
    )
    same = F.col("range_") == F.col("its_")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"its_{c}"))
    return rows.join(totals, same).select(
        *df.columns, *((F.col(f"cum_{v}") + F.col(f"before_{v}")).alias(f"cum_{v}") for v in values), *(f"total_{v}" for v in values),
        *(F.coalesce(f"next_{v}", F.col("after_")[v]).alias(f"next_{v}") for v in values), (F.col("opens_") & (F.col("at_") == 1)).alias("first_"),
    )


def prefix_sums(df: DataFrame, order: str, values: list[str], buckets: int | None = None, descending: bool = True, by: list[str] | None = None) -> DataFrame:
    """df with running sums cum_<value> in the order of a column with distinct values (of each group, if by is given),
    without a window over all rows. buckets: about how many ranges to use, instead of as many as the rows ask for."""
    size = RANGE_ROWS if buckets is None else max(1, math.ceil(df.count() / buckets))
    return scanned(df, by or [], order, values, descending, size).select(*df.columns, *(f"cum_{v}" for v in values))


def cumulated(hist: DataFrame, by: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Running counts tp and fp by descending score, the totals p and n, f and r of the score itself, and whether it is
    a corner of the ROC: one of its ends, or where it bends, that is, the next step differs from this one."""
    rows = scanned(hist.select(*by, "score", "f", "r"), by, "score", ["f", "r"], range_rows=range_rows)
    bends = (F.col("next_f") != F.col("f")) | (F.col("next_r") != F.col("r"))
    return rows.select(*by, "score", F.col("cum_f").alias("tp"), F.col("cum_r").alias("fp"), F.col("total_f").alias("p"), F.col("total_r").alias("n"), "f", "r", (F.col("first_") | F.coalesce(bends, F.lit(True))).alias("corner"))


def roc_points(hist: DataFrame, by: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """by..., score, tp, fp, p, n: the corners of each group's ROC. A point between two others on a straight line of
    counts is left out, the ends stay, and a point (0, 0) at an infinite score is added."""
    corners = cumulated(hist, by, range_rows).where("corner").select(*by, "score", "tp", "fp", "p", "n")
    first = hist.groupBy(*by).agg(F.sum("f").alias("p"), F.sum("r").alias("n"))
    return corners.unionByName(first.select(*by, F.lit(float("inf")).alias("score"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"), "p", "n"))


def summary(hist: DataFrame, by: list[str], p_target: float = 0.05, c_miss: float = 1.0, c_fa: float = 1.0, range_rows: int = RANGE_ROWS) -> DataFrame:
    """by..., eer, eer_threshold, min_dcf, auc of each group, from one scan; null where a class is missing.

    eer: at the corner where miss and false-alarm rates are closest, the highest score of several. min_dcf: least
    detection cost over all corners, over that of the better constant answer. auc: by trapezoids, so ties count half."""
    fpr, fnr = F.col("fp") / F.col("n"), 1 - F.col("tp") / F.col("p")
    point = lambda gap, low, eer: F.struct(gap.alias("gap"), low.alias("low"), eer.alias("eer"))
    best = F.min(F.when(F.col("corner"), point(F.round(F.abs(fnr - fpr), 12), -F.col("score"), (fpr + fnr) / 2)))
    cost = F.min(F.when(F.col("corner"), c_miss * p_target * fnr + c_fa * (1 - p_target) * fpr))
    rows = cumulated(hist, by, range_rows).where("p > 0 and n > 0")
    got = rows.groupBy(*by).agg(best.alias("best_"), cost.alias("cost_"), (F.sum(F.col("r") * (2 * F.col("tp") - F.col("f"))) / (2.0 * F.max("p") * F.max("n"))).alias("auc"))
    # the curve's beginning, where nothing is called fake, is a corner too
    best = F.least("best_", point(F.lit(1.0), F.lit(float("-inf")), F.lit(0.5)))
    least = F.least("cost_", F.lit(c_miss * p_target)) / min(c_miss * p_target, c_fa * (1 - p_target))
    return got.select(*by, best["eer"].alias("eer"), (-best["low"]).alias("eer_threshold"), least.alias("min_dcf"), "auc")


def equal_error_rate(hist: DataFrame, by: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """by..., eer, eer_threshold, as summary() has them."""
    return summary(hist, by, range_rows=range_rows).select(*by, "eer", "eer_threshold")


def min_dcf(hist: DataFrame, by: list[str], p_target: float = 0.05, c_miss: float = 1.0, c_fa: float = 1.0) -> DataFrame:
    """by..., min_dcf, as summary() has it."""
    return summary(hist, by, p_target, c_miss, c_fa).select(*by, "min_dcf")


def area_under_curve(hist: DataFrame, by: list[str]) -> DataFrame:
    """by..., auc, as summary() has it."""
    return summary(hist, by).select(*by, "auc")


def decision_threshold(hist: DataFrame, by: list[str], rates: DataFrame | None = None) -> DataFrame:
    """by..., threshold: half-way between classes that don't overlap; else the equal-error one if it is strictly within
    the scores; else 0.5. rates: what summary() made of hist, if it is there already."""
    ends = hist.groupBy(*by).agg(
        F.max(F.when(F.col("r") > 0, F.col("score"))).alias("top_real"), F.min(F.when(F.col("f") > 0, F.col("score"))).alias("low_fake"),
        F.min("score").alias("low"), F.max("score").alias("top"),
    )
    both = _with(ends, summary(hist, by) if rates is None else rates, by)
    apart = F.col("top_real") < F.col("low_fake")
    inner = (F.col("eer_threshold") > F.col("low")) & (F.col("eer_threshold") < F.col("top"))
    return both.select(*by, F.when(apart, (F.col("top_real") + F.col("low_fake")) / 2).when(inner, F.col("eer_threshold")).otherwise(0.5).alias("threshold"))


def _with(rows: DataFrame, facts: DataFrame, by: list[str]) -> DataFrame:
    """rows with the columns of facts, a row a group; null groups meet too."""
    renamed = facts.withColumnsRenamed({c: f"{c}_of" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_of"))
    return rows.join(renamed, same, "left").drop(*(f"{c}_of" for c in by))


def confusion(hist: DataFrame, by: list[str], threshold: Column) -> DataFrame:
    """Counts and rates at a threshold; a rate without rows is 0 (balanced accuracy: null)."""
    hit = F.col("score") >= threshold
    count = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).alias
    counts = hist.groupBy(*by).agg(count("f", hit)("tp"), count("r", hit)("fp"), count("f", ~hit)("fn"), count("r", ~hit)("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    over = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = counts.withColumns({"accuracy": over(tp + tn, tp + fp + fn + tn), "precision": over(tp, tp + fp), "recall": over(tp, tp + fn), "false_alarm_rate": fp / F.greatest(fp + tn, F.lit(1)), "miss_rate": fn / F.greatest(tp + fn, F.lit(1))})
    f1 = over(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    balanced = F.when((tp + fn > 0) & (tn + fp > 0), (F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2)
    return out.withColumns({"f1": f1, "balanced_accuracy": balanced})


def full_report(scores: DataFrame, threshold: float | None = None, by: list[str] | None = None) -> DataFrame:
    """A row for each group (or one): all metrics. A given threshold overrides the chosen one."""
    keys = by or ["all_"]
    rows = scores if by else scores.withColumn("all_", F.lit(0))
    hist = held(histogram(rows, *keys))
    rates = held(summary(hist, keys))  # a row a group
    chosen = decision_threshold(hist, keys, rates) if threshold is None else hist.select(*keys).distinct().withColumn("threshold", F.lit(threshold))
    base = _with(confusion(_with(hist, chosen, keys), [*keys, "threshold"], F.col("threshold")), rates, keys)
    return base if by else base.drop("all_")


def dimensions(scores: DataFrame) -> DataFrame:
    """Each row once for each of the four standard breakdowns: dim, value, label, score."""
    dims = F.array(
        F.struct(F.lit("generator").alias("dim"), or_placeholder(F.col("generator"), "(real)").alias("value")),
        F.struct(F.lit("engine").alias("dim"), or_placeholder(engine(F.col("generator")), "(real)").alias("value")),
        F.struct(F.lit("source").alias("dim"), or_placeholder(F.col("source"), "(unknown)").alias("value")),
        F.struct(F.lit("condition").alias("dim"), condition(F.col("augment")).alias("value")),
    )
    return scores.select(F.explode(dims).alias("d"), "label", "score").select("d.dim", "d.value", "label", "score")


def breakdown(rows: DataFrame, by: list[str], threshold: float) -> DataFrame:
    """For each group: n, n_real, n_fake, mean_score, eer (of a group of fakes alone against all reals of the same
    dimension, of a mixed one within it), detection_rate of fakes alone, false_alarm_rate of reals alone. by: the
    dimension's columns and, last, its value. The reals' histogram, not their rows, is paired with the groups."""
    hist, (*dim, value) = histogram(rows, *by), by
    hit = F.col("score") >= threshold
    facts = hist.groupBy(*by).agg(
        F.sum(F.col("f") + F.col("r")).alias("n"), F.sum("r").alias("n_real"), F.sum("f").alias("n_fake"),
        (F.sum(F.col("score") * (F.col("f") + F.col("r"))) / F.sum(F.col("f") + F.col("r"))).alias("mean_score"),
        (F.sum(F.when(hit, F.col("f") + F.col("r")).otherwise(0)) / F.sum(F.col("f") + F.col("r"))).alias("hits"),
    )
    alone = facts.where("n_real = 0 and n_fake > 0").select(*by)
    reals = hist.groupBy(*dim, "score").agg(F.sum("r").alias("r")).where("r > 0")
    paired = alone.join(reals, dim) if dim else alone.crossJoin(reals)  # groups times distinct scores
    every = hist.unionByName(paired.select(*by, "score", F.lit(0).cast("long").alias("f"), "r"))
    every = every.groupBy(*by, "score").agg(F.sum("f").alias("f"), F.sum("r").alias("r"))
    return _with(facts, equal_error_rate(every, by).drop("eer_threshold"), by).select(
        *by, "n", "n_real", "n_fake", "mean_score", "eer",
        F.when(F.col("n_real") == 0, F.col("hits")).alias("detection_rate"), F.when(F.col("n_fake") == 0, F.col("hits")).alias("false_alarm_rate"),
    )


def precision_recall(hist: DataFrame, by: list[str]) -> DataFrame:
    return cumulated(hist, by).select(*by, "score", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / F.col("p")).alias("recall"))


def score_bins(scores: DataFrame, bins: int = 40) -> DataFrame:
    """label, bin, n: equal bins between each class's least and greatest score."""
    ends = scores.groupBy("label").agg(F.min("score").alias("low"), F.max("score").alias("top"))
    width = (F.col("top") - F.col("low")) / bins
    bin_ = F.when(width == 0, 0).otherwise(F.least(F.floor((F.col("score") - F.col("low")) / width), F.lit(bins - 1)))
    return scores.join(F.broadcast(ends), "label").groupBy("label", bin_.cast("int").alias("bin")).agg(F.count("*").alias("n"))
