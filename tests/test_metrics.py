import math
import random

import pytest

from corvox.operators import metrics


def rows(spark, pairs, parts=3):
    return spark.createDataFrame([("fake" if y else "real", float(s)) for y, s in pairs], "label string, score double").repartition(parts)


def brute_eer(pairs):
    """Corners of the ROC as a plain loop makes them."""
    p, n = sum(y for y, _ in pairs), sum(1 - y for y, _ in pairs)
    points = []
    for s in sorted({s for _, s in pairs}, reverse=True):
        points.append((s, sum(y for y, x in pairs if x >= s), sum(1 - y for y, x in pairs if x >= s)))
    kept = [q for k, q in enumerate(points) if k in (0, len(points) - 1) or any(points[k + 1][j] - 2 * q[j] + points[k - 1][j] for j in (1, 2))]
    kept = [(math.inf, 0, 0), *kept]
    best = min(kept, key=lambda q: (round(abs(1 - q[1] / p - q[2] / n), 12), -q[0]))
    return (best[2] / n + 1 - best[1] / p) / 2, best[0]


def test_eer_equals_the_plain_loop_with_ties_in_any_partitioning(spark):
    rng = random.Random(4)
    for n in (4, 30, 200):
        pairs = [(int(rng.random() < 0.4), round(rng.random(), 1 if n < 100 else 2)) for _ in range(n)] + [(0, 0.2), (1, 0.6)]
        for parts in (1, 5):
            hist = metrics.histogram(rows(spark, pairs, parts).selectExpr("*", "0 g"), "g")
            got = metrics.equal_error_rate(hist, ["g"]).head()
            want = brute_eer(pairs)
            assert got.eer == pytest.approx(want[0]) and got.eer_threshold == pytest.approx(want[1])


def test_separable_scores_and_constant_scores(spark):
    got = metrics.full_report(rows(spark, [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)])).head()
    assert (got.eer, got.auc, got.min_dcf, got.accuracy) == (0, 1, 0, 1) and got.threshold == pytest.approx(0.5)
    flat = metrics.full_report(rows(spark, [(0, 0.7), (1, 0.7)])).head()
    assert flat.threshold == 0.5 and flat.auc == 0.5


def test_one_class_has_no_eer_and_a_given_threshold_counts(spark):
    got = metrics.full_report(rows(spark, [(1, 0.3), (1, 0.6)]), threshold=0.4).head()
    assert got.eer is None and got.auc is None and got.balanced_accuracy is None
    assert (got.tp, got.fn, got.threshold) == (1, 1, 0.4)


def test_prefix_sums_equal_a_window_over_everything(spark):
    pairs = [(k % 3 == 0, (k * 7919 % 997) / 997) for k in range(997)]
    hist = metrics.histogram(rows(spark, pairs))
    got = {r.score: (r.cum_f, r.cum_r) for r in metrics.prefix_sums(hist, "score", ["f", "r"], buckets=7).collect()}
    f = r = 0
    for y, s in sorted(pairs, key=lambda q: -q[1]):
        f, r = f + y, r + (not y)
        assert got[s] == (f, r)


@pytest.mark.parametrize("range_rows", [1, 3, 7, 1000])
def test_scans_do_not_depend_on_where_ranges_end(spark, range_rows):
    """Borders fall within ties of rows, within groups and between them."""
    rng = random.Random(9)
    made = [(g, int(rng.random() < 0.5), rng.randint(0, 9) / 10) for g in (None, "a", "b", "c") for _ in range(40)] + [("one", 1, 0.5)] * 3 + [("reals", 0, x / 10) for x in range(5)]
    df = spark.createDataFrame([(g, "fake" if y else "real", s) for g, y, s in made], "g string, label string, score double").repartition(5)
    hist = metrics.histogram(df, "g")
    got = {(r.g, r.score): (r.tp, r.fp, r.p, r.n) for r in metrics.cumulated(hist, ["g"], range_rows).collect()}
    for g in {x[0] for x in made}:
        own = [(y, s) for h, y, s in made if h == g]
        for s in {s for _, s in own}:
            assert got[g, s] == (sum(y for y, x in own if x >= s), sum(1 - y for y, x in own if x >= s), sum(y for y, _ in own), sum(1 - y for y, _ in own))
    rates = {r.g: (r.eer, r.eer_threshold) for r in metrics.equal_error_rate(hist, ["g"], range_rows).collect()}
    assert set(rates) == {None, "a", "b", "c"}
    for g, (eer, threshold) in rates.items():
        want = brute_eer([(y, s) for h, y, s in made if h == g])
        assert eer == pytest.approx(want[0]) and threshold == pytest.approx(want[1])
    points = metrics.roc_points(hist, ["g"], range_rows)
    assert sorted((tuple(r) for r in points.collect()), key=repr) == sorted((tuple(r) for r in metrics.roc_points(hist, ["g"]).collect()), key=repr)


def test_ranges_follow_the_rows_and_no_window_has_a_whole_group(spark):
    hist = metrics.histogram(rows(spark, [(k % 2, k / 5000) for k in range(5000)]))
    got = metrics.scanned(hist, [], "score", ["f", "r"], range_rows=500)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    sums = [line for line in plan.splitlines() if "Window" in line and "row_number" in line and "sum(f" in line]
    assert sums and all("range_" in line for line in sums)
    assert [r.cum_f for r in got.orderBy("score").collect()][0] == 2500
    assert metrics.scanned(hist.limit(0), [], "score", ["f", "r"]).collect() == []
