import gzip
import hashlib
import statistics

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from corvox.operators import features, model, signal
from corvox.operators.signal import AudioSpec
from corvox.sources import layouts


def vectors(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(f"u{k:04d}", f"s{k}", "real", rng.standard_normal(4).tolist()) for k in range(n)]
    rows += [(f"z{k}", f"s{k}", "real", [1.0] * 4) for k in range(min(n, 3))] + [("f", "s0", "fake", [1.0] * 4), ("n", None, "real", [1.0] * 4), ("e", "", "real", [1.0] * 4)]
    return spark.createDataFrame(rows, "utt_id string, speaker string, label string, embedding array<double>")


def plain_circle(n, partners):
    order = sorted(range(n), key=lambda k: hashlib.sha1(f"s{k}".encode()).hexdigest())
    reach = n // 2 if partners is None else min(partners, n // 2)
    return {frozenset((f"u{order[k]:04d}", f"u{order[(k + j) % n]:04d}")) for k in range(n) for j in range(1, reach + 1)}


@pytest.mark.parametrize(("n", "partners"), [(0, 3), (1, 3), (2, 3), (6, 3), (7, 2), (9, None), (12, None), (23, 5)])
def test_speakers_stand_in_a_circle(spark, monkeypatch, n, partners):
    monkeypatch.setattr(features, "STRETCH", 4)
    df = vectors(spark, n) if n else vectors(spark, 1).limit(0)
    got = [frozenset((r.a, r.b)) for r in features.cross_speaker_pairs(df, partners).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_circle(n, partners)
    if partners is None or n <= 2 * partners + 1:
        assert len(got) == n * (n - 1) // 2


def test_the_circle_is_near_all_pairs_and_knows_no_partitions(spark):
    df = vectors(spark, 120, seed=4)
    some = {(r.a, r.b): r.similarity for r in features.cross_speaker_pairs(df, 15).collect()}
    again = {(r.a, r.b): r.similarity for r in features.cross_speaker_pairs(df.repartition(7), 15).collect()}
    every = [r.similarity for r in features.cross_speaker_pairs(df, None).collect()]
    assert some == again and len(some) == 120 * 15 and len(every) == 120 * 119 // 2
    assert statistics.median(some.values()) == pytest.approx(statistics.median(every), abs=0.05)


def test_what_a_row_shares_is_computed_once(spark):
    """With a mean or a gain computed again for every element these would take hours."""
    x = np.random.default_rng(1).standard_normal(100_000)
    row = spark.createDataFrame([(x.tolist(),), (None,)], "x array<double>").select(model.layer_norm(F.col("x")).alias("n"), signal.levelled(F.col("x"), AudioSpec()).alias("l"), features.pooled(F.array("x", "x"), "mean_std").alias("p")).collect()
    assert np.allclose(row[0].n, (x - x.mean()) / np.sqrt(x.var() + 1e-5))
    assert np.allclose(row[0].l, signal.level(x, AudioSpec()), atol=1e-5) and np.allclose(row[0].p[:100_000], x)
    assert row[1].n is None and row[1].l is None


def two_clouds(spark):
    rng = np.random.default_rng(0)
    rows = [(f"u{k}", "fake" if k % 2 else "real", "train" if k < 40 else "val", (rng.standard_normal(6) + k % 2 * np.array([1, -1] * 3)).tolist()) for k in range(80)]
    return spark.createDataFrame(rows, "utt_id string, label string, split string, embedding array<double>")


def test_a_run_goes_on_after_its_last_stored_step(spark, tmp_path):
    df, sink, fitted = two_clouds(spark), str(tmp_path / "sink"), []

    def head(d, p):
        if p.get("crash") and not fitted.count("crashed"):
            fitted.append("crashed")
            raise RuntimeError("lost")
        fitted.append(p["regParam"])
        return LogisticRegression(featuresCol="features", labelCol="y", weightCol="weight", regParam=p["regParam"])

    model.register("counted", head)
    try:
        ladder = [{"regParam": 1.0}, {"regParam": 0.1}, {"regParam": 0.01, "crash": True}, {"regParam": 0.001}]
        with pytest.raises(RuntimeError):
            model.fit(df, df, "counted", ladder, sink=sink, name="a")
        assert [r.step for r in model.histories(spark, sink).orderBy("step").collect()] == [0, 1]
        got, stats, facts, history = model.fit(df, df, "counted", ladder, sink=sink, name="a")
        assert fitted == [1.0, 0.1, "crashed", 0.01, 0.001]
        _, _, whole, plain = model.fit(df, df, "counted", ladder)
        assert facts == whole and history.orderBy("step").collect() == plain.orderBy("step").collect()
        n = len(fitted)
        again, stats2, facts2, _ = model.fit(df, df, "counted", ladder, sink=sink, name="a")
        assert len(fitted) == n and facts2 == facts
        a, b = ({r.utt_id: r.score for r in model.score(m, s, df, "counted").collect()} for m, s in ((got, stats), (again, stats2)))
        assert a == b
        model.fit(df, df, "counted", ladder[:1], sink=sink, name="b")
        assert model.histories(spark, sink).count() == 5
        done = {r.steps: r for r in model.summaries(spark, sink).collect()}
        assert set(done) == {1, 4} and done[4].best_step == facts["step"] and done[4].threshold == facts["threshold"] and not done[4].stopped_early
    finally:
        del model.HEADS["counted"]


def test_rows_without_features_are_counted(spark):
    df = two_clouds(spark)
    few = df.withColumn("embedding", F.when(F.col("utt_id") != "u1", F.col("embedding"))).where("utt_id <> 'u0'")
    assert {(r.split, r.label): (r.n, r.dropped) for r in model.feature_gaps(df, few).collect()} == {("train", "real"): (20, 1), ("train", "fake"): (20, 1), ("val", "real"): (20, 0), ("val", "fake"): (20, 0)}
    assert model.with_features(df.drop("embedding"), few).count() == 78


def test_directories_are_known_by_their_files_heads(spark, tmp_path):
    root = tmp_path / "a dir"
    (root / "data").mkdir(parents=True)
    for k in range(9):
        (root / f"{k}.x{k}").write_bytes(b"\x00\x01\x02")
        (root / f"{k}b.x{k}").write_bytes(b"\xff\x00")
    (root / "clips.bin").write_bytes(gzip.compress(b"many clips"))
    (root / "data" / "train.parquet").write_bytes(b"PAR1....")
    (root / "rows.txt").write_text("id,text\n1,một\n")
    (root / "nothing.md").write_text("")
    got = {r.suffix: (r.n, r.samples, r.kinds) for r in layouts.profile(spark, str(root)).collect()}
    assert got["parquet"] == (1, ["data/train.parquet"], ["table"]) and got["x0"] == (2, ["0.x0", "0b.x0"], ["other"])
    assert layouts.hints(layouts.profile(spark, str(root))) == ["no_audio", "tables"]  # the archive is not among the eight, and not called one
    for k in range(3):
        (root / f"more{k}.bin").write_bytes(gzip.compress(b"clips"))
    assert layouts.hints(layouts.profile(spark, str(root))) == ["no_audio", "archives", "tables"]
    (tmp_path / "none").mkdir()
    assert layouts.hints(layouts.profile(spark, str(tmp_path / "none"))) == ["empty", "no_audio"]
    assert [layouts.kind_of(h) for h in (b"", b"fLaC", b"{\"a\": 1}", b"a\tb\nc\td", b"plain words", "chữ".encode()[:-1], b" ")] == ["empty", "audio", "table", "table", "text", "text", "text"]


def test_sentences_of_a_file_or_the_built_in_ones(spark, tmp_path):
    (tmp_path / "s.txt").write_text(" một \n\nhai\n")
    assert [r.text for r in layouts.sentences(spark, str(tmp_path / "s.txt")).collect()] == ["một", "hai"]
    assert layouts.sentences(spark).count() == 20
