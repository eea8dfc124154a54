import numpy as np
import pytest
from pyspark.sql import functions as F

from corvox.operators import augment, features, signal
from corvox.operators.signal import SPEC, AudioSpec


def test_wav_round_trip_and_formats(speech):
    x = speech(3.5)
    y, rate = signal.decode_wav(signal.encode_wav(x, 16_000))
    assert rate == 16_000 and np.abs(x - y).max() < 1e-4
    head = lambda tag, ch, bits, n: b"RIFF\0\0\0\0WAVEfmt " + (16).to_bytes(4, "little") + tag.to_bytes(2, "little") + ch.to_bytes(2, "little") + (8000).to_bytes(4, "little") + bytes(4) + (ch * bits // 8).to_bytes(2, "little") + bits.to_bytes(2, "little") + b"data" + n.to_bytes(4, "little")
    stereo = np.array([[0.5, -0.5], [0.25, 0.75]], dtype="<f4").tobytes()
    assert signal.decode_wav(head(3, 2, 32, len(stereo)) + stereo)[0].tolist() == [0.0, 0.5]
    deep = (int(-0.5 * 2**23) & 0xFFFFFF).to_bytes(3, "little")
    assert signal.decode_wav(head(1, 1, 24, 3) + deep)[0].tolist() == [-0.5]
    with pytest.raises(ValueError):
        signal.decode_wav(b"OggS")


def test_resampling_keeps_a_tone():
    t = np.arange(48_000) / 48_000
    y = signal.resample(np.sin(2 * np.pi * 440 * t).astype(np.float32), 48_000, 16_000)
    want = np.sin(2 * np.pi * 440 * np.arange(16_000) / 16_000)
    assert len(y) == 16_000 and np.abs(y - want)[200:-200].max() < 1e-2


def test_chain_trims_cuts_and_levels(speech):
    x = np.concatenate([np.zeros(32_000, np.float32), speech(4.5), np.zeros(32_000, np.float32)])
    (clip,) = signal.normalized_clips(x, 16_000)
    assert 4.4 * 16_000 < len(clip) < 4.8 * 16_000
    assert 20 * np.log10(np.sqrt(np.mean(clip**2))) == pytest.approx(-23, abs=0.1)
    assert [len(c) / 16_000 for c in signal.normalized_clips(speech(26.0), 16_000)] == pytest.approx([10, 10, 6], abs=0.1)
    assert signal.normalized_clips(speech(1.0), 16_000) == []
    assert len(signal.fit(speech(1.0), AudioSpec(short_policy="pad"))[0]) == SPEC.min_samples
    assert len(signal.fit(speech(26.0), AudioSpec(long_policy="crop"))[0]) == SPEC.max_samples


def test_expressions_agree_with_kernels(spark, speech):
    spec = AudioSpec(sample_rate=100)
    for seconds in (1.0, 5.0, 26.0):
        x = speech(seconds, 100) * 4
        row = spark.createDataFrame([(x.tolist(),)], "s array<double>").select(signal.levelled(F.col("s"), spec).alias("l"), signal.chunks(F.col("s"), spec).alias("c"), signal.quality(F.col("s"), spec).alias("q")).head()
        assert np.allclose(row.l, signal.level(x, spec), atol=1e-5)
        assert [len(c) for c in row.c] == [len(c) for c in signal.fit(x, spec)]
        assert ("too_short" in row.q, "too_long" in row.q) == (seconds < 3, seconds > 10)
    odd = spark.createDataFrame([([],), ([float("nan")] * 400,), ([1.0] * 400,)], "s array<double>").select(signal.quality(F.col("s"), spec).alias("q"))
    assert [r.q for r in odd.collect()] == [["empty"], ["nan_inf", "silent"], ["clipping"]]


def test_bad_files_are_rows(spark, speech):
    items = spark.createDataFrame([("a", bytearray(signal.encode_wav(speech(4.0), 16_000))), ("b", bytearray(b"no")), ("c", bytearray(signal.encode_wav(speech(1.0), 16_000))), ("d", None)], "key string, content binary")
    got = {(r.key, r.chunk): r.error for r in signal.normalise(items).collect()}
    assert got[("a", 0)] is None and got[("b", 0)] and got[("c", 0)] == "no usable clip" and got[("d", 0)]


def test_operations_give_finite_audio_and_a_tag(speech):
    x = speech(4.0)
    for name, op in augment.OPERATIONS.items():
        y, tag = op(x, 16_000, np.random.default_rng(1))
        z, again = op(x, 16_000, np.random.default_rng(1))
        assert tag and tag == again and np.isfinite(y).all() and np.array_equal(y, z), name
    noisy = augment.mix_at_snr(x, np.random.default_rng(2).standard_normal(len(x)), 10)
    assert 10 * np.log10(np.mean(x**2) / np.mean((noisy - x) ** 2)) == pytest.approx(10, abs=0.5)


def test_augmented_rows_inherit_and_are_made_once(spark, speech):
    clips = spark.createDataFrame([(f"u{k}", speech(4.0 + k / 10, seed=k).tolist()) for k in range(6)], "utt_id string, signal array<float>")
    rows = spark.createDataFrame([(f"u{k}", "real", f"s{k % 2}", "", "", "train" if k < 5 else "test", 4.0) for k in range(6)], "utt_id string, label string, speaker string, augment string, parent_utt_id string, split string, duration double")
    made = augment.augment_corpus(rows, clips, {"gain": 1.0, "gaussian_noise": 1.0}, copies=2).drop("signal").collect()
    assert len(made) == 10 and all(r.parent_utt_id == r.utt_id.split("-aug")[0] and r.split == "train" and "+" in r.augment for r in made)
    again = augment.augment_corpus(rows.union(spark.createDataFrame(made, rows.schema)), clips, {"gain": 1.0}, copies=2)
    assert again.count() == 0
    with pytest.raises(KeyError):
        augment.chain(rows, {"codec": 0.5})


def test_pooling_and_embedding(spark, speech):
    frames = spark.createDataFrame([([[1.0, -2.0], [3.0, -4.0]],)], "f array<array<double>>")
    got = frames.select(*(features.pooled(F.col("f"), how).alias(how) for how in features.POOLING)).head()
    assert (got.mean, got.max, got.first) == ([2, -3], [3, -2], [1, -2]) and got.mean_std == pytest.approx([2, -3, 1, 1])
    clips = spark.createDataFrame([("a", speech(4.0).tolist()), ("b", None)], "utt_id string, signal array<float>")
    out = features.embed(clips)
    assert [(r.utt_id, len(r.embedding)) for r in out.collect()] == [("a", 16)]
    assert features.embed(clips, existing=out).count() == 0


def test_drawn_clips_do_not_depend_on_partitions(spark, speech):
    noises = spark.createDataFrame([(f"n{k:02d}", [float(k + 1)] * 50) for k in range(23)], "id string, signal array<float>")
    rows = spark.createDataFrame([(f"u{k}", 0, ["background_noise"] if k % 3 else ["gain"], [0.1] * 20) for k in range(200)], "utt_id string, copy int, ops array<string>, signal array<float>")
    a = {r.utt_id: (r.noise_, r.noise and r.noise[0]) for r in augment.with_drawn(rows.repartition(1), noises.repartition(5), "background_noise", 7).collect()}
    b = {r.utt_id: (r.noise_, r.noise and r.noise[0]) for r in augment.with_drawn(rows.repartition(6), noises.repartition(1), "background_noise", 7).collect()}
    assert a == b and len({n for n, _ in a.values() if n}) > 18
    assert all((n is None) == (int(u[1:]) % 3 == 0) and (n is None or x == int(n[1:]) + 1) for u, (n, x) in a.items())
    plan = augment.with_drawn(rows, noises, "background_noise", 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in "".join(line for line in plan.splitlines() if "nr_" in line and "Join" in line)


def test_outcomes_add_up_to_the_drawn_copies(spark, speech):
    def broken(x, sr, rng, **_):
        raise ValueError("broken")

    def loud(x, sr, rng, **_):
        return np.zeros(10), "short"

    clips = spark.createDataFrame([(f"u{k}", speech(4.0, seed=k).tolist()) for k in range(11)], "utt_id string, signal array<float>")
    rows = [(f"u{k}", "real" if k < 8 else "fake", "s", "", "", "train", 4.0) for k in range(12)]
    rows.append(("u0-aug1", "real", "s", "gain", "u0", "train", 4.0))
    df = spark.createDataFrame(rows, "utt_id string, label string, speaker string, augment string, parent_utt_id string, split string, duration double")
    noises = spark.createDataFrame([("n1", speech(6.0, seed=90).tolist()), ("n2", speech(1.0, seed=91).tolist())], "id string, signal array<float>")
    rooms = spark.createDataFrame([("cathedral-of-light", [1.0, 0.5, 0.25])], "id string, signal array<float>")
    augment.register("broken", broken)
    augment.register("loud", loud)
    try:
        made, counters = augment.augment_counted(df, clips, {"broken": 0.5, "background_noise": 0.4, "reverb": 0.3, "loud": 0.2}, copies=3, noises=noises, rooms=rooms)
        got, n = made.collect(), counters.head()
        assert sum(n[c] for c in augment.COUNTERS) == 12 * 3 and n.skip_exists == 1 and n.created == len(got) > 0 and n.read_error > 0 and n.drop_invalid > 0 and n.failed_operations > 0 and n.skip_no_op > 0
        assert n.created_real == sum(r.label == "real" for r in got) and n.created_fake == n.created - n.created_real
        assert n.skewed == (n.created_fake > 0 and max(n.created_real, n.created_fake) > 1.25 * min(n.created_real, n.created_fake))
        tags = "+".join(r.augment for r in got)
        assert "rir:cathedral-of" in tags and "bg" in tags and "broken" not in tags
    finally:
        del augment.OPERATIONS["broken"], augment.OPERATIONS["loud"]
