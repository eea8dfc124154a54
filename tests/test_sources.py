import pytest
from pyspark.sql import functions as F

from corvox.operators import detect, model
from corvox.operators.features import embed
from corvox.operators.signal import encode_wav
from corvox.sources import ingest, layouts
from corvox.schema import empty_manifest
from corvox.streaming import jobs


def wav(path, x, rate=16_000):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(encode_wav(x, rate))


@pytest.fixture()
def vivos(tmp_path, speech):
    for split, n in (("train", 3), ("test", 1)):
        lines = []
        for s in range(n):
            for k in range(2):
                name = f"VIVOS{split}{s}_R{k}"
                wav(tmp_path / "wrap" / split / "waves" / f"VIVOSSPK{split}{s}" / f"{name}.wav", speech(4.0 + k, seed=s))
                lines.append(f"{name} xin chào số {k}")
        (tmp_path / "wrap" / split / "prompts.txt").write_text("\n".join(lines))
    return tmp_path


def test_vivos_is_found_and_ingested_once(spark, vivos):
    name, score, root = layouts.detect(spark, str(vivos))
    assert (name, round(score, 1)) == ("vivos", 1.0) and root.endswith("/wrap")
    items = layouts.vivos(spark, root)
    assert {(r.speaker, r.text, r.split_hint) for r in items.collect()} >= {("VIVOSSPKtrain0", "xin chào số 1", "train"), ("VIVOSSPKtest0", "xin chào số 0", "test")}
    rows, clips, counters = ingest.ingest(items, empty_manifest(spark), "vivos", per_speaker=1)
    assert rows.count() == clips.count() == 4
    assert counters.head().asDict() == dict(kept=4, drop_invalid=0, skip_exists=0, skip_no_audio=0, skip_speaker_full=4)
    _, _, again = ingest.ingest(items, rows, "vivos")
    assert again.head().skip_exists == 4 and again.head().kept == 4
    limited, _, _ = ingest.ingest(items, empty_manifest(spark), "vivos", limit=3)
    assert limited.count() == 3
    issues, fixed = ingest.validate(rows, clips.limit(3))
    assert [r.code for r in issues.collect()] == ["missing"] and fixed.count() == 3


def test_common_voice_and_folders(spark, tmp_path, speech):
    cv = tmp_path / "cv"
    wav(cv / "clips" / "a.wav", speech(4.0))
    wav(cv / "clips" / "b.wav", speech(4.0))
    (cv / "validated.tsv").write_text("client_id\tpath\tsentence\nabcdefghijklmnopqrst\ta.mp3\tcâu một\n\tb.wav\t\"câu hai\n")
    got = {r.key: (r.speaker, r.text) for r in layouts.common_voice(spark, str(cv)).collect()}
    assert got == {"clips/a.wav": ("abcdefghijklmnop", "câu một"), "clips/b.wav": ("cv-unknown", '"câu hai')}
    assert layouts.detect(spark, str(cv))[0] == "common_voice"
    lab = tmp_path / "lab"
    wav(lab / "Real" / "spk1" / "a.wav", speech(4.0))
    wav(lab / "tts" / "engine9" / "b.wav", speech(4.0))
    (lab / "metadata.csv").write_text("a|raw|văn bản\n")
    (lab / "prompts.txt").write_text("a other\nb from prompts\n")
    got = {r.key: (r.label, r.generator, r.speaker, r.text) for r in layouts.labelled_folder(spark, str(lab)).collect()}
    assert got == {"Real/spk1/a.wav": ("real", "", "spk1", "văn bản"), "tts/engine9/b.wav": ("fake", "engine9", "engine9", "from prompts")}
    assert layouts.detect(spark, str(lab))[0] == "labeled_folder"
    plain = tmp_path / "plain"
    wav(plain / "x" / "spkA" / "c.wav", speech(4.0))
    (plain / "x" / "spkA" / "c.lab").write_text(" bên cạnh ")
    assert [(r.speaker, r.text) for r in layouts.folder(spark, str(plain)).collect()] == [("spkA", "bên cạnh")]
    assert {r.suffix: r.n for r in layouts.describe(spark, str(plain)).collect()} == {"wav": 1, "lab": 1}
    with pytest.raises(FileNotFoundError):
        layouts.detect(spark, str(tmp_path / "nothing"))


def test_table_source(spark):
    df = spark.createDataFrame([(("p", [0.1, 0.2], 8000), "nói", "s1")], "Audio struct<path: string, array: array<double>, sampling_rate: int>, sentence string, speaker_id string")
    got = layouts.table(df, "repo").head()
    assert (got.key, got.sample_rate, got.text, got.speaker) == ("p", 8000, "nói", "s1")


def test_train_save_detect_and_stream(spark, tmp_path, speech):
    import numpy as np

    rng, rows = np.random.default_rng(0), []
    for k in range(60):
        fake = k % 2
        rows.append((f"u{k}", "fake" if fake else "real", "train" if k < 40 else "val", (rng.standard_normal(6) + fake * np.array([3, -3, 3, -3, 3, -3])).tolist()))
    df = spark.createDataFrame(rows, "utt_id string, label string, split string, embedding array<double>")
    got, stats, facts, history = model.fit(df, df, "linear", [{"regParam": 0.1}, {"regParam": 0.01}])
    assert facts["val_eer"] < 0.2 and history.count() == 2
    model.save(str(tmp_path / "m"), got, stats, facts)
    back, stats, facts = model.load(spark, str(tmp_path / "m"))
    assert model.score(back, stats, df).count() == 60
    mlp, s2, f2, _ = model.fit(df, df, "mlp", [{"hidden": 8, "maxIter": 50}])
    assert f2["val_eer"] < 0.2
    with pytest.raises(ValueError, match="val"):
        model.fit(df, df.where("split = 'train' or label = 'real'"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = jobs.detect_rows(stream, back, stats, "linear", facts["threshold"]).writeStream.format("memory").queryName("found").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("found").count() == 60
    clips = spark.createDataFrame([(f"c{k}", speech(4.0, seed=k).tolist(), "fake" if k % 2 else "real", "train" if k < 8 else "val") for k in range(12)], "utt_id string, signal array<float>, label string, split string")
    vectors = embed(clips)
    head, st, fa, _ = model.fit(vectors, clips, "linear", [{"regParam": 0.1}])
    items = spark.createDataFrame([("ok", bytearray(encode_wav(speech(12.0), 16_000))), ("short", bytearray(encode_wav(speech(1.0), 16_000))), ("bad", bytearray(b"x"))], "key string, content binary")
    out = {r.key: r for r in detect.detect(items, head, st, fa).collect()}
    assert out["ok"].score is not None and out["short"].warning and out["short"].score is not None and out["bad"].error and out["bad"].score is None
    assert detect.threshold_of(0.2, {"threshold": 0.7}) == 0.2 and detect.threshold_of(None, {"threshold": 0.7}) == 0.7 and detect.threshold_of(None, {}) == 0.5


def test_files_that_arrive_are_taken_once(spark, tmp_path, speech):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    make = lambda b: b.selectExpr("element_at(split(path, '/'), -1) utt_id", "length")
    wav(tmp_path / "src" / "a.wav", speech(3.0))
    jobs.ingest_files(spark, src, out, cp, make).awaitTermination(60)
    wav(tmp_path / "src" / "b.wav", speech(3.0))
    wav(tmp_path / "src" / "more" / "a.wav", speech(3.5))
    jobs.ingest_files(spark, src, out, cp, make).awaitTermination(60)
    assert sorted(r.utt_id for r in spark.read.parquet(out).collect()) == ["a.wav", "b.wav"]


def plain_ingest(files, existing, limit, per_speaker):
    """files: (key, speaker, clips or None) in order."""
    counts, speakers, kept = dict.fromkeys(ingest.COUNTERS, 0), {}, []
    for key, speaker, n in files:
        if limit is not None and counts["kept"] >= limit:
            break
        if per_speaker is not None and speakers.get(speaker, 0) >= per_speaker:
            counts["skip_speaker_full"] += 1
        elif key in existing:
            counts["skip_exists"] += 1
            speakers[speaker] = speakers.get(speaker, 0) + 1
        elif n is None:
            counts["skip_no_audio"] += 1
        elif n == 0:
            counts["drop_invalid"] += 1
        else:
            counts["kept"] += n
            speakers[speaker] = speakers.get(speaker, 0) + 1
            kept.append(key)
    return counts, kept


@pytest.mark.parametrize(("limit", "per_speaker"), [(None, None), (5, None), (12, None), (None, 2), (6, 2), (1000, 3), (0, None)])
def test_files_are_taken_in_order_and_decoded_once_and_no_further(spark, monkeypatch, limit, per_speaker):
    """Clips are made up: a file's content says how many it has."""
    import random

    rng = random.Random(3)
    files = [(f"d/{k:03d}.wav", f"s{rng.randint(0, 4)}", rng.choice([None, 0, 1, 1, 1, 2, 3])) for k in range(60)]
    decoded = spark.sparkContext.accumulator(0)

    def normalise(items, spec):
        def run(batches):
            for b in batches:
                for r in b.itertuples():
                    decoded.add(1)
                    n = None if r.content is None else r.content[0]
                    out = [(r.key, k, [0.1] * 16_000, 1.0, None) for k in range(n or 0)] or [(r.key, 0, None, None, "no audio" if n is None else "no usable clip")]
                    yield pd.DataFrame(out, columns=["key", "chunk", "signal", "raw_seconds", "error"])

        return items.select("key", "content").mapInPandas(run, "key string, chunk int, signal array<float>, raw_seconds double, error string")

    import pandas as pd

    monkeypatch.setattr(ingest, "normalise", normalise)
    items = spark.createDataFrame([(k, s, None if n is None else bytearray([n]), "t") for k, s, n in files], "key string, speaker string, content binary, text string").repartition(3)
    with_ids = items.select("key", ingest.utterance_id(F.lit("src"), F.col("speaker"), F.col("key")).alias("utt_id")).collect()
    existing = {r.key: r.utt_id for r in with_ids if int(r.key[2:5]) % 9 == 4}
    manifest = spark.createDataFrame([(u,) for u in existing.values()], "utt_id string")
    rows, clips, counters = ingest.ingest(items, manifest, "src", limit=limit, per_speaker=per_speaker)
    want, kept = plain_ingest(files, existing, limit, per_speaker)
    of = {r.utt_id: r.key for r in with_ids}
    assert counters.head().asDict() == want
    assert sorted({of["-".join(r.utt_id.split("-")[:2])] for r in rows.collect()}) == kept and rows.count() == clips.count() == want["kept"]
    n, todo = decoded.value, [f for f in files if f[0] not in existing]
    assert n <= len(todo)
    if (limit, per_speaker) == (5, None):
        assert n <= 12
    if (limit, per_speaker) == (0, None):
        assert n == 0
    if (limit, per_speaker) == (None, 2):
        assert n < len(todo) * 0.8
    report = ingest.ingest_report(rows, counters).head()
    assert report.n_speakers == len({s for k, s, _ in files if k in kept}) and report.few_speakers == (0 < report.n_speakers < 3)


def test_a_limit_keeps_the_first_files(spark):
    items = spark.createDataFrame([(f"f{k:02d}", "s", None, "t") for k in range(40)], "key string, speaker string, content binary, text string")
    rows, clips, counters = ingest.ingest(items, empty_manifest(spark), "src", limit=10)
    assert counters.head().skip_no_audio == 40 and rows.count() == clips.count() == 0
    none, _, zero = ingest.ingest(items.limit(0), empty_manifest(spark), "src", limit=10)
    assert none.count() == 0 and sum(zero.head()) == 0
