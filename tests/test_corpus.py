import random
import statistics

import pytest
from pyspark.sql import functions as F

from corvox import queries
from corvox.functions import text as X
from corvox.operators import corpus, splits
from corvox.plans import stages, synthesis
from corvox.schema import conformed, problems
from corvox.sources import layouts, manifest


def make(spark, rows):
    return conformed(spark.createDataFrame(rows))


def row(utt_id, label="real", **more):
    return dict(dict(utt_id=utt_id, path=f"{utt_id}.wav", label=label, source="s", speaker="a", text="one two three four five six seven", generator="" if label == "real" else "eng:v", ref_utt_id="", duration=4.0, augment="", parent_utt_id="", split=""), **more)


def test_csv_is_typed_leniently_and_round_trips(spark, tmp_path):
    (tmp_path / "m.csv").write_text('utt_id,path,label,duration,sample_rate,text\nu1,p,real,,16000.0,"a ""b"", c"\nu2,p,fake,3.5,,\n')
    got = {r.utt_id: r for r in manifest.read_csv(spark, str(tmp_path / "m.csv")).collect()}
    assert (got["u1"].duration, got["u1"].sample_rate, got["u1"].text, got["u1"].language) == (0.0, 16000, 'a "b", c', "")
    manifest.write_csv(manifest.read_csv(spark, str(tmp_path / "m.csv")), str(tmp_path / "out"))
    assert {r.utt_id: r for r in manifest.read_csv(spark, str(tmp_path / "out")).collect()} == got
    assert manifest.read_csv(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception):
        manifest.read_csv(spark, str(tmp_path / "none"), required=True).count()


def test_snapshots_and_exports(spark, tmp_path):
    root, rows = str(tmp_path / "c"), make(spark, [row("u1"), row("u2")])
    assert manifest.load(spark, root).count() == 0
    manifest.save(rows.limit(1), root)
    manifest.save(rows, root)
    assert manifest.load(spark, root).count() == 2
    clips = spark.createDataFrame([("u1", [0.1]), ("other", [0.2])], "utt_id string, signal array<float>")
    manifest.export_corpus(rows, clips, str(tmp_path / "x"))
    back, sounds = manifest.import_corpus(spark, str(tmp_path / "x"), rows.limit(0), clips.limit(0))
    assert [r.utt_id for r in back.collect()] == ["u1"] and sounds.count() == 1
    with pytest.raises(FileNotFoundError):
        manifest.import_corpus(spark, str(tmp_path / "none"), rows, clips)


def test_problems_upsert_and_pieces(spark):
    rows = make(spark, [row("", path=""), row("u", "odd"), row("f", "fake", generator=""), row("r", generator="x")])
    assert {r.utt_id: r.p for r in rows.select("utt_id", problems(rows).alias("p")).collect()} == {"": ["empty utt_id", "empty path"], "u": ["unknown label"], "f": ["fake without generator"], "r": ["real with generator"]}
    batch = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "b")], "utt_id string, at int, v string")
    base = spark.createDataFrame([("a", "base"), ("c", "c")], "utt_id string, v string")
    assert {(r.utt_id, r.v) for r in corpus.upsert(base, batch, "at").collect()} == {("a", "new"), ("b", "b"), ("c", "c")}
    ids = spark.createDataFrame([(x,) for x in ("x", "x-1", "x-2", "y", "z-7")], "utt_id string")
    assert {r.utt_id for r in corpus.chunk_members(ids).collect()} == {"x", "x-1", "x-2"}
    with pytest.raises(KeyError):
        corpus.where_equal(base, nope=1)


def test_text_expressions(spark):
    one = lambda e, t: spark.createDataFrame([(t,)], "t string").select(e(F.col("t"))).head()[0]
    assert one(X.slugify, "--Xin chào, Việt Nam!--") == "xin-chào-việt-nam" and one(X.slugify, "!!!") == "unknown"
    assert one(X.target_text, " XIN CHÀO ") == "xin chào." and one(X.target_text, "Được rồi!") == "Được rồi!"
    assert one(X.reference_text, "  ") is None and one(X.as_sentence, "a,") == "a,"
    a, b = X.words(F.lit("a b c d")), X.words(F.lit("A x c"))
    assert spark.range(1).select(X.word_error_rate(a, b)).head()[0] == 0.5
    config = '{"language": {"family": "vi"}, "phoneme_id_map": {"1": [1], "2": [2]}}'
    assert one(X.toneless, config) == "some" and one(X.toneless, "{") == "none" and one(X.toneless, '{"language": {"family": "vi"}}') == "all"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_word_error_rates_take_whole_texts(spark, tmp_path):
    rng = random.Random(1)
    turns = [(c, t, "user" if t % 2 else "assistant", " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 120)))) for c in range(6) for t in range(1, 7)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    said = {(c, t): x.split() for c, t, _, x in turns}
    want = {(c, t): round(edits(w, said[c, t + 1]) / len(w), 6) for (c, t), w in said.items() if t % 2 and (c, t + 1) in said}
    assert {(r.conv_id, r.turn): r.wer for r in queries.word_error_rates_whole(spark, str(tmp_path)).collect()} == want and len(want) == 18
    for r in queries.pronunciation_audit_whole(spark, str(tmp_path)).collect():
        own = [w for (c, t), w in want.items() if r.grp == ("(real)" if t % 4 == 0 else f"eng_{c % 3}")]
        assert r.n == len(own) and r.wer == pytest.approx(statistics.median(own), abs=1e-6)
        c, t = map(int, r.worst.split("-"))
        assert want[c, t] == max(own)


def test_word_error_rates_of_many_distinct_words(spark):
    a = [f"a{k}" for k in range(4500)]
    b = [*a[:4300], *(f"b{k}" for k in range(200))]
    df = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    assert df.select(X.word_error_rate(F.col("a"), F.col("b"))).head()[0] == pytest.approx(200 / 4500)


def test_splits_are_disjoint_and_do_not_depend_on_partitions(spark):
    rows = [row(f"u{k}", "fake" if k % 2 else "real", speaker="" if k % 10 == 0 else f"s{k % 37}") for k in range(300)]
    rows += [row(f"u{k}-aug0", augment="gain", parent_utt_id=f"u{k}", speaker="" if k % 10 == 0 else f"s{k % 37}") for k in range(0, 300, 5)]
    df = make(spark, rows)
    a = {r.utt_id: r.split for r in splits.assign(df.repartition(1)).collect()}
    assert a == {r.utt_id: r.split for r in splits.assign(df.repartition(7)).collect()} and len(a) == len(rows)
    assert all(a[r["utt_id"]] == a[r["parent_utt_id"]] for r in rows if r["parent_utt_id"])
    assert splits.leaks(splits.assign(df)).count() == 0
    held = splits.assign(df, holdout=("ENG",))
    assert {r.split for r in held.where("label = 'fake'").collect()} == {"test"}
    assert {r.cause for r in splits.leaks(held, ("eng",)).collect()} == {"holdout"}
    with pytest.raises(ValueError, match="fake"):
        splits.assert_complete(held)
    with pytest.raises(ValueError):
        splits.assign(df, (0.5, 0.1, 0.1))
    hinted = df.withColumn("hint", F.when(F.col("speaker").isin("s1", "s2"), "test").when(F.col("speaker") == "s3", "train").otherwise(""))
    got = {r.speaker: r.split for r in splits.assign(hinted, hints="hint").where("speaker <> ''").collect()}
    assert got["s1"] == got["s2"] == "test" and sum(s == "val" for s in got.values()) == 5


def test_chunk_members_with_many_pieces_of_one_base(spark, monkeypatch):
    monkeypatch.setattr(corpus, "PIECES", 3, raising=False)
    names = [f"utt-{k}" for k in range(2, 30)] + ["a", *(f"a-{k}" for k in range(20)), "b", "b-2", "c-1", "d-1-1", "d-1", "", "-1", "e\n", "e\n-1", "f-1\n", "f"]
    known = set(names)
    base = {n: n.rpartition("-")[0] for n in names if "-" in n and n.rpartition("-")[2].isdecimal() and n[-1] != "\n"}
    want = {n for n in names if n + "-1" in known or base.get(n) in known}
    got = corpus.chunk_members(spark.createDataFrame([(n,) for n in names], "utt_id string").union(spark.createDataFrame([(None,), ("b-2",)], "utt_id string"))).collect()
    assert {r.utt_id for r in got} == want and len(got) == len(want) and {"", "-1", "e\n", "a", "a-19"} <= want and not {"utt-2", "c-1", "f-1\n"} & want


def test_rows_without_a_parent_are_dealt_out(spark):
    df = make(spark, [row(f"u{k:03d}", split="train" if k % 2 else "test") for k in range(400)] + [row("c", augment="x", parent_utt_id="u001"), row("d", augment="x", parent_utt_id="none", split="val"), row("e", augment="x", parent_utt_id=None, split="val")])
    own = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(own, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        got = corpus.with_parent(df, ["split"]).select("utt_id", "split", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in own.items():
            spark.conf.set(k, v)
    assert max(sum(r.task == t for r in got) for t in {r.task for r in got}) < 200
    split = {r.utt_id: r.split for r in got}
    assert len(got) == len(split) == 403 and (split["c"], split["d"], split["e"], split["u001"], split["u002"]) == ("train", "val", "val", "train", "test")
    # an empty id is a parent like any other
    odd = make(spark, [row("", split="val"), *(row(f"u{k}", split="test") for k in range(20))])
    assert {r.split for r in corpus.with_parent(odd, ["split"]).collect()} == {"val"}


def test_only_wanted_speakers_have_candidates(spark, monkeypatch):
    df, seen, real = make(spark, [row(f"u{k}", speaker=f"s{k % 5}") for k in range(40)]), [], synthesis._candidates
    monkeypatch.setattr(synthesis, "_candidates", lambda usable: seen.append({r.speaker for r in usable.collect()}) or real(usable))
    got = synthesis.references(df, df.where("speaker = 's1'").select("utt_id", "speaker")).collect()
    assert len(got) == 8 and seen == [{"s1"}]


def test_counters_look_for_references_once(spark, monkeypatch):
    calls, real = [], synthesis.references
    monkeypatch.setattr(synthesis, "references", lambda *a: calls.append(1) or real(*a))
    (got,) = queries.QUERIES["generation_counters"](spark, "/root/testdata/sf0.001").collect()
    assert len(calls) == 1 and got.skip_exists > 0 and got.todo > 0


def test_round_robin_and_references_against_loops(spark):
    rows = [row(f"u{k:03d}", speaker=f"s{k % 7 % 4}", duration=3.0 + k % 6) for k in range(60)] + [row("long", speaker="s0", duration=20.0), row("long-1", speaker="s0")]
    df = make(spark, rows)
    got = synthesis.targets(df, 25, "e").orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(25))
    seen: dict = {}
    for r in got:
        seen.setdefault(r.speaker, []).append(r.utt_id)
    assert all(v == sorted(v) for v in seen.values()) and max(map(len, seen.values())) - min(map(len, seen.values())) <= 1
    duration = {r["utt_id"]: r["duration"] for r in rows}
    for r in synthesis.references(df, df.select("utt_id", "speaker")).collect():
        total = sum(duration[x] for x in r.refs) + 0.3 * (len(r.refs) - 1)
        assert r.utt_id not in r.refs and not {"long", "long-1"} & set(r.refs) and total == pytest.approx(r.seconds) and total <= 25
        assert total >= 12 and total - duration[r.refs[-1]] - 0.3 < 12
    # with a usable long clip all candidates are kept, and one that doesn't fit is passed over
    more = make(spark, [*rows[:60], row("big", speaker="s0", duration=24.0)])
    for r in synthesis.references(more, more.where("speaker = 's0'").select("utt_id", "speaker")).collect():
        assert r.seconds <= 25


def test_sentences_take_the_place_of_missing_targets(spark):
    df = make(spark, [row(f"u{k}", speaker=f"s{k % 3}", text="") for k in range(6)])
    got = synthesis.plan(df, "tone", ["a", "b"], 7).collect()
    assert {(r.speaker, r.source, r.ref_utt_id) for r in got} == {("", "fallback", "")}
    assert len({r.utt_id for r in got}) == len({(r.text, r.voice) for r in got}) == len(got) == 7
    assert {r.text for r in got} == set(layouts.SENTENCES[:7]) and len(set(layouts.SENTENCES)) == 20
    assert synthesis.plan(df, "tone", ["a", "b"], 100).count() == 20 and synthesis.plan(df, "tone", ["a"], 3, sentences=()).count() == 0
    assert synthesis.plan(df, "tone", ["a"], 3, clone=True).count() == 0
    some = make(spark, [row("u0", speaker="s0")])
    assert [r.ref_utt_id for r in synthesis.plan(some, "tone", ["a"], 4).collect()] == ["u0"]


def test_synthesis_plan_is_made_once(spark):
    df = make(spark, [row(f"u{k}", speaker=f"s{k % 3}") for k in range(12)])
    plan = synthesis.plan(df, "tone", ["a", "b"], 6)
    made = synthesis.synthesise(plan, "tone").where("error is null")
    assert plan.count() == 6 and made.select("utt_id").distinct().count() == 6
    assert synthesis.plan(df.unionByName(conformed(plan)), "tone", ["a", "b"], 6).count() == 0
    with pytest.raises(KeyError):
        synthesis.run_engines(df, {"none": {}}, lambda *_: None)
    assert synthesis.quota(100, 0.5, 3) == 16 and synthesis.quota(0, 0.5, 3) == 1


def test_stages_stop_at_the_first_failure():
    done = []
    jobs = {s: (lambda s=s: done.append(s) or s != "split") for s in ("augment", "split", "ingest")}
    assert stages.run(jobs, skip=("ingest",)) == [("ingest", "skipped"), ("split", "failed")] and done == ["split"]
    with pytest.raises(KeyError):
        stages.run({"nope": lambda: True})


def test_columns_are_resolved_by_name():
    assert layouts.resolve(["ID", "Sentence", "Audio"], layouts.TEXT_COLUMNS) == "Sentence" and layouts.resolve(["x"], layouts.AUDIO_COLUMNS) is None


def plain_references(rows, own, speaker):
    """rows: utt_id to (speaker, duration)."""
    import hashlib

    sha = lambda *parts: hashlib.sha1("\x1f".join(map(str, parts)).encode()).hexdigest()
    variant = int(sha("ref-variant", own)[:8], 16) % 4
    refs, seconds = [], 0.0
    for _, u in sorted((sha("ref", speaker, variant, u), u) for u, (s, d) in rows.items() if s == speaker and 3 <= d <= 25 and u != own):
        more = rows[u][1] + (0.3 if refs else 0.0)
        if seconds < 12 and not (refs and seconds + more > 25):
            refs, seconds = [*refs, u], seconds + more
    return refs, seconds


@pytest.mark.parametrize("seed", [1, 2])
def test_references_with_long_clips_are_those_of_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    of = {f"u{k}x": (f"s{k % 5}", round(rng.choice([rng.uniform(3, 25), rng.uniform(12, 16), rng.uniform(3, 6)]), 2)) for k in range(150)}
    of |= {f"h{k}x": ("hot", 21.0 if k % 50 else 5.0) for k in range(400)} | {f"l{k}x": ("longs", 14.0 + k % 3) for k in range(9)} | {"a0x": ("alone", 7.0), "p0x": ("two", 11.0), "p1x": ("two", 24.0)}
    df = make(spark, [row(u, speaker=s, duration=d) for u, (s, d) in of.items()])
    got = {r.utt_id: (r.refs, r.seconds) for r in synthesis.references(df, df.select("utt_id", "speaker")).collect()}
    for u, (s, _) in of.items():
        refs, seconds = plain_references(of, u, s)
        assert (got[u][0] == refs and got[u][1] == pytest.approx(seconds)) if refs else u not in got
    few = synthesis._candidates(df.select("speaker", F.col("utt_id").alias("ref"), "duration")).groupBy("speaker", "variant").count()
    assert few.agg(F.max("count")).head()[0] <= 60


def test_generation_is_counted_in_the_pass_that_appends(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    rate = 16_000

    def odd(text, voice, reference):
        calls.add(1)
        k = int(text.split()[0][1:])
        if k % 5 == 0:
            raise OSError("no device")
        return synthesis.tone(text, voice, [])[0][: rate if k % 5 == 1 else None], 24_000

    synthesis.register("odd", odd)
    try:
        df = make(spark, [row(f"u{k}", speaker=f"s{k % 3}", text=f"n{k} two three four five six seven") for k in range(20)])
        path = str(tmp_path / "made")
        first = synthesis.plan(df, "odd", ["v"], 20).where("at < 4").select("utt_id").collect()
        have = df.unionByName(make(spark, [row(r.utt_id, "fake") for r in first]))
        got = synthesis.generate(have, "odd", ["v"], 20, lambda rows: rows.write.parquet(path))
        made = spark.read.parquet(path)
        assert calls.value == 16 and got["skip_exists"] == 4 and got["skip_no_reference"] == 0 and got["mean_reference"] is None
        assert got["kept"] == made.count() == 16 - got["error"] - got["drop_invalid"] and got["many_dropped"] == (got["drop_invalid"] > 4)
        texts = [int(r.text[1:].split()[0]) for r in synthesis.plan(have, "odd", ["v"], 20).collect()]
        assert got["error"] == sum(k % 5 == 0 for k in texts) and got["drop_invalid"] == sum(k % 5 == 1 for k in texts)
        assert {r.label for r in made.collect()} == {"fake"} and made.where("size(signal) > 0 and ref_utt_id like 'u%'").count() == made.count()
        synthesis.register("absent", odd, lambda: "no graphics card")
        with pytest.raises(RuntimeError, match="graphics"):
            synthesis.synthesise(df, "absent")
    finally:
        for name in ("odd", "absent"):
            synthesis.SYNTHESISERS.pop(name, None)
            synthesis.AVAILABLE.pop(name, None)


def test_references_go_to_the_engine_with_their_texts(spark, tmp_path):
    seen = []

    def clone(text, voice, reference):
        signal, said = reference
        return [0.2] * int(4 * 16_000) if len(signal) == 8 * 3 + 4 * 2 and said == "A b c d e f. G h i j k l, M n o p q r." else [], 16_000

    synthesis.register("clone", clone)
    try:
        spec = synthesis.AudioSpec(sample_rate=16_000)
        chosen = spark.createDataFrame([("t", ["c", "a", "b"]), ("one", ["a"]), ("none", ["gone"])], "utt_id string, refs array<string>")
        texts = {"c": "A b c d e f", "a": " G h i j k l, ", "b": "M n o p q r."}
        manifest = spark.createDataFrame(list(texts.items()), "utt_id string, text string")
        clips = spark.createDataFrame([("a", [1.0] * 8), ("b", [2.0] * 8), ("c", [3.0] * 8), ("a2", None)], "utt_id string, signal array<float>")
        got = {r.utt_id: r for r in synthesis.reference_audio(chosen, clips, manifest, synthesis.AudioSpec(sample_rate=15)).collect()}
        assert got["t"].ref_signal == [3.0] * 8 + [0.0] * 4 + [1.0] * 8 + [0.0] * 4 + [2.0] * 8 and got["t"].ref_text == "A b c d e f. G h i j k l, M n o p q r."
        assert got["one"].ref_signal == [1.0] * 8 and got["one"].ref_text == " G h i j k l, " and "none" not in got
        df = make(spark, [row(f"u{k}", speaker="s0" if k < 6 else "s1", duration=5.0) for k in range(7)])
        sounds = df.select("utt_id", F.array_repeat(F.lit(0.5), 20).alias("signal"))
        out = synthesis.generate(df, "clone", ["v"], 7, lambda rows: seen.append(rows.count()), clips=sounds, clone=True, spec=spec)
        assert (out["skip_no_reference"], out["drop_invalid"], out["kept"], out["error"]) == (1, 6, 0, 0) and out["mean_reference"] > 12 and not out["short_references"] and out["many_dropped"]
    finally:
        synthesis.SYNTHESISERS.pop("clone", None)
        synthesis.AVAILABLE.pop("clone", None)
