"""Planning of fake rows: which real rows they follow, in which voice, and which clips serve as reference."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import as_sentence, generator_tag, stable_hash, synthesis_key, utterance_id
from ..operators.corpus import chunk_members, synthesis_pool
from ..operators.signal import SPEC, AudioSpec, joined, normalized_clips
from ..sources.layouts import SENTENCES
from ..tables import held

VARIANTS, GAP, LEAST_REF, TARGET_REF, MOST_REF = 4, 0.3, 3.0, 12.0, 25.0
#: Short clips of a speaker that references() looks at: four of 3 s and the target itself, and one to spare.
FEW_SHORT = 6


def quota(n_real: int | Column, ratio: float, engines: int, count: int | None = None) -> int | Column:
    """Rows that each engine is to make, of a number or a column of numbers."""
    if count is not None:
        return count
    if isinstance(n_real, Column):
        return F.greatest(F.lit(1).cast("long"), F.floor(n_real * ratio / engines))
    return max(1, int(n_real * ratio / engines))


def targets(df: DataFrame, count: int, engine: str, least: int = 6, most: int = 40) -> DataFrame:
    """`count` real rows that fakes will follow, in rounds: each speaker's first row by id, then each one's second, and
    so on; within a round in the order of a hash of the speaker. at: the place in that order, from 0.

    Rounds are counted first, so that only whole rounds and part of one are numbered: no window goes over all rows."""
    pool = synthesis_pool(df, least, most)
    rounds = pool.withColumn("round_", F.row_number().over(Window.partitionBy("speaker").orderBy("utt_id"))).where(F.col("round_") <= count)
    order = Window.orderBy("round_", "h_", "speaker")
    few = rounds.withColumn("h_", stable_hash(F.lit("targets"), F.lit(engine), F.col("speaker"))).orderBy("round_", "h_", "speaker").limit(count)
    return few.withColumn("at", F.row_number().over(order) - 1).drop("round_", "h_")


def fallback_targets(spark: SparkSession, count: int, sentences: tuple[str, ...] = SENTENCES) -> DataFrame:
    """Sentences over and over, without speaker and real row."""
    texts = F.array(*(F.lit(s) for s in sentences))
    return spark.range(count).select(F.col("id").cast("int").alias("at"), F.element_at(texts, (F.col("id") % len(sentences)).cast("int") + 1).alias("text"), F.lit("").alias("utt_id"), F.lit("").alias("speaker"), F.lit("fallback").alias("source"))


def variant(utt_id: Column) -> Column:
    """0 to 3 by the target's id, so that a speaker's targets share few references."""
    return (F.conv(F.substring(stable_hash(F.lit("ref-variant"), utt_id), 1, 8), 16, 10).cast("long") % VARIANTS).cast("int")


def _more(duration: Column, first: Column) -> Column:
    """Seconds that one more reference adds: a gap goes before all but the first."""
    return duration + F.when(first, 0.0).otherwise(GAP)


def _candidates(usable: DataFrame) -> DataFrame:
    """speaker, variant, h_, ref, duration: all that references() may take, a bounded number a (speaker, variant).

    A clip of up to 12.7 s is never passed over before 12 s are reached, and four of them reach it: so the first five
    such clips in order, besides the target itself, are enough. A longer clip that fits ends the list; which one that
    is depends on the seconds so far alone: the first in order that fits, or the second if the first is the target.
    The seconds that may come about are sums of the first short clips, with one of them left out at most."""
    order = Window.partitionBy("speaker", "variant").orderBy("h_", "ref")
    shuffled = usable.withColumn("variant", F.explode(F.array(*(F.lit(k) for k in range(VARIANTS)))))
    shuffled = shuffled.withColumn("h_", stable_hash(F.lit("ref"), F.col("speaker"), F.col("variant"), F.col("ref"))).select("speaker", "variant", "h_", "ref", "duration")
    most_short = MOST_REF - TARGET_REF - GAP
    short = shuffled.where(F.col("duration") <= most_short).withColumn("at_", F.row_number().over(order)).where(F.col("at_") <= FEW_SHORT).drop("at_")
    few = short.groupBy("speaker", "variant").agg(F.transform(F.sort_array(F.collect_list(F.struct("h_", "ref", "duration"))), lambda x: x["duration"]).alias("d_"))
    without = lambda k: F.filter("d_", lambda d, i: i != k)
    added = lambda acc, d: F.concat(acc, F.array(F.element_at(acc, -1) + _more(d, F.size(acc) == 1)))
    sums = F.concat(*(F.aggregate(without(k), F.array(F.lit(0.0)), added) for k in range(-1, FEW_SHORT)))
    states = few.select("speaker", "variant", F.array_distinct(F.filter(sums, lambda s: s < TARGET_REF)).alias("sums_"))
    long = shuffled.where(F.col("duration") > most_short).join(states, ["speaker", "variant"], "left").withColumn("sum_", F.explode(F.coalesce("sums_", F.array(F.lit(0.0)))))
    fits = (F.col("sum_") == 0) | (F.col("sum_") + _more(F.col("duration"), F.lit(False)) <= MOST_REF)
    first = F.row_number().over(Window.partitionBy("speaker", "variant", "sum_").orderBy("h_", "ref"))
    ends = long.where(fits).withColumn("at_", first).where("at_ <= 2").select(*short.columns).distinct()
    return short.union(ends)


def references(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """utt_id, refs (ids in order), seconds for each wanted row (utt_id, speaker): other clips of its speaker, in the
    order of a hash of (speaker, variant), until 12 s with gaps of 0.3 s; one that would make more than 25 s is passed
    over. No row where there is none. A speaker with many rows, long clips among them or not, costs no more than the
    candidates that can be taken."""
    usable = df.where((F.col("label") == "real") & (F.col("augment") == "") & (F.trim("text") != "") & F.col("duration").between(LEAST_REF, MOST_REF))
    asked = held(wanted.select("utt_id", "speaker", variant(F.col("utt_id")).alias("variant")))  # read twice, and targets are made of all rows
    usable = usable.join(asked.select("speaker").distinct(), "speaker", "left_semi")  # other speakers' clips are no candidates
    usable = usable.join(chunk_members(df), "utt_id", "left_anti").select("speaker", F.col("utt_id").alias("ref"), "duration")
    lists = _candidates(usable).groupBy("speaker", "variant").agg(F.sort_array(F.collect_list(F.struct("h_", "ref", "duration"))).alias("list_"))
    # the target's id goes along in the state: a lambda that takes it from the row lets the filter below be pushed to a side without it
    start = F.struct(F.col("utt_id").alias("own"), F.array().cast("array<string>").alias("refs"), F.lit(0.0).alias("seconds"))

    def step(s: Column, x: Column) -> Column:
        more = _more(x["duration"], F.size(s["refs"]) == 0)
        skip = (s["seconds"] >= TARGET_REF) | (x["ref"] == s["own"]) | ((F.size(s["refs"]) > 0) & (s["seconds"] + more > MOST_REF))
        return F.when(skip, s).otherwise(F.struct(s["own"].alias("own"), F.concat(s["refs"], F.array(x["ref"])).alias("refs"), (s["seconds"] + more).alias("seconds")))

    chosen = asked.join(lists, ["speaker", "variant"]).select("utt_id", F.aggregate("list_", start, step).alias("s"))
    return chosen.where(F.size("s.refs") > 0).select("utt_id", "s.refs", "s.seconds")


def reference_audio(chosen: DataFrame, clips: DataFrame, manifest: DataFrame, spec: AudioSpec = SPEC) -> DataFrame:
    """utt_id, ref_signal, ref_text of each row of chosen (utt_id, refs): the clips of its references one after another
    with silence between them, and their texts in the same order, each as a sentence; a single one's text as it is.
    A reference without a clip is left out of both; a row without any is left out. clips: utt_id, signal.

    References are told apart by target and place, joined to their clips and texts by id, and put in order again; a
    target has five at most, whatever its speaker has."""
    one = chosen.select("utt_id", F.posexplode("refs").alias("at_", "ref_"))
    sounds = clips.where("signal is not null").select(F.col("utt_id").alias("ref_"), F.col("signal").alias("signal_"))
    texts = manifest.select(F.col("utt_id").alias("ref_"), F.coalesce("text", F.lit("")).alias("text_"))
    parts = one.join(sounds, "ref_").join(texts, "ref_", "left").groupBy("utt_id").agg(F.sort_array(F.collect_list(F.struct("at_", "signal_", F.coalesce("text_", F.lit("")).alias("text_")))).alias("p_"))
    said = F.array_join(F.transform("p_", lambda x: as_sentence(x["text_"])), " ")
    signal = joined(F.transform("p_", lambda x: x["signal_"].cast("array<double>")), int(GAP * spec.sample_rate))
    return parts.select("utt_id", signal.alias("ref_signal"), F.when(F.size("p_") == 1, F.col("p_")[0]["text_"]).otherwise(said).alias("ref_text"))


def plan_all(df: DataFrame, engine: str, voices: list[str], count: int, variant_name: str = "", clone: bool = False, least: int = 6, most: int = 40, sentences: tuple[str, ...] = SENTENCES, overwrite: bool = False) -> DataFrame:
    """A row for each target: utt_id, ref_utt_id, speaker, source, text, split, voice, generator, refs, at, seconds (of
    the references), status: skip_exists (the manifest has it), skip_no_reference (a cloning engine has nothing to go
    by) or todo."""
    split = F.col("split") if "split" in df.columns else F.lit("")
    own = held(targets(df, count, engine, least, most).select("utt_id", "speaker", "source", "text", split.alias("split"), "at"))  # read in several places
    if sentences:
        spare = fallback_targets(df.sparkSession, min(count, math.lcm(len(sentences), max(1, len(voices)))), sentences)
        any_own = F.broadcast(own.limit(1).select(F.lit(True).alias("own_")))  # a row at most
        own = own.unionByName(spare.withColumn("split", F.lit("")).join(any_own, F.col("own_"), "left_anti"))
    voice = F.element_at(F.array(*(F.lit(v) for v in voices)), (F.col("at") % len(voices)).cast("int") + 1) if voices else F.lit("")
    rows = own.withColumn("voice", voice)
    key = synthesis_key(F.col("utt_id"), F.col("text"), F.col("voice"), F.lit(variant_name))
    rows = rows.withColumn("new_", utterance_id(F.lit(engine), F.col("speaker"), key)).withColumn("generator", generator_tag(F.lit(engine), F.col("voice"), F.lit(variant_name)))
    none = F.array().cast("array<string>")
    if clone:
        rows = rows.join(references(df, rows), "utt_id", "left").withColumn("refs", F.coalesce("refs", none))
    else:
        rows = rows.withColumn("refs", none).withColumn("seconds", F.lit(None).cast("double"))
    known = df.select(F.col("utt_id").alias("new_"), F.lit(not overwrite).alias("known_"))
    status = F.when(F.col("known_"), "skip_exists").when((F.size("refs") == 0) & F.lit(clone), "skip_no_reference").otherwise("todo")
    rows = rows.join(known, "new_", "left")
    return rows.select(F.col("new_").alias("utt_id"), F.col("utt_id").alias("ref_utt_id"), "speaker", "source", "text", "split", "voice", "generator", "refs", "at", "seconds", status.alias("status"))


def plan(df: DataFrame, engine: str, voices: list[str], count: int, variant_name: str = "", clone: bool = False, least: int = 6, most: int = 40, sentences: tuple[str, ...] = SENTENCES) -> DataFrame:
    """A row for each fake to make: utt_id, ref_utt_id, speaker, source, text, voice, generator, refs. Rows that the
    manifest has already are left out, and, for a cloning engine, targets without a reference.

    Where no real row can be followed, the sentences take their place, each with each voice that comes to it once, as
    more would be the same fakes again; a cloning engine has no reference for them."""
    return plan_all(df, engine, voices, count, variant_name, clone, least, most, sentences).where("status = 'todo'").drop("seconds", "status")


#: (text, voice, reference) to (samples, rate). reference: the ids of the reference clips; for a cloning engine whose
#: rows come with ref_signal and ref_text, a pair of these.
Synthesiser = Callable[[str, str, object], tuple["list[float]", int]]
#: Engines by name, and what says whether one can be used.
SYNTHESISERS: dict[str, Synthesiser] = {}
AVAILABLE: dict[str, Callable[[], str]] = {}


def register(name: str, fn: Synthesiser, available: Callable[[], str] = str) -> None:
    """available() returns why the engine can't be used here, an empty text if it can."""
    if name in SYNTHESISERS:
        raise ValueError(f"{name} exists already")
    SYNTHESISERS[name], AVAILABLE[name] = fn, available


def engine_of(name: str) -> Synthesiser:
    """The engine of that name; an error at once if there is none or it can't be used."""
    if name not in SYNTHESISERS:
        raise KeyError(f"no engine {name}; there are {', '.join(sorted(SYNTHESISERS))}")
    if why := AVAILABLE[name]():
        raise RuntimeError(f"engine {name} can't be used: {why}")
    return SYNTHESISERS[name]


def tone(text: str, voice: str, refs: list) -> tuple[list[float], int]:
    """A deterministic engine for tests: a tone whose pitch follows the text and the voice."""
    import zlib

    import numpy as np

    pitch = 110 + zlib.crc32(f"{voice}|{text}".encode()) % 220
    return (0.3 * np.sin(2 * np.pi * pitch * np.arange(5 * 24000) / 24000)).astype(np.float32).tolist(), 24000


register("tone", tone)


#: The error of a row whose samples give no clip of the wanted length.
NO_CLIP = "no usable clip"
PLANNED = ("utt_id", "ref_utt_id", "speaker", "source", "text", "split", "voice", "generator")


def _made(rows: DataFrame, engine: str, spec: AudioSpec, kept: tuple[str, ...]) -> DataFrame:
    """The kept columns (texts) of each row with chunk, signal, error; a row a clip."""
    make = engine_of(engine)
    heard = "ref_signal" in rows.columns
    schema = ", ".join(f"{c} string" for c in kept) + ", chunk int, signal array<float>, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            for r in batch.itertuples():
                own = tuple(getattr(r, c) for c in kept)
                try:
                    reference = (np.asarray(r.ref_signal, dtype=np.float32), r.ref_text) if heard else list(r.refs)
                    samples, rate = make(r.text, r.voice, reference)
                    clips = normalized_clips(np.asarray(samples, dtype=np.float32), rate, spec)
                    out = [(*own, k, c.tolist(), None) for k, c in enumerate(clips)] or [(*own, 0, None, NO_CLIP)]
                except Exception as e:  # noqa: BLE001  any engine error is that row's
                    out = [(*own, 0, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(out, columns=[*kept, "chunk", "signal", "error"])

    needed = dict.fromkeys([*kept, "utt_id", "text", "voice", *(["ref_signal", "ref_text"] if heard else ["refs"])])
    return rows.select(*needed).mapInPandas(run, schema)


def synthesise(rows: DataFrame, engine: str, spec: AudioSpec = SPEC) -> DataFrame:
    """utt_id, chunk, signal, error for each planned row: a row that fails is a row with an error, not a failed job. Rows
    with ref_signal and ref_text (see reference_audio) hand these to the engine."""
    return _made(rows, engine, spec, ("utt_id",))


def generate(df: DataFrame, engine: str, voices: list[str], count: int, append: Callable[[DataFrame], None], clips: DataFrame | None = None, clone: bool = False, overwrite: bool = False, spec: AudioSpec = SPEC, **options) -> dict:
    """Plans and makes an engine's fakes and hands their rows, with signal, to append, which stores them by one action.
    Returns counters: kept (clips), error, drop_invalid (no clip of the wanted length), skip_exists, skip_no_reference;
    mean_reference (seconds); many_dropped (more than a quarter of what was made gave no clip) and short_references (the
    mean is less than 0.6 of the 12 s wanted). clips: utt_id, signal, which a cloning engine's references come from.

    Counters are observed in the pass that append runs, so each row is planned and made once; a task that runs again
    counts once. append must run an action on what it gets."""
    engine_of(engine)
    is_ = lambda s: F.count_if(F.col("status") == s).alias(s)
    planned, done = Observation(), Observation()
    mean = F.avg(F.when((F.col("status") == "todo") & (F.size("refs") > 0), F.col("seconds"))).alias("mean_reference")
    rows = plan_all(df, engine, voices, count, clone=clone, overwrite=overwrite, **options).observe(planned, is_("skip_exists"), is_("skip_no_reference"), mean)
    todo = rows.where("status = 'todo'")
    if clone and clips is not None:
        todo = todo.join(reference_audio(todo.select("utt_id", "refs"), clips, df, spec), "utt_id", "left")
    bad, failed = F.col("error") == NO_CLIP, F.col("error").isNotNull()
    made = _made(todo, engine, spec, PLANNED).observe(done, F.count_if(~failed).alias("kept"), F.count_if(failed & ~bad).alias("error"), F.count_if(failed & bad).alias("drop_invalid"))
    label = F.lit("fake").alias("label")
    new = F.when(F.col("chunk") > 0, F.concat("utt_id", F.lit("-"), F.col("chunk").cast("string"))).otherwise(F.col("utt_id")).alias("utt_id")
    seconds = F.round(F.size("signal") / spec.sample_rate, 3).alias("duration")
    append(made.where("error is null").select(new, label, "source", "speaker", "text", "generator", "ref_utt_id", "split", seconds, F.lit(spec.sample_rate).alias("sample_rate"), "signal"))
    out = done.get | planned.get
    tried = out["kept"] + out["error"] + out["drop_invalid"]
    return out | {"many_dropped": out["drop_invalid"] > 0.25 * tried, "short_references": out["mean_reference"] is not None and out["mean_reference"] < 0.6 * TARGET_REF}


def run_engines(df: DataFrame, engines: dict[str, dict], append: Callable[[str, DataFrame], None]) -> list[tuple[str, str]]:
    """Plans and makes the fakes of one engine after the other and hands them to append, which stores them: what one
    engine has made stays when the next fails. (engine, status) of each; an unknown name is an error before any runs."""
    unknown = set(engines) - set(SYNTHESISERS)
    if unknown:
        raise KeyError(f"no such engines: {', '.join(sorted(unknown))}")
    out = []
    for name, options in engines.items():
        try:
            append(name, synthesise(plan(df, name, **options), name))
            out.append((name, "done"))
        except Exception as e:  # noqa: BLE001  reported; the other engines go on
            out.append((name, f"failed: {e}"))
    return out
