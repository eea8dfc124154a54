"""String, hash and score expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"
#: One symbol for each distinct word of a pair, as long as there are enough of them.
ALPHABET = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 4096))


def stable_hash(*parts: Column) -> Column:
    return F.sha1(F.concat_ws(SEPARATOR, *(p.cast("string") for p in parts)))


def stable_id(*parts: Column, length: int = 12) -> Column:
    """The first hex digits of a hash of the parts. 12 digits are 48 bits: for more than some 10 million rows of one
    source take more."""
    return F.substring(stable_hash(*parts), 1, length)


def slugify(text: Column, most: int = 48) -> Column:
    """Letters, digits, '.', '_' and '-' in lower case; runs of anything else are one '-'."""
    kept = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}._-]", "-"))
    bare = F.regexp_replace(F.regexp_replace(kept, r"^-+|-+$", ""), r"-{2,}", "-")
    return F.substring(F.coalesce(F.nullif(bare, F.lit("")), F.lit("unknown")), 1, most)


def utterance_id(source: Column, speaker: Column, key: Column, chunk: Column | None = None) -> Column:
    base = F.concat(slugify(source, 20), F.lit("-"), stable_id(source, speaker, key))
    return base if chunk is None else F.when(chunk > 0, F.concat(base, F.lit("-"), chunk.cast("string"))).otherwise(base)


def audio_path(utt_id: Column, label: Column, source: Column, speaker: Column, generator: Column, augment: Column) -> Column:
    """Where a clip lies below the corpus root."""
    file = F.concat(utt_id, F.lit(".wav"))
    voice = F.when(F.instr(generator, ":") > 0, F.split(generator, ":", 2)[1]).otherwise("")
    fake = F.concat_ws("/", F.lit("fake"), slugify(F.substring_index(generator, ":", 1)), slugify(F.coalesce(F.nullif(voice, F.lit("")), F.lit("default"))), file)
    real = F.concat_ws("/", F.lit("real"), slugify(source), slugify(F.coalesce(F.nullif(speaker, F.lit("")), F.lit("unknown"))), file)
    return F.when(augment != "", F.concat_ws("/", F.lit("aug"), file)).when(label == "fake", fake).otherwise(real)


def n_words(text: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != ""))


def is_usable(text: Column, least: int = 6, most: int = 40) -> Column:
    return n_words(text).between(least, most)


def lower_if_shouting(text: Column) -> Column:
    bare = F.trim(text)
    return F.when(bare.rlike(r"\p{L}") & ~bare.rlike(r"\p{Ll}"), F.lower(bare)).otherwise(bare)


def target_text(text: Column) -> Column:
    calm = lower_if_shouting(text)
    return F.when(calm.rlike(r"[.!?…]$"), calm).otherwise(F.concat(calm, F.lit(".")))


def reference_text(text: Column) -> Column:
    return F.when(F.trim(text) == "", None).otherwise(lower_if_shouting(text))


def as_sentence(text: Column) -> Column:
    bare = F.trim(text)
    return F.when(bare.rlike(r"[.!?…,;:]$"), bare).otherwise(F.concat(bare, F.lit(".")))


def generator_tag(engine: Column, voice: Column, variant: Column) -> Column:
    return F.concat_ws(":", engine, F.nullif(voice, F.lit("")), F.nullif(variant, F.lit("")))


def synthesis_key(ref_utt_id: Column, text: Column, voice: Column, variant: Column) -> Column:
    of = F.when(ref_utt_id != "", ref_utt_id).otherwise(F.concat(F.lit("fallback:"), stable_id(text)))
    return F.concat_ws("|", of, voice, F.nullif(variant, F.lit("")))


def words(text: Column) -> Column:
    spaced = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s]", " "))
    return F.filter(F.split(spaced, r"\s+"), lambda w: w != "")


def word_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Word-level edit distance over reference words; null for an empty reference. Each distinct word that both have is
    one symbol, so that the built-in levenshtein counts words: of ALPHABET first, then the code points from 2**16 on.
    Words that only one side has match nothing and share one symbol a side. Null too if a pair has more than 1,052,671
    distinct words in common, for which an edit distance is out of reach.

    The words and what they share are bound once a row, as the variables of transform() over a single element: written
    out within the inner functions they would be split and sorted anew for every word."""
    further = lambda at: F.decode(F.unhex(F.lpad(F.hex(at + (0x10000 - len(ALPHABET) - 1)), 8, "0")), "UTF-32")
    symbol = lambda at, alone: F.when(at == 0, alone).when(at <= len(ALPHABET), F.substring(F.lit(ALPHABET), at.cast("int"), F.lit(1))).otherwise(further(at))
    coded = lambda ws, own, alone: F.array_join(F.transform(ws, lambda w: symbol(F.array_position(own, w), alone)), "")
    bound = lambda value, then: F.transform(F.array(value), then)[0]

    def rate(pair: Column, own: Column) -> Column:
        apart = F.levenshtein(coded(pair["r"], own, F.lit("r")), coded(pair["h"], own, F.lit("h")))
        return F.when((F.size(pair["r"]) > 0) & (F.size(own) <= len(ALPHABET) + 0xFFFFF), apart / F.size(pair["r"]))

    return bound(F.struct(reference.alias("r"), hypothesis.alias("h")), lambda pair: bound(F.array_intersect(pair["r"], pair["h"]), lambda own: rate(pair, own)))


def predicted(score: Column, threshold: float | Column) -> Column:
    return F.when(score >= threshold, "fake").otherwise("real")


def confidence(score: Column, threshold: float) -> Column:
    return F.round(F.abs(score - threshold) / max(threshold, 1 - threshold), 4)


def condition(augment: Column) -> Column:
    return F.when(augment == "", "clean").otherwise("augmented")


def or_placeholder(value: Column, placeholder: str) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(placeholder))


def sigmoid(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def missing_tones(config_json: Column, families: tuple[str, ...] = ("vi",)) -> Column:
    """Of a voice's JSON config: which of the tone symbols 1 to 8 its phoneme map lacks, if its language family is
    tonal; an empty array for others and for what isn't JSON."""
    parsed = F.from_json(config_json, "language struct<family: string>, espeak struct<voice: string>, phoneme_id_map map<string, string>")
    family = F.coalesce(F.nullif(parsed["language"]["family"], F.lit("")), parsed["espeak"]["voice"])
    keys = F.coalesce(F.map_keys(parsed["phoneme_id_map"]), F.array().cast("array<string>"))
    lacking = F.array_except(F.array(*(F.lit(str(k)) for k in range(1, 9))), keys)
    return F.when(family.isin(*families), lacking).otherwise(F.array().cast("array<string>"))


def toneless(config_json: Column, families: tuple[str, ...] = ("vi",)) -> Column:
    """"all", "some" or "none" of the tone symbols are missing."""
    n = F.size(missing_tones(config_json, families))
    return F.when(n == 8, "all").when(n > 0, "some").otherwise("none")


def with_tones(voices, config: str = "config", families: tuple[str, ...] = ("vi",)):
    """The rows of a table of voices whose JSON config lacks no tone symbol; an error if none is left."""
    kept = voices.where(toneless(F.col(config), families) == "none")
    if kept.isEmpty():
        raise ValueError("every voice lacks tone symbols")
    return kept
