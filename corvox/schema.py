"""The manifest: one row for each utterance, with fixed columns. What is missing is the empty string, not null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = 1
REAL, FAKE = "real", "fake"
SPLITS = ("train", "val", "test")

MANIFEST = T.StructType(
    [
        T.StructField("utt_id", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        *(T.StructField(c, T.StringType()) for c in ("label", "source", "speaker", "text", "generator", "ref_utt_id", "language")),
        T.StructField("duration", T.DoubleType()),
        T.StructField("sample_rate", T.IntegerType()),
        T.StructField("channels", T.IntegerType()),
        *(T.StructField(c, T.StringType()) for c in ("augment", "parent_utt_id", "split")),
        T.StructField("schema_version", T.IntegerType()),
    ]
)
#: What a column that a frame lacks is filled with; empty cells of a CSV are 0 or "" instead.
DEFAULTS = {"language": "vi", "sample_rate": 16000, "channels": 1, "schema_version": VERSION, "duration": 0.0}


def conformed(df: DataFrame) -> DataFrame:
    """df with exactly the manifest's columns: absent ones get their defaults, nulls become empty."""
    out = []
    for f in MANIFEST:
        empty = "" if isinstance(f.dataType, T.StringType) else 0
        value = F.col(f.name) if f.name in df.columns else F.lit(DEFAULTS.get(f.name, empty))
        out.append(F.coalesce(value.cast(f.dataType), F.lit(empty).cast(f.dataType)).alias(f.name))
    return df.select(*out)


def lenient(df: DataFrame) -> DataFrame:
    """Manifest rows from columns of strings: an absent or empty cell is "", 0.0 or 0, and "16000.0" is an integer."""
    out = []
    for f in MANIFEST:
        value = F.col(f.name) if f.name in df.columns else F.lit(None).cast("string")
        if isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(value, F.lit("")).alias(f.name))
        else:
            number = F.coalesce(F.nullif(F.trim(value), F.lit("")).cast("double"), F.lit(0.0))
            out.append(number.cast(f.dataType).alias(f.name))
    return df.select(*out)


def engine(generator: Column) -> Column:
    """What stands before the first colon."""
    return F.substring_index(generator, ":", 1)


def label_code(label: Column) -> Column:
    return F.when(label == REAL, 0).when(label == FAKE, 1)


def problems(df: DataFrame) -> Column:
    """Messages about each row that breaks the manifest's rules."""
    fake, made = F.col("label") == FAKE, F.col("generator") != ""
    checks = [
        (F.coalesce(F.col("utt_id"), F.lit("")) == "", "empty utt_id"),
        (~F.col("label").isin(REAL, FAKE), "unknown label"),
        (fake & ~made, "fake without generator"),
        ((F.col("label") == REAL) & made, "real with generator"),
    ]
    if "path" in df.columns:
        checks.append((F.coalesce(F.col("path"), F.lit("")) == "", "empty path"))
    return F.filter(F.array(*(F.when(c, F.lit(m)) for c, m in checks)), lambda m: m.isNotNull())


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MANIFEST)
