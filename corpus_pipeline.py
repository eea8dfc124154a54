"""The corpus pipeline: toxic documents go, one document of each group of near copies stays, benchmark passages and
secrets are taken out of texts, and what is left is packed into sequences. Every stage gets all that the one before
it kept, as a written table; all but the last return the columns of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvox.llm import decontamination, packing, secrets, simhash, toxicity
from corvox.llm.common import written


def _counted(docs: DataFrame, before: DataFrame) -> DataFrame:
    """The columns of before, with n_chars of the texts as they now are."""
    n = F.length("text").cast("long").alias("n_chars")
    return docs.select(*(n if c == "n_chars" else F.col(f"`{c}`") for c in before.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without rows that the classifier calls toxic. Null and empty texts stay; ties at the threshold go; repeated rows
    and ids are each judged by their text; an empty table stays empty; other columns stay as they are."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that five-word Jaccard similarities of 0.8 or more connect: that of the least id,
    null last. Blank and null texts are one group; rows of one id or none stay if their texts differ; an empty table
    stays empty; other columns stay as they are."""
    return simhash.without_near_copies(docs, similarity=0.8)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what the benchmark has of them, n_chars counted anew. All rows stay, null and empty texts and
    repeated rows among them; an empty table on either side changes nothing; other columns stay as they are."""
    return _counted(decontamination.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced, n_chars counted anew. All rows stay, null and empty texts and repeated rows among
    them; an empty table stays empty; other columns stay as they are."""
    return _counted(secrets.redact(docs), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences. A null or empty text is one token; repeated rows are packed each; an empty table
    gives no rows; other columns are ignored."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("secret scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Classifier, fingerprints and tokenizer are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, "stage")
    return docs
