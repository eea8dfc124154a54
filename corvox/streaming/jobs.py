"""The corpus jobs on files and rows that arrive over time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import predicted
from ..operators.corpus import pending
from ..operators.model import score

WAV_FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_files(spark: SparkSession, source: str, path: str, checkpoint: str, make: Callable[[DataFrame], DataFrame], key: str = "utt_id") -> StreamingQuery:
    """Arriving files, as rows that `make` turns into keyed ones, are added to the table at path, each key once: a batch
    that is run again finds its rows there. Ends when all files that there are have been taken."""
    files = spark.readStream.format("binaryFile").schema(WAV_FILES).option("recursiveFileLookup", True).load(source)

    def add(batch: DataFrame, epoch: int) -> None:
        rows = make(batch).dropDuplicates([key])
        try:
            rows = pending(rows, batch.sparkSession.read.parquet(path), key)
        except Exception as e:  # the table begins with the first batch
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        rows.write.mode("append").parquet(path)

    return files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(arrivals: DataFrame, time: str, delay: str = "1 hour", key: str = "utt_id") -> DataFrame:
    """Arriving rows, each key once within the time that late ones are waited for."""
    return arrivals.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def detect_rows(arrivals: DataFrame, model: PipelineModel, stats: DataFrame, head: str, threshold: float) -> DataFrame:
    """utt_id, score, predicted of arriving embeddings; stateless, so any sink that appends takes it."""
    scored = score(model, stats, arrivals, head)
    return scored.withColumn("predicted", predicted(F.col("score"), threshold))


def score_windows(arrivals: DataFrame, time: str, width: str = "10 minutes", delay: str = "1 hour") -> DataFrame:
    """Arriving scores by window of event time: n, mean score."""
    return arrivals.withWatermark(time, delay).groupBy(F.window(time, width)).agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"))
