"""Detection heads with Spark ML: fitting, choosing by validation error, saving, scoring."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import stable_hash
from ..schema import label_code
from .features import dimension_stats, standardised
from .metrics import equal_error_rate, histogram

#: A validation loss so much above that of training is overfitting.
OVERFIT = 0.30
#: Heads by name: (inputs, parameters) -> estimator on features, y and weight.
HEADS: dict[str, Callable[[int, dict], Estimator]] = {
    "linear": lambda d, p: LogisticRegression(featuresCol="features", labelCol="y", weightCol="weight", maxIter=p.get("maxIter", 100), regParam=p.get("regParam", 0.01)),
    "mlp": lambda d, p: MultilayerPerceptronClassifier(featuresCol="features", labelCol="y", layers=[d, p.get("hidden", 256), 2], maxIter=p.get("maxIter", 100), seed=p.get("seed", 42)),
    "deep_mlp": lambda d, p: MultilayerPerceptronClassifier(featuresCol="features", labelCol="y", layers=[d, 512, 256, 2], maxIter=p.get("maxIter", 100), seed=p.get("seed", 42)),
}


def register(name: str, factory: Callable[[int, dict], Estimator]) -> None:
    if name in HEADS:
        raise ValueError(f"{name} exists already")
    HEADS[name] = factory


def layer_norm(vector: Column) -> Column:
    """Each row's own mean and deviation taken out."""
    n = F.size(vector)
    mean = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x) / n
    centred = F.zip_with(vector, F.array_repeat(mean, n), lambda x, m: x - m)
    deviation = F.sqrt(F.aggregate(centred, F.lit(0.0), lambda s, x: s + x * x) / n + 1e-5)
    return F.zip_with(centred, F.array_repeat(deviation, n), lambda x, d: x / d)


def with_features(manifest: DataFrame, features: DataFrame) -> DataFrame:
    """The manifest's rows with their embedding; rows without one are left out. feature_gaps() counts these."""
    return manifest.join(features.where("embedding is not null").select("utt_id", "embedding"), "utt_id")


def feature_gaps(manifest: DataFrame, features: DataFrame) -> DataFrame:
    """split, label, n, dropped: rows, and those of them that with_features() leaves out."""
    there = features.where("embedding is not null").select("utt_id", F.lit(True).alias("there_")).distinct()
    return manifest.select("utt_id", "split", "label").join(there, "utt_id", "left").groupBy("split", "label").agg(F.count("*").alias("n"), F.count_if(F.col("there_").isNull()).alias("dropped"))


def _counted_rows(features: DataFrame, manifest: DataFrame, split: str) -> tuple[DataFrame, dict[str, int]]:
    rows = with_features(manifest.where(F.col("split") == split).select("utt_id", label_code(F.col("label")).cast("double").alias("y")), features)
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if set(n) != {0.0, 1.0}:
        raise ValueError(f"split {split} needs real and fake rows with features: {n}")
    return rows, {"real": n[0.0], "fake": n[1.0]}


def training_rows(features: DataFrame, manifest: DataFrame, split: str) -> DataFrame:
    """utt_id, y, embedding of a split; a split without rows of either class is an error."""
    return _counted_rows(features, manifest, split)[0]


def _inputs(rows: DataFrame, stats: DataFrame, head: str) -> DataFrame:
    scaled = standardised(rows, stats)
    vector = layer_norm(F.col("embedding")) if head == "linear" else F.col("embedding")
    return scaled.withColumn("features", array_to_vector(vector))


def balanced(rows: DataFrame, head: str, seed: int) -> DataFrame:
    """Weights that make up for class sizes; for heads that take none, rows of the rarer class again, by hash."""
    n = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    few, ratio = min(n, key=n.get), max(n.values()) / min(n.values())
    if head == "linear":
        return rows.withColumn("weight", F.when(F.col("y") == 1, n[0.0] / n[1.0]).otherwise(1.0))
    part = F.conv(F.substring(stable_hash(F.lit(seed), F.col("utt_id")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    times = F.when(F.col("y") == few, F.lit(int(ratio)) + (part < ratio - int(ratio)).cast("int")).otherwise(1)
    return rows.withColumn("at_", F.explode(F.sequence(F.lit(1), times))).drop("at_").withColumn("weight", F.lit(1.0))


def probability(model: Model | PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1])


def better(eer: float | None, loss: float, best: dict | None, min_delta: float) -> bool:
    """A lower error by more than min_delta, or about the same error at a lower loss; without an error, the loss."""
    if best is None:
        return True
    if eer is None or not math.isfinite(eer) or best["val_eer"] is None:
        return loss < best["val_loss"] - min_delta
    return eer < best["val_eer"] - min_delta or (abs(eer - best["val_eer"]) <= min_delta and loss < best["val_loss"])


LADDER = tuple({"regParam": r} for r in (1.0, 0.1, 0.01, 0.001))
STATS = "dim int, mean double, std double"
HISTORY = "step int, train_loss double, val_loss double, val_eer double, threshold double, parameters string, overfit boolean"
SUMMARY = "head string, steps int, best_step int, best_parameters string, val_eer double, val_loss double, threshold double, best_val_eer double, overfit_steps int, stopped_early boolean"


class Sink:
    """What a training run stores in a folder, by its key: history/run=<key>/step=<n>, summary/run=<key>, the statistics
    and the model of each step that was the best so far. Every write replaces its own place and no other, so a step that
    is run again after a crash leaves one row. A step's row is its last write: a step without one was not done."""

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path.rstrip("/"), run

    def stored(self, what: str, schema: str) -> DataFrame | None:
        """None where nothing was stored, or its writing never ended."""
        try:
            rows = self.spark.read.schema(schema).parquet(what)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if rows.isEmpty() else rows

    def history(self) -> list[tuple]:
        """The steps from the first on that are stored without a gap."""
        rows = self.stored(f"{self.path}/history/run={self.run}", HISTORY)
        steps = [tuple(r) for r in rows.select(*(f.split()[0] for f in HISTORY.split(", "))).orderBy("step").collect()] if rows is not None else []
        return [r for k, r in enumerate(steps) if r[0] == k]

    def statistics(self, compute: Callable[[], DataFrame]) -> DataFrame:
        """Those of the run's first start, so that later steps see the same inputs to the last bit."""
        place = f"{self.path}/stats/{self.run}"
        if self.stored(place, STATS) is None:
            compute().coalesce(1).write.mode("overwrite").parquet(place)
        return self.stored(place, STATS)

    def keep(self, row: tuple, model: PipelineModel | None) -> None:
        if model is not None:
            model.write().overwrite().save(f"{self.path}/models/{self.run}/{row[0]}")
        one = self.spark.createDataFrame([row], HISTORY).drop("step").coalesce(1)
        one.write.mode("overwrite").parquet(f"{self.path}/history/run={self.run}/step={row[0]}")

    def model(self, step: int) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/models/{self.run}/{step}")

    def summarise(self, row: tuple) -> None:
        self.spark.createDataFrame([row], SUMMARY).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/summary/run={self.run}")


def histories(spark: SparkSession, path: str) -> DataFrame:
    """run, step and what each step gave, of all runs in a sink."""
    return spark.read.schema(f"run string, {HISTORY}").parquet(f"{path.rstrip('/')}/history")


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """run and the summary of all runs in a sink that came to their end."""
    return spark.read.schema(f"run string, {SUMMARY}").parquet(f"{path.rstrip('/')}/summary")


def run_key(name: str, head: str, ladder: list[dict], min_delta: float, patience: int, seed: int, counts: dict) -> str:
    """Another name, head, ladder, rule for stopping, seed or number of rows of a split and class is another run."""
    return hashlib.sha1(json.dumps([name, head, ladder, min_delta, patience, seed, counts], sort_keys=True).encode()).hexdigest()[:16]


def fit(features: DataFrame, manifest: DataFrame, head: str = "linear", ladder: list[dict] | None = None, min_delta: float = 1e-4, patience: int = 20, seed: int = 42, sink: str | None = None, name: str = "") -> tuple[PipelineModel, DataFrame, dict, DataFrame]:
    """Fits a head for each step of a ladder of parameters and keeps the best on the validation split: (model,
    statistics for standardising, its facts, history). Stops after `patience` steps without a better one.

    sink: a folder that takes history, summary and the best models (see Sink). A run that is started again with the same
    name, parameters and numbers of rows goes on after its last stored step; one that had come to its end fits nothing.
    Rows that were changed but not counted differently are another run only by another name."""
    if head not in HEADS:
        raise KeyError(f"no head {head}; there are {', '.join(sorted(HEADS))}")
    spark, ladder = features.sparkSession, list(ladder or LADDER)
    (train, n_train), (val, n_val) = (_counted_rows(features, manifest, s) for s in ("train", "val"))
    means = lambda: spark.createDataFrame(dimension_stats(train).orderBy("dim").collect(), STATS)
    store = Sink(spark, sink, run_key(name, head, ladder, min_delta, patience, seed, {"train": n_train, "val": n_val})) if sink else None
    stats = store.statistics(means) if store else means()
    width = stats.count()
    x, v = balanced(_inputs(train, stats, head), head, seed).cache(), _inputs(val, stats, head).cache()
    history, best, model, early = [], None, None, False
    for row in store.history() if store else []:
        history.append(row)
        if better(row[3], row[2], best, min_delta):
            best = _facts(row, head)
        elif row[0] - best["step"] >= patience:
            early = True
    for step, p in list(enumerate(ladder))[len(history) :]:
        if early:
            break
        got = Pipeline(stages=[HEADS[head](width, p)]).fit(x)
        losses = []
        for rows in (x, v):
            s = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), F.col("score")))
            losses.append(probability(got, rows).agg(F.avg(-F.when(F.col("y") == 1, F.log(s)).otherwise(F.log(1 - s)))).head()[0])
        hist = histogram(probability(got, v).withColumn("label", F.when(F.col("y") == 1, "fake").otherwise("real")).withColumn("all_", F.lit(0)), "all_")
        at = equal_error_rate(hist, ["all_"]).head()
        eer, threshold = (at.eer, at.eer_threshold) if at else (None, 0.5)
        row = (step, losses[0], losses[1], eer, threshold, json.dumps(p), losses[1] - losses[0] > OVERFIT)
        history.append(row)
        if better(eer, losses[1], best, min_delta):
            best, model = _facts(row, head), got
        else:
            early = step - best["step"] >= patience
        if store:
            store.keep(row, got if best["step"] == step else None)
    x.unpersist()
    v.unpersist()
    best["best_val_eer"] = min((h[3] for h in history if h[3] is not None), default=None)
    if store:
        store.summarise((head, len(history), best["step"], history[best["step"]][5], best["val_eer"], best["val_loss"], best["threshold"], best["best_val_eer"], sum(h[6] for h in history), early))
        model = model or store.model(best["step"])
    return model, stats, best, spark.createDataFrame(history, HISTORY)


def _facts(row: tuple, head: str) -> dict:
    step, _, loss, eer, threshold, _, _ = row
    return dict(step=step, head=head, val_eer=eer, val_loss=loss, threshold=threshold if threshold is not None and 0 < threshold < 1 else 0.5)


def score(model: PipelineModel, stats: DataFrame, features: DataFrame, head: str = "linear") -> DataFrame:
    """utt_id, score."""
    return probability(model, _inputs(features.select("utt_id", "embedding"), stats, head)).select("utt_id", "score")


def save(path: str, model: PipelineModel, stats: DataFrame, facts: dict) -> None:
    model.write().overwrite().save(f"{path}/model")
    stats.write.mode("overwrite").parquet(f"{path}/stats")
    stats.sparkSession.createDataFrame([(json.dumps(facts),)], "facts string").write.mode("overwrite").parquet(f"{path}/meta")


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame, dict]:
    facts = json.loads(spark.read.parquet(f"{path}/meta").head().facts)
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/stats"), facts
