"""Delivery-delay models: features, split, training, comparison, choice and persistence."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulyard.constants import DECISION_THRESHOLD, DELAY_CATEGORIES, DELAY_FEATURES, SPLIT_SEED
from haulyard.functions.columns import flag, rounded
from haulyard.operators import forest, metrics, sampling, scaling
from haulyard.operators.boosting import Booster
from haulyard.operators.encode import label_encode
from haulyard.plans import bookings as booking_plan
from haulyard.session import application_folder, files_below, materialise

BALANCE_SEED = 43
VALIDATION_SEED = 44
MAJORITY_FACTOR = 2.0
ZERO_FILLED = ["distance_km", "cargo_weight_kg", "cargo_value_inr", "freight_charge_inr"]


@dataclass(frozen=True)
class Settings:
    """Training sizes. The defaults are full size; tests use fewer rounds and trees."""

    rounds: int = 300
    step: float = 0.05
    depth_a: int = 6
    leaves_b: int = 31
    trees: int = 200
    forest_depth: int = 15
    test_share: float = 0.20
    validation_share: float = 0.10
    threshold: float = DECISION_THRESHOLD


QUICK = Settings(rounds=2, step=0.5, depth_a=4, leaves_b=8, trees=5, forest_depth=4)


@dataclass
class Trained:
    models: dict = field(default_factory=dict)
    seconds: dict = field(default_factory=dict)
    scaler: dict = field(default_factory=dict)
    scored: DataFrame | None = None


def with_target(df: DataFrame) -> DataFrame:
    return df.withColumn("target", flag(F.col("delivery_status") == "DELAYED"))


def delay_features(df: DataFrame, encode_categories: bool = True, codes: DataFrame | None = None) -> DataFrame:
    """Target and model columns from logistics fields only; nothing about the weather leaks in."""
    base = booking_plan.features(booking_plan.zero_filled(with_target(df), ZERO_FILLED), "large")
    wide = base.withColumns(booking_plan.cargo_flags() | booking_plan.interactions())
    return label_encode(wide, DELAY_CATEGORIES, codes) if encode_categories else wide


def split_and_balance(features: DataFrame, keys: list[str], settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(training part, test part), from one stored table partitioned by the split.

    All decisions are per-row hashes and two counts, so no row is moved. Only the training part is
    balanced; the test part keeps its natural class shares.
    """
    split = sampling.split_flag(features.select(*keys, "target", *DELAY_FEATURES), keys, settings.test_share, SPLIT_SEED)
    split = sampling.split_flag(split, keys, settings.validation_share, VALIDATION_SEED, "is_validation")
    stored = materialise(split, ("is_test",))
    train_part = sampling.undersample(stored.where(~F.col("is_test")), "target", keys, MAJORITY_FACTOR, BALANCE_SEED)
    return train_part, stored.where("is_test")


def _vectors(df: DataFrame, scaler: dict) -> DataFrame:
    """Add the model columns as they are ('plain') and scaled ('scaled')."""
    both = scaling.scale(df, DELAY_FEATURES, scaler, suffix="_z")
    plain = VectorAssembler(inputCols=DELAY_FEATURES, outputCol="plain")
    scaled = VectorAssembler(inputCols=[f"{c}_z" for c in DELAY_FEATURES], outputCol="scaled")
    return scaled.transform(plain.transform(both))


def train(features: DataFrame, keys: list[str], settings: Settings = Settings(), only: list[str] | None = None) -> Trained:
    """Fit the three classifiers and score the test part.

    Boosted models use scaled columns, a positive-class weight and a validation part, whose area under the curve
    stops them: A grows level by level to a depth, B leaf by leaf to a number of leaves. The forest uses plain columns and balanced class weights.

    The boosted fits run side by side: each is a row of short jobs, and one's tasks fill the waits of the other. The forest, whose
    tasks are long, follows alone.
    """
    train_part, test_part = split_and_balance(features, keys, settings)
    out = Trained(scaler=scaling.fit_scaler(train_part, DELAY_FEATURES))
    counts = train_part.agg(
        F.count_if(F.col("target") == 0).alias("n0"), F.count_if(F.col("target") == 1).alias("n1")
    ).first()
    n0, n1 = max(counts["n0"], 1), max(counts["n1"], 1)
    positive = F.col("target") == 1
    weighted = train_part.withColumns(
        {
            "positive_weight": F.when(positive, n0 / n1).otherwise(1.0),
            "balanced_weight": F.when(positive, (n0 + n1) / (2 * n1)).otherwise((n0 + n1) / (2 * n0)),
        }
    )
    kept = ["target", "is_validation", "positive_weight", "balanced_weight"]
    # tree growing passes over its rows many times: a table of few files is dealt out to all tasks
    tasks = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fit_part = _vectors(weighted, out.scaler).select(*keys, *kept, "plain", "scaled").repartition(tasks)
    fit_part = materialise(fit_part)
    test_part = _vectors(test_part, out.scaler).select(*keys, "target", "plain", "scaled")
    boosted = dict(features="scaled", label="target", weight="positive_weight", rounds=settings.rounds, step=settings.step)
    estimators = {
        "Boosted A": Booster(leaves=2**settings.depth_a, depth=settings.depth_a, ridge=1.0, least_rows=1, least_curvature=1.0, **boosted),
        "Boosted B": Booster(leaves=settings.leaves_b, **boosted),
        "Random Forest": forest.Forest(
            settings.trees,
            SPLIT_SEED,
            options=dict(featuresCol="plain", labelCol="target", weightCol="balanced_weight", maxDepth=settings.forest_depth),
            keys=keys,
        ),
    }
    names = [name for name in estimators if not only or name in only]

    def fitted(name: str):
        start = time.monotonic()
        return estimators[name].fit(fit_part), round(time.monotonic() - start, 1)

    boosters = [name for name in names if isinstance(estimators[name], Booster)]
    with ThreadPoolExecutor(len(estimators)) as pool:
        done = dict(zip(boosters, pool.map(inheritable_thread_target(features.sparkSession)(fitted), boosters)))
    done |= {name: fitted(name) for name in names if name not in done}
    for name, (model, seconds) in done.items():
        out.models[name], out.seconds[name] = model, seconds
        scored = model.transform(test_part).select(
            F.lit(name).alias("model"), *keys, "target", vector_to_array("probability")[1].alias("score")
        )
        out.scored = scored if out.scored is None else out.scored.unionByName(scored)
    return out


@dataclass(frozen=True)
class Outcome:
    """What reports need of a training: measures per model, the forest's importances."""

    results: DataFrame
    importances: DataFrame

    def best(self) -> DataFrame:
        return metrics.select_best(self.results)


def training_key(inputs: DataFrame, settings: Settings) -> str:
    """Names a training by its input files (path, modified, length) and all that shapes the models.

    The files are summed up in one aggregate in any order, so a changed, added or removed file gives another name.
    """
    mark = F.xxhash64("path", "modified", "length").cast("decimal(20,0)")
    files = inputs.agg(F.count(F.lit(1)).alias("files"), F.sum(mark).cast("string").alias("marks")).first()
    shape = [*files, asdict(settings), DELAY_FEATURES, SPLIT_SEED, BALANCE_SEED, VALIDATION_SEED, MAJORITY_FACTOR]
    return hashlib.sha256(json.dumps(shape).encode()).hexdigest()


def stored_training(
    inputs: DataFrame, features: Callable[[], DataFrame], keys: list[str], settings: Settings = Settings(), store: str | None = None
) -> Outcome:
    """The outcome of one training on ``features()``, trained once per input and settings and read from the store afterwards.

    ``inputs`` lists the input files (path, modified, length). ``store`` is a folder all executors share; by default this
    application's own, removed with it. An attempt counts once its last table is whole, so one that broke off is never read, and two that
    run at the same time do not write to the same place; the first by name is used by all.
    """
    spark = inputs.sparkSession
    place = f"{store or application_folder(spark) + '/trainings'}/{training_key(inputs, settings)}"
    whole = files_below(spark, f"{place}/*/importances/_SUCCESS")
    if not whole:
        attempt = f"{place}/{uuid.uuid4().hex}"
        trained = train(features(), keys, settings)
        evaluate(trained, settings).write.parquet(f"{attempt}/results")
        feature_importance(spark, trained.models["Random Forest"], len(DELAY_FEATURES)).write.parquet(f"{attempt}/importances")
        whole = files_below(spark, f"{place}/*/importances/_SUCCESS")
    found = min(whole).removesuffix("/importances/_SUCCESS")
    return Outcome(spark.read.parquet(f"{found}/results"), spark.read.parquet(f"{found}/importances"))


def evaluate(trained: Trained, settings: Settings = Settings()) -> DataFrame:
    """One row per model: confusion counts, accuracy, AUC and recall in percent, training time."""
    scored = materialise(trained.scored)
    counts = metrics.confusion(scored, "target", "score", settings.threshold, by=["model"])
    areas = metrics.roc_auc(scored, "target", "score", by=["model"])
    seconds = scored.sparkSession.createDataFrame(list(trained.seconds.items()), "model string, train_time_s double")
    return (
        counts.join(areas, "model")
        .join(F.broadcast(seconds), "model")
        .withColumn("auc_pct", rounded(F.col("auc") * F.lit(1e2), 2))
        .drop("auc")
    )


def feature_importance(spark: SparkSession, model, limit: int = 8) -> DataFrame:
    rows = [(name, float(value)) for name, value in zip(DELAY_FEATURES, forest.importances(model))]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(limit)


def save_best(trained: Trained, results: DataFrame, folder: str, codes: DataFrame | None = None, threshold: float = DECISION_THRESHOLD) -> dict:
    """Persist the chosen model as a pipeline with its scaler and assembler, the label codes, and a metadata record.

    ``codes`` (column, label, code) are the ones the features were made with; ``score_bookings`` needs them.
    """
    spark = results.sparkSession
    best = metrics.select_best(results).first()
    scaled = best["model"] != "Random Forest"
    columns = [f"{c}_z" for c in DELAY_FEATURES] if scaled else DELAY_FEATURES
    assembler = VectorAssembler(inputCols=columns, outputCol="scaled" if scaled else "plain")
    PipelineModel([_scaling_stage(trained.scaler), assembler, trained.models[best["model"]]]).write().overwrite().save(f"{folder}/best_model")
    if codes is not None:
        codes.write.mode("overwrite").parquet(f"{folder}/label_codes")
    metadata = {
        "best_model_name": best["model"],
        "threshold": threshold,
        "feature_cols": DELAY_FEATURES,
        "accuracy": best["accuracy_pct"],
        "auc": best["auc_pct"],
        "recall_delayed": best["recall_pct"],
        "scaler": {c: list(v) for c, v in trained.scaler.items()},
    }
    metadata["saved_at"] = datetime.now(timezone.utc).isoformat()
    record = spark.createDataFrame([(json.dumps(metadata),)], "value string")
    record.coalesce(1).write.mode("overwrite").text(f"{folder}/model_metadata")
    return metadata


def _scaling_stage(scaler: dict) -> SQLTransformer:
    """The fitted scaling as a stage that is saved with the model."""
    scaled = (f"(CAST(`{c}` AS DOUBLE) - {mean!r}D) / {dev or 1.0!r}D AS `{c}_z`" for c, (mean, dev) in scaler.items())
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def score_bookings(bookings: DataFrame, folder: str) -> DataFrame:
    """Plain bookings with the saved model's delay probability and verdict."""
    spark = bookings.sparkSession
    record = json.loads(spark.read.text(f"{folder}/model_metadata").first()["value"])
    codes = spark.read.parquet(f"{folder}/label_codes")
    ready = delay_features(bookings, codes=codes)
    scored = PipelineModel.load(f"{folder}/best_model").transform(ready)
    probability = vector_to_array("probability")[1]
    return scored.withColumns({"delay_probability": probability, "delay_predicted": flag(probability >= record["threshold"])}).select(
        *bookings.columns, "delay_probability", "delay_predicted"
    )
