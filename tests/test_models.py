import json

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from haulyard.catalog import queries
from haulyard.constants import DELAY_FEATURES
from haulyard.operators import encode
from haulyard.plans import models, quality


@pytest.fixture(scope="module")
def orders(spark):
    """Bookings whose delay depends on distance, so the models have something to find."""
    k = F.col("id")
    distance = (F.pmod(k * 37, F.lit(800)) + 50).cast("double")
    late = (distance > 500) & (F.pmod(F.xxhash64(k), F.lit(10)) < 8)
    return spark.range(4000).select(
        k.cast("string").alias("booking_id"),
        F.concat(F.lit("City"), (k % 5).cast("string")).alias("origin_city"),
        F.concat(F.lit("Town"), (k % 3).cast("string")).alias("destination_city"),
        F.lit("Textiles").alias("cargo_type"),
        F.when(k % 6 == 0, "EXPRESS").otherwise("NORMAL").alias("priority"),
        distance.alias("distance_km"),
        (F.pmod(k * 53, F.lit(11000)) + 100).cast("double").alias("cargo_weight_kg"),
        (k * 11 % 300000).cast("double").alias("cargo_value_inr"),
        (distance * 20).alias("freight_charge_inr"),
        F.lit(10.0).alias("origin_delay_risk"),
        F.when(late, "DELAYED").otherwise("DELIVERED").alias("delivery_status"),
    )


@pytest.fixture(scope="module")
def trained(orders):
    return models.train(models.delay_features(orders), ["booking_id"], models.QUICK)


@pytest.fixture(scope="module")
def results(trained):
    return models.evaluate(trained, models.QUICK).toPandas().set_index("model")


def test_models_find_the_planted_signal(results):
    assert set(results.index) == {"Boosted A", "Boosted B", "Random Forest"}
    assert (results["auc_pct"] > 75).all() and (results["recall_pct"] > 50).all()


def test_every_test_row_is_counted(results, trained):
    n = trained.scored.where("model = 'Boosted A'").count()
    cells = ["true_positives", "false_negatives", "false_positives", "true_negatives"]
    assert (results[cells].sum(axis=1) == n).all() and 600 < n < 1000


def test_importance_names_the_cause(spark, trained):
    top = models.feature_importance(spark, trained.models["Random Forest"]).collect()
    assert len(top) == 8 and top[0]["feature"] in {"distance_km", "freight_charge_inr", "is_long_haul"}


def test_best_model_is_saved_and_scores_plain_bookings(spark, orders, trained, tmp_path):
    codes = encode.label_codes(models.delay_features(orders, encode_categories=False), models.DELAY_CATEGORIES)
    metadata = models.save_best(trained, models.evaluate(trained, models.QUICK), str(tmp_path), codes)
    loaded = PipelineModel.load(f"{tmp_path}/best_model")
    assert len(loaded.stages) == 3
    scored = models.score_bookings(orders, str(tmp_path))
    best = trained.scored.where(F.col("model") == metadata["best_model_name"]).select("booking_id", "score")
    both = scored.join(best, "booking_id")
    assert scored.columns[: len(orders.columns)] == orders.columns and both.count() == best.count()
    assert both.agg(F.max(F.abs(F.col("score") - F.col("delay_probability")))).first()[0] < 1e-9
    stored = json.loads(spark.read.text(f"{tmp_path}/model_metadata").first()[0])
    assert stored["best_model_name"] == metadata["best_model_name"] and stored["feature_cols"] == DELAY_FEATURES
    assert stored["threshold"] == 0.45 and "saved_at" in stored


def test_target_and_zero_fill(spark):
    frame = spark.createDataFrame(
        [("1", "x", None, None, "y", "NORMAL", "DELAYED", 1.0)],
        "booking_id string, distance_km string, cargo_weight_kg double, cargo_value_inr double, "
        "origin_city string, priority string, delivery_status string, origin_delay_risk double",
    ).withColumn("freight_charge_inr", F.lit("12"))
    row = models.delay_features(frame, encode_categories=False).first()
    assert (row["target"], row["distance_km"], row["freight_charge_inr"], row["revenue_per_km"]) == (1, 0.0, 12.0, 12.0)


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "path string, modified long, length long")


def test_training_is_stored_and_used_again(spark, orders, files, tmp_path):
    calls = []

    def features():
        calls.append(1)
        return models.delay_features(orders)

    def outcome(inputs, settings=models.QUICK):
        return models.stored_training(inputs, features, ["booking_id"], settings, str(tmp_path))

    first, again = outcome(files), outcome(files.orderBy(F.desc("path")).repartition(3))
    assert len(calls) == 1 and first.results.collect() == again.results.collect()
    assert first.importances.count() == len(DELAY_FEATURES)
    assert first.best().columns[-1] == "selection_score" and first.best().count() == 1
    # an attempt that broke off is not read
    key = models.training_key(files, models.QUICK)
    first.results.write.parquet(f"{tmp_path}/{key}/0/results")
    assert outcome(files).results.collect() == first.results.collect() and len(calls) == 1


def test_training_key_follows_files_and_settings(spark, files):
    key = models.training_key(files, models.QUICK)
    changed = files.withColumn("length", F.when(F.col("path") == "a", 11).otherwise(F.col("length")))
    assert key == models.training_key(files.orderBy(F.desc("path")), models.QUICK)
    assert len({key, models.training_key(changed, models.QUICK), models.training_key(files.limit(1), models.QUICK), models.training_key(files, models.Settings())}) == 4


def test_registered_queries_share_one_training_at_full_size(spark, monkeypatch, data):
    """All queries that need models ask for the same training, with the default settings."""
    used = []
    table = spark.createDataFrame([("A", 1, 1, 1, 1, 75.0, 66.0, 71.5, 3.0)], "model string, true_positives long, false_negatives long, false_positives long, true_negatives long, auc_pct double, recall_pct double, accuracy_pct double, train_time_s double")
    outcome = models.Outcome(table, spark.createDataFrame([("distance_km", 1.0)], "feature string, importance double"))

    def stored(inputs, features, keys, settings, store=None):
        used.append((models.training_key(inputs, settings), settings))
        return outcome

    monkeypatch.setattr(models, "stored_training", stored)
    for name in ("delay_models", "feature_importance", "ml_report", "master_report"):
        assert queries.QUERIES[name](spark, data).count() == 1
    kpi = {r["KPI"]: r["Value"] for r in queries.kpi_table(spark, data).collect()}
    assert len(kpi) == 19 and (kpi["ML AUC Score"], kpi["ML Recall"], kpi["ML Accuracy"]) == (75.0, 66.0, 71.5)
    plain = {r["KPI"]: r["Value"] for r in queries.kpi_summary(spark, data).collect()}
    assert plain.items() <= kpi.items()
    checks = {r["measure"]: r["status"] for r in queries.acceptance_checks(spark, data).collect()}
    assert kpi["Test Cases Passed"] == sum(s == "PASS" for s in checks.values())
    assert len(checks) == 13 and checks["ML Recall"] == checks["IoT Files"] == checks["Weather Present"] == "PASS" and checks["Total Orders"] == "FAIL"
    metric = {r["metric"]: r["value"] for r in queries.metric_values(spark, data).collect()}
    bookings_only = {r["metric"]: r["value"] for r in queries.published_metrics(spark, data).collect()}
    assert len(metric) == 12 and (metric["ModelAUCScore"], metric["ModelRecallScore"]) == (75.0, 66.0)
    assert metric["RecordsIngested"] > bookings_only["RecordsIngested"] and metric["TotalOrders"] == bookings_only["TotalOrders"]
    volumes = queries.master_report(spark, data).first()
    assert volumes["data_volumes"]["weather_records"] > 0 and volumes["ml_summary"]["best"]["model"] == "A"
    assert len(set(used)) == 1 and used[0][1] == models.Settings()


def test_outputs_and_landed_files(spark):
    empty = spark.range(0)
    got = {r["measure"]: r["value"] for r in quality.outputs_present({"A": spark.range(5), "B": empty}).collect()}
    assert got == {"A Present": 1.0, "B Present": 0.0}
    listed = spark.createDataFrame([("a.csv",), ("b.csv",), ("c.json",), (None,)], "path string")
    got = {r["measure"]: r["value"] for r in quality.landed_files(listed, {"X": F.col("path").endswith(".csv"), "Y": F.col("path") == "z"}).collect()}
    assert got == {"Landed Files": 4.0, "X Files": 2.0, "Y Files": 0.0}
