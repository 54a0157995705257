"""Operators against brute force on small fixtures, with skew, gaps and forced narrow limits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulyard.operators import dedup, encode, impute, metrics, quantiles, sampling, scaling
from haulyard.operators.lookup import small_side


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    n = 20000
    rows = [
        (int(i), "ABC"[i % 3], float(rng.normal()), float(rng.integers(0, 5)), float(np.exp(6 * rng.normal())) if i % 4 else None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id int, g string, smooth double, few double, wild double").repartition(6).persist()


@pytest.mark.parametrize("listed,tiny", [(50_000, 4000), (40, 4000), (40, 100)])
def test_quantiles_equal_numpy(numbers, monkeypatch, listed, tiny):
    monkeypatch.setattr(quantiles, "MAX_LISTED", listed)
    monkeypatch.setattr(quantiles, "TINY_GROUP", tiny)
    monkeypatch.setattr(quantiles, "STEPS", 16)
    probs = [0.0, 0.02, 0.5, 0.999, 1.0]
    pdf = numbers.toPandas()
    got = quantiles.exact_quantiles(numbers, ["smooth", "few", "wild"], probs)[None]
    for c in ["smooth", "few", "wild"]:
        np.testing.assert_allclose(got[c], np.quantile(pdf[c].dropna(), probs), rtol=1e-12)


def test_quantiles_by_group(numbers, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_LISTED", 40)
    pdf = numbers.toPandas()
    got = quantiles.exact_quantiles(numbers, ["smooth", "wild"], [0.05, 0.5], by="g")
    assert set(got) == {"A", "B", "C"}
    for g, part in pdf.groupby("g"):
        for c in ["smooth", "wild"]:
            np.testing.assert_allclose(got[g][c], np.quantile(part[c].dropna(), [0.05, 0.5]), rtol=1e-12)


@pytest.mark.parametrize("listed,rows", [(20_000, 60), (20, 60), (20, 30_000)])
def test_infinite_values_are_values(spark, monkeypatch, listed, rows):
    monkeypatch.setattr(quantiles, "LISTED_GROUP", listed)
    monkeypatch.setattr(quantiles, "MAX_LISTED", listed)
    inf = float("inf")
    frame = spark.range(rows).select(
        F.lit("a").alias("g"),
        F.when(F.col("id") % 2 == 0, inf).otherwise(F.col("id").cast("double")).alias("upper"),
        F.when(F.col("id") % 3 == 0, -inf).when(F.col("id") % 3 == 1, inf).otherwise(F.col("id").cast("double")).alias("both"),
    )
    probs = [0.0, 0.25, 0.75, 1.0]
    values = frame.toPandas()
    got = quantiles.quantile_frame(frame, ["upper", "both"], probs, "g").first()
    for c in ("upper", "both"):
        ordered = np.sort(values[c])
        for q, prob in zip(got[c], probs):
            low, high = ordered[int(np.floor((rows - 1) * prob))], ordered[int(np.ceil((rows - 1) * prob))]
            assert q == low if low == high else low <= q <= high and not np.isnan(q)


def test_one_answer_for_any_number_of_groups(numbers, spark, monkeypatch):
    frame = numbers.withColumn("g", F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 1500).cast("string"))))
    monkeypatch.setattr(quantiles, "LISTED_GROUP", 1000)
    got = {r.g: r.smooth for r in quantiles.quantile_frame(frame, ["smooth"], [0.5, 0.9], "g").collect()}
    for g, part in frame.toPandas().groupby("g"):
        np.testing.assert_allclose(got[g], np.quantile(part["smooth"], [0.5, 0.9]), rtol=1e-12)


def test_quantiles_of_sorted_partitions(spark):
    """Each task holds its own value range: the worst case for combining sketches."""
    frame = spark.range(0, 30000, 1, 8).select((F.col("id") * 1.5).alias("v"))
    assert quantiles.exact_quantiles(frame, ["v"], [0.5, 0.25])[None]["v"] == [14999.5 * 1.5, 7499.75 * 1.5]


def test_quantiles_point_masses(spark, monkeypatch):
    """Two heavy values around the median must end the narrowing."""
    monkeypatch.setattr(quantiles, "MAX_LISTED", 1)
    frame = spark.range(10000).select(F.when(F.col("id") < 5000, 1.0).otherwise(2.0).alias("v"))
    assert quantiles.exact_quantiles(frame, ["v"], [0.5])[None]["v"] == [1.5]


def test_quantiles_of_few_or_no_rows(spark):
    frame = spark.createDataFrame([(1.0, None), (4.0, None)], "a double, b double")
    assert quantiles.exact_quantiles(frame, ["a", "b"], [0.5, 0.09])[None] == {"a": [2.5, 1.27], "b": [None, None]}
    assert quantiles.exact_quantiles(frame.limit(0), ["a"], [0.5])[None] == {"a": [None]}


def test_only_the_wanted_rank_of_a_group_is_sought(numbers, monkeypatch):
    probs = [0.1, 0.5, 0.9]
    every = quantiles.exact_quantiles(numbers, ["smooth"], probs, "g")
    groups = sorted(every)
    need = {g: [i % 3] for i, g in enumerate(groups)}
    sought = []
    for step in ("_step_counts", "_value_counts"):
        real = getattr(quantiles, step)
        monkeypatch.setattr(quantiles, step, lambda source, columns, by, items, real=real: sought.extend(items) or real(source, columns, by, items))
    own = quantiles.exact_quantiles(numbers, ["smooth"], probs, "g", need.get)
    for g in groups:
        assert own[g]["smooth"] == [q if i in need[g] else None for i, q in enumerate(every[g]["smooth"])]
    assert sought and {(g, pi) for g, _, pi in sought} <= {(g, need[g][0]) for g in groups}
    monkeypatch.setattr(quantiles, "LISTED_GROUP", 0)
    framed = {r["g"]: list(r["smooth"]) for r in quantiles.quantile_frame(numbers, ["smooth"], probs, "g", need.get).collect()}
    assert framed == {g: own[g]["smooth"] for g in groups}


def test_quantile_frame_of_many_groups(numbers, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_GROUPS", 2)
    pdf = numbers.toPandas()
    got = {r["g"]: r["smooth"][0] for r in quantiles.quantile_frame(numbers, ["smooth"], [0.5], "g").collect()}
    assert got == pytest.approx(pdf.groupby("g")["smooth"].median().to_dict())


def test_median_fill_sees_gaps_only(spark):
    frame = spark.createDataFrame([("1", 1.0), ("x", None), ("9", 5.0), ("NaN", 7.0)], "a string, b double")
    assert impute.fit_medians(frame, ["a", "b"]) == {"a": 5.0, "b": 5.0}
    assert [tuple(r) for r in impute.fill_medians(frame, ["a", "b"]).collect()] == [(1, 1), (5, 5), (9, 5), (5, 7)]
    assert impute.fit_medians(frame.where("b IS NOT NULL"), ["b"]) == {}


def test_group_median_fill(spark):
    rows = [("A", 1.0), ("A", None), ("A", 3.0), ("B", None), (None, None)]
    got = impute.fill_group_medians(spark.createDataFrame(rows, "g string, v double"), ["v"], "g").collect()
    assert sorted((r["g"] or "", r["v"]) for r in got if r["g"] != "B") == [("", None), ("A", 1.0), ("A", 2.0), ("A", 3.0)]


def test_keep_first_is_order_independent_and_trims_before_shuffle(spark):
    rows = [("k", 3, "c"), ("k", 1, "b"), ("k", 1, "a"), (None, 2, "x"), (None, 1, "y"), ("z", 9, "z")]
    frame = spark.createDataFrame(rows, "id string, t int, v string")
    wanted = {("k", 1, "a"), (None, 1, "y"), ("z", 9, "z")}
    for shuffled in (frame, frame.orderBy(F.rand(1)).repartition(5)):
        kept = dedup.keep_first(shuffled, ["id"], ["t", "v"])
        assert {tuple(r) for r in kept.collect()} == wanted
        assert "WindowGroupLimit" in plan_of(kept) and "Partial" in plan_of(kept)


def test_full_row_dedup_treats_nulls_as_equal(spark):
    frame = spark.createDataFrame([(1, None), (1, None), (1, 2.0)], "a int, b double")
    assert dedup.drop_repeats(frame).count() == 2


def test_seeded_sample_is_exact_and_repeatable(spark):
    frame = spark.range(5000).withColumnRenamed("id", "k")
    ordered = [r["k"] for r in frame.orderBy(sampling.row_hash(["k"], 42)).limit(37).collect()]
    for n, expected in ((37, ordered), (9000, None)):
        got = [r["k"] for r in sampling.seeded_sample(frame.repartition(7), ["k"], n, 42).collect()]
        assert got == expected if expected else len(got) == 5000


def test_seeded_sample_with_one_hot_key(spark):
    frame = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert sampling.seeded_sample(frame, ["k"], 50, 42).count() == 50


def test_split_share_and_shuffle_free(spark):
    split = sampling.split_flag(spark.range(20000), ["id"], 0.2, 42)
    assert abs(split.where("is_test").count() / 20000 - 0.2) < 0.01
    assert "Exchange" not in plan_of(split)


def test_undersample_sizes(spark):
    frame = spark.range(20000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in sampling.undersample(frame, "y", ["id"], 2.0, 1).groupBy("y").count().collect()}
    assert counts[1] == 2000 and abs(counts[0] - 4000) < 250
    assert sampling.undersample(frame, "y", ["id"], 100.0, 1).count() == 20000


def test_label_codes_sorted_with_missing(spark):
    frame = spark.createDataFrame([("b", "x"), ("a", None), (None, "x"), ("c", "x")], "p string, q string")
    got = {(r["p"], r["q"]): (r["p_enc"], r["q_enc"]) for r in encode.label_encode(frame, ["p", "q"]).collect()}
    assert got == {("a", None): (0, 0), ("b", "x"): (1, 1), ("c", "x"): (2, 1), (None, "x"): (3, 1)}


def test_small_side_falls_back_to_shuffle_join(spark):
    big, side = spark.range(100), spark.range(50).withColumn("v", F.col("id") * 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(big.join(small_side(side, 50), "id"))
        beyond = big.join(small_side(side, 49), "id")
        assert "SortMergeJoin" in plan_of(beyond) and beyond.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scaling_uses_population_deviation(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in scaling.scale(frame, ["a", "b"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_auc_equals_pair_counting(spark):
    rng = np.random.default_rng(3)
    rows = [(str(i % 2), int(rng.random() < 0.4), float(np.round(rng.normal(), 2)) if i % 3 else 0.5) for i in range(900)]
    got = {r["m"]: r["auc"] for r in metrics.roc_auc(spark.createDataFrame(rows, "m string, y int, s double"), "y", "s", ["m"]).collect()}
    for m in "01":
        part = [(y, s) for g, y, s in rows if g == m]
        assert got[m] == pytest.approx(brute_auc(*zip(*part)), abs=1e-12)


def test_auc_without_one_class_is_null(spark):
    frame = spark.createDataFrame([(1, 0.2), (1, 0.3)], "y int, s double")
    assert metrics.roc_auc(frame, "y", "s").first()["auc"] is None


def test_confusion_and_report_on_empty_and_one_sided(spark):
    empty = spark.createDataFrame([], "y int, s double")
    row = metrics.confusion(empty, "y", "s", 0.5).first()
    assert (row["accuracy_pct"], row["recall_pct"]) == (0.0, 0.0)
    one = metrics.confusion(spark.createDataFrame([(0, 0.1), (0, 0.9)], "y int, s double"), "y", "s", 0.5)
    report = {r["class"]: r for r in metrics.classification_report(one).collect()}
    assert report["Delayed"]["precision"] == 0.0 and report["On Time"]["recall"] == 0.5
    assert report["weighted avg"]["support"] == 2


def test_model_choice_breaks_ties_by_name(spark):
    rows = [("b", 70.0, 50.0), ("a", 70.0, 50.0), ("c", 60.0, 50.0)]
    assert metrics.select_best(spark.createDataFrame(rows, "model string, auc_pct double, recall_pct double")).first()["model"] == "a"


def test_label_ranks_are_spread_over_parts(spark):
    rows = [("a", f"l{i * 7919 % 3000}") for i in range(3000)] + [("b", t) for t in ("é", "Z", "a", "", "nan")]
    distinct = spark.createDataFrame(rows, "column string, label string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        codes = encode.ranked(distinct)
        plan = codes._jdf.queryExecution().executedPlan().toString()
        got = codes.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for column in ("a", "b"):
        names = sorted(t for c, t in rows if c == column)
        assert {r["label"]: r["code"] for r in got if r["column"] == column} == {t: float(i) for i, t in enumerate(names)}
    assert plan.count("Window") and "hashpartitioning(column#" in plan and "_part#" in plan.split("hashpartitioning(column#")[1][:40]
