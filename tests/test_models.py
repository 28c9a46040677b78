import math

import pytest
from pyspark.sql import functions as F

from demand_engine.catalog import models
from demand_engine.operators import encoding
from demand_engine.plans import training
from demand_engine.plans.run import Settings, run_forecasting
from demand_engine.sources.tables import read_table


def test_trials_are_in_range_and_repeatable(spark):
    first, again = (training.sample_trials(spark, n=50, seed=3).collect() for _ in range(2))
    assert first == again
    for r in first:
        for name, (low, high, _) in training.SEARCH_RANGES.items():
            assert low <= r[name] <= high
        assert isinstance(r["n_estimators"], int)
    below = sum(r["learning_rate"] < math.sqrt(0.01 * 0.3) for r in first)
    assert 10 < below < 40  # even on the log scale
    with pytest.raises(ValueError):
        training.sample_trials(spark, {"x": (1, 2, "cubic")})


def test_best_trial(rows):
    trials = rows(
        [("1", "SUCCEEDED", 3.0), ("2", "SUCCEEDED", 1.0), ("3", "FAILED: X", None), ("4", "SUCCEEDED", None)],
        "trial_id string, state string, rmse double",
    )
    assert training.best_trial(trials).first().trial_id == "2"
    assert training.best_trial(trials, "MAXIMIZE").first().trial_id == "1"
    with pytest.raises(RuntimeError):
        training.best_trial(trials.where("state <> 'SUCCEEDED'"))


def test_roles(rows):
    df = rows([("2024-01-01", 1, 5, 3, 0)], "t timestamp, id int, y int, hour int, weekend int")
    roles = training.feature_roles(df, "t", "y", "id", ["hour", "id", "y"], ["weekend"], ["hour", "weekend"])
    assert roles.usable(roles.numeric) == ["hour"]
    assert roles.stages(df)[-1].getInputCols() == ["hour", "weekend_hot"]
    assert training.best_round([5.0, 4.0, 4.5, 3.0, *[9.0] * 9, 2.0, *[9.0] * 10, 1.0]) == 14
    assert training.best_round([5.0, *[6.0] * 10, 1.0]) == 1 and training.best_round([1.0]) == 1
    with pytest.raises(ValueError):
        training.feature_roles(df, "t", "y", "id", ["nope"], [])


def test_whole_run(spark, tmp_path):
    """Five zones with a clear daily rhythm, from raw rows to the accuracy of the forecast."""
    hours = F.explode(F.sequence(F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-30 23:00:00").cast("timestamp"), F.expr("interval 1 hour")))
    rhythm = (F.hour("h") % 6 + F.col("zone") % 3 + 1).cast("int")
    raw = (
        spark.range(1, 6).select(F.col("id").alias("zone"), hours.alias("h"))
        .select("zone", F.explode(F.sequence(F.lit(1), rhythm)).alias("i"), "h")
        .select(F.col("h").alias("trip_start_timestamp"), F.col("zone").alias("pickup_community_area"))
    )
    raw.write.parquet(str(tmp_path / "raw"))
    settings = Settings(
        end_date="2024-01-30", max_points=720, train_end="2024-01-16", val_end="2024-01-23", horizon=24,
        search=True, max_trials=2,
        ranges={"n_estimators": (3, 5, "linear"), "learning_rate": (0.1, 0.3, "log"), "max_depth": (3, 4, "linear")},
    )
    out = str(tmp_path / "out")
    scored = run_forecasting(spark, str(tmp_path / "raw"), out, settings).first()
    assert scored.n == 5 * 24
    mean_error = read_table(spark, f"{out}/demand").agg(F.stddev_pop("trip_count")).first()[0]
    assert scored.rmse < mean_error
    assert read_table(spark, f"{out}/trials").where("state = 'SUCCEEDED'").count() == 2
    assert spark.read.parquet(f"{out}/runs").first().forecast_horizon == 24
    model = training.load_model(f"{out}/model")
    assert "target_lag_24" in training.model_inputs(model)
    with pytest.raises(ValueError, match="target_lag_24"):
        training.predict(model, read_table(spark, f"{out}/demand"))
    assert spark.read.csv(f"{out}/predictions", header=True).where("cast(prediction as double) < 0").count() == 0


def test_dictionary_numbers_every_value_once(spark, monkeypatch):
    monkeypatch.setattr(encoding, "PIECES", 7)
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 1000).alias("k"))
    known = encoding.dictionary(df, "k").collect()
    values = {str(k % 1000) for k in range(3000) if k % 3}
    assert {r.value for r in known} == values and len(known) == len(values)
    assert sorted(r.slot for r in known) == list(range(len(values)))
    some = spark.createDataFrame([(5,), (-1,), (None,)], "k int")
    got = {r.k: r.s for r in encoding.slots(some, "k", encoding.read_dictionary(spark, encoding.dictionary(df, "k").inputFiles()[0].rpartition("/")[0]), "s").collect()}
    assert got[5] is not None and got[-1] is None and got[None] is None
    assert encoding.dictionary(df.limit(0), "k").count() == 0


def test_a_thousand_ids_are_a_thousand_features(spark, tmp_path):
    """Two ids that a hash of a few slots would put together have opposite targets; each is learned."""
    t = F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, h)")
    rows = spark.range(1000).select(F.col("id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("h")).select(
        t.alias("t"), F.format_string("id-%04d", "id").alias("area"), F.when(F.col("id") == 500, 900.0).when(F.col("id") == 20, -900.0).otherwise(0.0).alias("y")
    )
    roles = training.FeatureRoles("t", "y", "", [], ["area"])
    model = training.train(rows, "2024-01-01T03:00:00", "2024-01-02", {"n_estimators": 6, "learning_rate": 0.5, "colsample_bytree": 1.0, "subsample": 1.0}, "t", "y", roles)
    assert training.model_inputs(model) == ["area"]
    found = {r.feature: r.importance for r in training.feature_importance(model, rows, per_value=True).collect()}
    assert len(found) == 1001 and "area=" in found and sum(found.values()) == pytest.approx(1)
    assert min(found["area=id-0500"], found["area=id-0020"]) > 0.3
    path = str(tmp_path / "model")
    training.save_model(model, path)
    asked = spark.createDataFrame([("id-0500",), ("id-0020",), ("id-0007",), ("new",), (None,)], "area string")
    for m in (model, training.load_model(path)):
        got = {r.area: r.prediction for r in m.transform(asked).collect()}
        assert got["id-0500"] > 500 and got["id-0020"] < -500 and abs(got["id-0007"]) < 50
        assert got["new"] == got[None] == pytest.approx(got["id-0007"])


def test_the_first_trees_are_the_shorter_fit(spark):
    rows = spark.range(200).select((F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 17 * F.col("id") % 5).cast("double").alias("y"))
    ready = training.VectorAssembler(inputCols=["x"], outputCol="features").transform(rows).persist()
    long, short = (training._regressor({"n_estimators": n, "max_depth": 3}, "y").fit(ready) for n in (6, 3))
    cut = training.first_trees(long, 3)
    assert cut.getNumTrees == 3
    assert [r.prediction for r in cut.transform(ready).collect()] == [r.prediction for r in short.transform(ready).collect()]
    assert cut.featureImportances.toArray().tolist() == short.featureImportances.toArray().tolist()


def test_trials_record_what_spark_refuses_and_nothing_else(spark, rows, monkeypatch):
    table = rows([("2024-01-01", "a", 1.0, 2.0), ("2024-01-02", "a", 2.0, 3.0)], "timestamp_hour timestamp, area string, trip_count double, target_lag_1 double")
    trials = spark.createDataFrame([("1", -5)], "trial_id string, max_depth int")
    done = training.run_trials(table, trials, "2024-01-02", "2024-01-03").first()
    assert done.state.startswith("FAILED") and done.rmse is None
    monkeypatch.setattr(training, "train", lambda *a: {}["bug"])
    with pytest.raises(KeyError):
        training.run_trials(table, trials, "2024-01-02", "2024-01-03")


def test_few_rows_are_fitted_in_few_tasks(spark):
    """Whatever the number of shuffle partitions; and the fit doesn't depend on how the rows lay."""
    t = F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, h)")
    rows = spark.range(40).select(F.col("id").cast("string").alias("area"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("h")).select(
        t.alias("t"), "area", "h", (F.col("area").cast("int") % 7 + F.col("h") % 3).alias("y")
    )
    roles = training.FeatureRoles("t", "y", "", ["h"], ["area"])
    context, before, predicted = spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for wide in (64, 32):
            spark.conf.set("spark.sql.shuffle.partitions", wide)
            context.setJobGroup(f"fit-{wide}", "fit")
            model = training.train(rows.repartition(wide, "area"), "2024-01-01T08:00:00", "2024-01-02", {"n_estimators": 5, "max_depth": 3}, "t", "y", roles)
            tracker = context.statusTracker()
            stages = {s for j in tracker.getJobIdsForGroup(f"fit-{wide}") for s in tracker.getJobInfo(j).stageIds}
            tasks = [info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info is not None and info.numCompletedTasks]
            assert len(tasks) > 30 and sum(n > 4 for n in tasks) < len(tasks) / 3
            predicted.append(sorted((r.area, r.h, r.prediction) for r in model.transform(rows).collect()))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert predicted[0] == predicted[1]


def test_rows_of_a_fit_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_TASK", 100)
    rows = spark.range(350).selectExpr("id", "id % 3 AS k")
    assert [training.dealt(rows.limit(n), n).rdd.getNumPartitions() for n in (1, 100, 350)] == [1, 1, 4]
    assert sorted(training.dealt(rows, 350).collect()) == sorted(rows.collect())
    monkeypatch.setattr(training, "ROWS_PER_TASK", 1)
    assert training.dealt(rows, 350).rdd.getNumPartitions() == 8


def test_trials_share_one_encoding(spark, rows, monkeypatch):
    """Its tables are written once, not by each trial, and the trials' errors are those of the whole model."""
    table = rows(
        [(f"2024-01-{d:02d}", a, float(d * k), float(d)) for d in range(1, 9) for k, a in enumerate("abc")],
        "timestamp_hour timestamp, area string, trip_count double, target_lag_1 double",
    )
    made, models = [], []
    stages, fit = training.FeatureRoles.stages, training.train
    monkeypatch.setattr(training.FeatureRoles, "stages", lambda *a: made.append(1) or stages(*a))
    monkeypatch.setattr(training, "train", lambda *a: models.append(fit(*a)) or models[-1])
    trials = spark.createDataFrame([(str(k), k + 1) for k in range(3)], "trial_id string, n_estimators int")
    done = training.run_trials(table, trials, "2024-01-06", "2024-01-09").collect()
    assert len(made) == 1 and [r.state for r in done] == ["SUCCEEDED"] * 3
    week = table.where("timestamp_hour >= '2024-01-06'")
    for trial, model in zip(done, models):
        error = training.rmse(model.transform(week), "trip_count").first()["rmse"]
        assert trial.rmse == pytest.approx(error)
    empty = training.run_trials(table, trials, "2023-01-06", "2024-01-09").collect()
    assert [(r.state, r.rmse) for r in empty] == [("FAILED: ValueError", None)] * 3


@pytest.mark.parametrize("gains, fitted", [(True, [16, 40]), (False, [16])])
def test_boosting_ends_with_the_trees_of_the_whole_fit(spark, monkeypatch, gains, fitted):
    """Whether the error falls in each round or the ten rounds without gain come early; sampling of rows and columns included."""
    x = F.col("id") % 37
    noise = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(100))
    rows = spark.range(600).select(x.alias("a"), (F.col("id") % 5).alias("b"), (x * 3 if gains else noise).cast("double").alias("y"), (F.col("id") % 3 == 0).alias("held"))
    ready = training.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).coalesce(1).persist()
    held_out, seen = ready.where("held"), ready.where("not held")
    regressor = training._regressor({"n_estimators": 40, "max_depth": 2, "learning_rate": 0.05 if gains else 0.3}, "y")
    whole = regressor.fit(seen)
    errors = list(whole.evaluateEachIteration(held_out, "squared"))
    want = training.first_trees(whole, training.best_round(errors))
    asked, fit = [], training.GBTRegressor.fit
    monkeypatch.setattr(training.GBTRegressor, "fit", lambda self, *a: asked.append(self.getMaxIter()) or fit(self, *a))
    made = training.boosted(regressor, seen, held_out)
    assert asked == fitted and regressor.getMaxIter() == 40
    assert made.getNumTrees == want.getNumTrees and made.toDebugString.split("\n")[1:] == want.toDebugString.split("\n")[1:]


@pytest.mark.parametrize("query", ["forecasting_run", "hyperparameter_search"])
def test_searches_have_the_whole_ranges(spark, tmp_path, monkeypatch, query):
    spark.range(300).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-02' + make_interval(0, 0, 0, 0, 2 * id) AS ts", "id % 3 AS user_id", "'click' AS event_type",
        "1e0 AS value", "'{}' AS props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    planned = []

    class Seen(Exception):
        pass

    def run(rows, trials, *a, **k):
        planned.extend(trials.collect())
        raise Seen

    monkeypatch.setattr(training, "run_trials", run)
    with pytest.raises(Seen):
        getattr(models, query)(spark, str(tmp_path))
    assert planned == training.sample_trials(spark).collect() and len(planned) == 10
    low, high, _ = training.SEARCH_RANGES["n_estimators"]
    assert (low, high) == (50, 500) and all(low <= r.n_estimators <= high for r in planned) and max(r.n_estimators for r in planned) > 400
