"""Boosted-tree demand models on Spark ML: training, search, prediction, records."""

from __future__ import annotations

import math
import random
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, contextmanager, nullcontext
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark import StorageLevel, inheritable_thread_target
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoderModel, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand_engine.operators.clean import clip
from demand_engine.operators.encoding import look_up_parts, look_up_stage, one_hot_stages, read_dictionary
from demand_engine.operators.features import add_cyclic, add_target_features, align_features, feature_columns
from demand_engine.operators.score import rmse
from demand_engine.operators.series import split_by_date

# Default parameters. reg_lambda is kept in the trial table; Spark's trees have no
# counterpart for it.
DEFAULTS = {
    "n_estimators": 100,
    "learning_rate": 0.1,
    "max_depth": 5,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "reg_lambda": 1.0,
}
SEED = 42
STOP_AFTER = 10
#: Rounds of the first fit of a boosting that may end early; each further fit has twice as many, the last one all.
FIRST_ROUNDS = 16
#: Rows a task of a fit has on average at least. A fit runs two stages for each level of each tree, so on few rows the
#: number of tasks, not the work in them, decides how long it takes.
ROWS_PER_TASK = 10_000

# Searched ranges as (low, high, scale).
SEARCH_RANGES = {
    "n_estimators": (50, 500, "linear"),
    "learning_rate": (0.01, 0.3, "log"),
    "max_depth": (3, 10, "linear"),
    "reg_lambda": (0.1, 10.0, "log"),
}


@dataclass
class FeatureRoles:
    """What each column is used for. Only columns known in advance become features; the time, the
    target and the series id never do."""

    time: str
    target: str
    series: str
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    known_in_advance: list[str] | None = None

    def usable(self, cols: list[str]) -> list[str]:
        reserved = {self.time, self.target, self.series}
        known = cols if self.known_in_advance is None else self.known_in_advance
        return [c for c in cols if c in known and c not in reserved]

    def stages(self, rows: DataFrame) -> list:
        """One-hot encoding of the categorical columns, a slot for each value that ``rows`` have, then one vector. The
        values stay in a distributed dictionary; the driver knows how many there are."""
        stages, inputs = [], list(self.usable(self.numeric))
        for c in self.usable(self.categorical):
            stages += one_hot_stages(rows, c)
            inputs.append(f"{c}_hot")
        return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def feature_roles(
    df: DataFrame, time: str, target: str, series: str, numeric: list[str], categorical: list[str],
    known_in_advance: list[str] | None = None,
) -> FeatureRoles:
    missing = [c for c in [time, target, series, *numeric, *categorical] if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return FeatureRoles(time, target, series, list(numeric), list(categorical), known_in_advance)


def model_rows(
    demand: DataFrame, horizon: int, id: str = "pickup_community_area", time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """Demand rows with every feature that is known ``horizon`` steps ahead, incomplete rows dropped.

    ``area`` is the series id as text; the model encodes it as a sparse vector with a slot for each id.
    """
    made = add_cyclic(add_target_features(demand.select(time, id, target), horizon, id=id, time=time, target=target), time)
    return made.withColumn("area", F.col(id).cast("string")).dropna(subset=feature_columns(made))


def _regressor(params: dict, label: str) -> GBTRegressor:
    p = {**DEFAULTS, **params}
    share = float(p["colsample_bytree"])
    return GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol="prediction",
        maxIter=int(p["n_estimators"]),
        stepSize=float(p["learning_rate"]),
        maxDepth=int(p["max_depth"]),
        subsamplingRate=float(p["subsample"]),
        featureSubsetStrategy="all" if share >= 1 else str(share),
        seed=SEED,
    )


def best_round(errors: list[float], patience: int = STOP_AFTER) -> int:
    """How many rounds to keep: up to the smallest error before ``patience`` rounds in a row brought no gain."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model of the first n trees. Boosting adds trees one by one, so this is the model of n rounds."""
    made = model._java_obj
    trees = list(made.trees())[:n]
    gateway = SparkSession.active()._sc._gateway
    array = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, tree in enumerate(trees):
        array[i], weights[i] = tree, model.treeWeights[i]
    short = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(made.uid(), array, weights, model.numFeatures)
    return GBTRegressionModel(short)


def boosted(regressor: GBTRegressor, rows: DataFrame, held_out: DataFrame) -> GBTRegressionModel:
    """The best round's model of a fit of all the regressor's rounds, which ends once ``STOP_AFTER`` rounds in a row
    brought no gain on ``held_out``.

    Spark can neither stop after so many rounds nor go on with a model. As each tree has a seed of its own, a fit's
    trees are the first ones of any longer fit, so fits grow until the errors have those rounds or all rounds are
    fitted. The shorter fits together have fewer rounds than the regressor."""
    most = regressor.getMaxIter()
    rounds = FIRST_ROUNDS if 2 * FIRST_ROUNDS <= most else most
    while True:
        model = regressor.copy({regressor.maxIter: rounds}).fit(rows)
        errors = list(model.evaluateEachIteration(held_out, "squared"))
        best = best_round(errors)
        if rounds == most or len(errors) - best >= STOP_AFTER:
            return first_trees(model, best)
        rounds = 2 * rounds if 4 * rounds <= most else most


@contextmanager
def kept(rows: DataFrame):
    """Keeps the rows on the executors (memory, else disk) while several jobs read them."""
    mine = not rows.is_cached
    if mine:
        rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        if mine:
            rows.unpersist()


def dealt(ready: DataFrame, n: int) -> DataFrame:
    """n encoded rows in as many partitions as that number needs (``ROWS_PER_TASK``), at most those of a shuffle. They
    are dealt and sorted by what they hold, so a fit doesn't depend on how they lay before."""
    spark = ready.sparkSession
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    needed = min(wide, max(1, math.ceil(n / ROWS_PER_TASK)))
    # Vectors have a hash and no order.
    return ready.repartition(needed, F.xxhash64(*ready.columns)).sortWithinPartitions(F.xxhash64(*ready.columns))


class Encoded(NamedTuple):
    """The stages that encode rows, and the encoded rows: ``split``, the target, ``features``."""

    encode: PipelineModel
    ready: DataFrame


@contextmanager
def encoded(
    rows: DataFrame, train_end, val_end, time: str = "timestamp_hour", target: str = "trip_count",
    roles: FeatureRoles | None = None,
):
    """Encodes the rows of both sides once and keeps them while fits read them."""
    if roles is None:
        numeric = [c for c in feature_columns(rows) if not c.startswith("area_")]
        roles = FeatureRoles(time, target, "", numeric, ["area"])
    with kept(rows):
        sides = split_by_date(rows, train_end, val_end, time, check=True)
        encode = PipelineModel(roles.stages(sides.where("split = 'train'")))
        with kept(dealt(encode.transform(sides).select("split", target, "features"), sides.count())) as ready:
            yield Encoded(encode, ready)


def train(
    rows: DataFrame, train_end, val_end, params: dict | None = None, time: str = "timestamp_hour",
    target: str = "trip_count", roles: FeatureRoles | None = None, sides: Encoded | None = None,
) -> PipelineModel:
    """Fits on the rows before ``train_end``; the error on those up to ``val_end``, round by round, decides when the
    fit ends and how many trees are kept (``best_round``): the first ones of the fit.

    ``rows`` come from ``model_rows``; without ``params`` this is the single run with the defaults. Several fits may
    share ``sides``, the rows' ``encoded``.
    """
    regressor = _regressor(params or {}, target)
    with nullcontext(sides) if sides else encoded(rows, train_end, val_end, time, target, roles) as (encode, ready):
        model = boosted(regressor, ready.where("split = 'train'"), ready.where("split = 'validation'"))
    return PipelineModel([*encode.stages, model])


def model_inputs(model: PipelineModel) -> list[str]:
    """The columns a fitted model reads."""
    made, inputs = set(), []
    for stage in model.stages[:-1]:
        if isinstance(stage, SQLTransformer):
            column, slot, _, _ = look_up_parts(stage)
            inputs.append(column)
            made.add(slot)
        elif isinstance(stage, OneHotEncoderModel):
            made.add(stage.getOutputCol())
        else:
            inputs += [c for c in stage.getInputCols() if c not in made]
    return list(dict.fromkeys(inputs))


def predict(
    model: PipelineModel, rows: DataFrame, id: str = "pickup_community_area", time: str = "timestamp_hour"
) -> DataFrame:
    """(id, time, prediction), never below zero. A feature the model knows and the rows lack raises."""
    ready = rows if "area" in rows.columns else rows.withColumn("area", F.col(id).cast("string"))
    aligned = align_features(ready, model_inputs(model), [id, time])
    return clip(model.transform(aligned).select(id, time, "prediction"), "prediction", lower=0.0)


def validation_rmse(model: PipelineModel, sides: Encoded, target: str) -> float:
    held_out = sides.ready.where("split = 'validation'")
    return rmse(model.stages[-1].transform(held_out), target, "prediction").first()["rmse"]


def sample_trials(spark: SparkSession, ranges: dict = SEARCH_RANGES, n: int = 10, seed: int = SEED) -> DataFrame:
    """n random parameter sets; integer ranges give integers, ``log`` ranges are even on a log scale."""
    rng = random.Random(seed)

    def draw(low, high, scale):
        if scale == "log":
            value = math.exp(rng.uniform(math.log(low), math.log(high)))
        elif scale == "linear":
            value = rng.uniform(low, high)
        else:
            raise ValueError(f"unknown scale {scale!r}")
        return min(max(round(value), low), high) if isinstance(low, int) else value

    rows = [(str(i + 1), *[draw(*ranges[p]) for p in ranges]) for i in range(n)]
    types = ["bigint" if isinstance(ranges[p][0], int) else "double" for p in ranges]
    return spark.createDataFrame(rows, ", ".join(["trial_id string", *[f"{p} {t}" for p, t in zip(ranges, types)]]))


def run_trials(
    rows: DataFrame, trials: DataFrame, train_end, val_end, parallel: int = 1, time: str = "timestamp_hour",
    target: str = "trip_count",
) -> DataFrame:
    """The trials with ``state`` and ``rmse``. Every fit is a distributed job on the shared rows, which are encoded
    once; a trial that fails is recorded as such."""
    names = [c for c in trials.columns if c != "trial_id"]
    planned = trials.collect()
    # What Spark or the data refuse is recorded and the other trials go on; an error of this code isn't.
    refusals = (PySparkException, Py4JError, ValueError)

    def outcomes(sides: Encoded):
        def run(trial) -> tuple:
            try:
                model = train(rows, train_end, val_end, {c: trial[c] for c in names}, time, target, None, sides)
                return "SUCCEEDED", float(validation_rmse(model, sides, target))
            except refusals as error:
                return f"FAILED: {type(error).__name__}", None

        with ThreadPoolExecutor(max_workers=parallel) as pool:
            return list(pool.map(inheritable_thread_target(trials.sparkSession)(run), planned))

    with ExitStack() as held:
        try:
            sides = held.enter_context(encoded(rows, train_end, val_end, time, target))
        except refusals as error:
            found = [(f"FAILED: {type(error).__name__}", None)] * len(planned)
        else:
            found = outcomes(sides)
    done = [(t["trial_id"], *[t[c] for c in names], *outcome) for t, outcome in zip(planned, found)]
    fields = ", ".join(f"{n} {t}" for n, t in trials.dtypes)
    return trials.sparkSession.createDataFrame(done, f"{fields}, state string, rmse double")


def best_trial(trials: DataFrame, goal: str = "MINIMIZE", metric: str = "rmse") -> DataFrame:
    """The succeeded trial with the best metric, ties to the smaller id. Raises if none succeeded."""
    usable = trials.where((F.col("state") == "SUCCEEDED") & F.col(metric).isNotNull())
    order = F.asc(metric) if goal == "MINIMIZE" else F.desc(metric)
    best = usable.orderBy(order, "trial_id").limit(1)
    if best.isEmpty():
        raise RuntimeError("no trial succeeded")
    return best


def feature_importance(model: PipelineModel, rows: DataFrame, per_value: bool = False) -> DataFrame:
    """(feature, importance), largest first, per column the model reads. A categorical one has the sum over its values;
    with ``per_value`` each of them has a row ``column=value``, and all that the model doesn't know one ``column=``.
    The values come from the dictionary and not through the driver."""
    spark = rows.sparkSession
    encoded = {f"{c}_hot": (c, path, n) for c, _, path, n in (look_up_parts(s) for s in model.stages if isinstance(s, SQLTransformer))}
    scores = model.stages[-1].featureImportances.toArray()
    pairs, wide, at = [], [], 0
    for c in model.stages[-2].getInputCols():
        name, path, n = encoded.get(c, (c, None, 0))
        part = scores[at : at + n + 1]
        at += n + 1
        if path is None or not per_value:
            pairs.append((name, float(part.sum())))
            continue
        found = spark.createDataFrame([(k, float(x)) for k, x in enumerate(part[:n]) if x > 0], "slot bigint, importance double")
        known = read_dictionary(spark, path).join(found, "slot", "left")
        wide.append(known.select(F.concat(F.lit(f"{name}="), "value").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance")))
        pairs.append((f"{name}=", float(part[n])))
    out = spark.createDataFrame(pairs, "feature string, importance double")
    for more in wide:
        out = out.unionByName(more)
    return out.orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    """Writes the model and, next to it, the dictionaries that it reads."""
    spark, stages = SparkSession.active(), []
    for stage in model.stages:
        if isinstance(stage, SQLTransformer):
            column, slot, source, n = look_up_parts(stage)
            target = f"{path.rstrip('/')}-dictionaries/{uuid.uuid4().hex}"
            read_dictionary(spark, source).write.parquet(target)
            stage = look_up_stage(column, slot, target, n)
        stages.append(stage)
    PipelineModel(stages).write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def run_record(
    spark: SparkSession, path: str, display_name: str, create_time: str, forecast_horizon: int, window_size: int,
    model_path: str = "",
) -> DataFrame:
    """Appends one row about a training run to the runs table and returns the table."""
    row = [(display_name, create_time, model_path, forecast_horizon, window_size)]
    record = spark.createDataFrame(
        row, "display_name string, create_time string, model_path string, forecast_horizon int, window_size int"
    ).withColumn("create_time", F.to_timestamp("create_time"))
    record.coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)
