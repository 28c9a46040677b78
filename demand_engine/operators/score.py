"""Joining forecasts with actuals, and accuracy measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demand_engine.operators.series import seasonal_naive


def align_key_types(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The right side with its key cast to the type of the left one."""
    want, have = left.schema[key].dataType, right.schema[key].dataType
    if want == have:
        return right
    if not all(isinstance(t, (T.NumericType, T.StringType)) for t in (want, have)):
        raise ValueError(f"cannot join {key}: {have.simpleString()} is not castable to {want.simpleString()}")
    return right.withColumn(key, F.col(key).cast(want))


def restrict_to_range(act: DataFrame, pred: DataFrame, time: str = "timestamp") -> DataFrame:
    """Actuals between the first and last prediction, read as one one-row subquery."""
    seen = pred.agg(F.struct(F.min(time).alias("low"), F.max(time).alias("high")).alias("seen")).scalar()
    return act.where(F.col(time).between(seen.getField("low"), seen.getField("high")))


def join_actuals(pred: DataFrame, act: DataFrame, keys: tuple[str, str] = ("timestamp", "series_id")) -> DataFrame:
    """Rows that have both, on canonical names, ids cast to the type of the predictions."""
    aligned = align_key_types(pred, act, keys[1])
    return pred.select(*keys, "prediction").join(aligned.select(*keys, "actual"), list(keys), "inner")


def rmse(df: DataFrame, actual: str = "actual", prediction: str = "prediction") -> DataFrame:
    error = F.col(actual) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def naive_scale(history: DataFrame, season: int, id: str, time: str, target: str) -> Column:
    """Mean absolute error of the seasonal naive forecast on the history, as a scalar."""
    naive = seasonal_naive(history, season, id, time, target, name="_naive")
    return naive.select(F.avg(F.abs(F.col(target) - F.col("_naive")))).scalar()


def accuracy(df: DataFrame, by: list[str] = (), extra: bool = False, scale: Column | None = None) -> DataFrame:
    """MAE, RMSE and MAPE (percent), overall or per key, from one aggregation.

    MAPE is over the actuals that are not 0; without any it is infinite if there is a prediction that
    is not 0, else 0. No rows at all give NaN. ``extra`` adds WAPE and R², and with ``scale`` MASE.
    """
    actual, prediction = F.col("actual").cast("double"), F.col("prediction").cast("double")
    error = actual - prediction
    sums = [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("_mae"),
        F.sqrt(F.avg(error * error)).alias("_rmse"),
        F.avg(F.when(actual != 0, F.abs(error / actual))).alias("_mape"),
        F.sum(F.abs(prediction)).alias("_predicted"),
        F.sum(F.abs(error)).alias("_error"),
        F.sum(F.abs(actual)).alias("_actual"),
        F.sum(error * error).alias("_sse"),
        (F.var_pop(actual) * F.count(F.lit(1))).alias("_sst"),
    ]
    got = df.groupBy(*by).agg(*sums)
    nan = F.lit(float("nan"))

    def if_rows(value: Column) -> Column:
        return F.when(F.col("n") == 0, nan).otherwise(value)

    mape = (
        F.when(F.col("_mape").isNotNull(), F.col("_mape") * 100)
        .when(F.col("_predicted") > 0, F.lit(float("inf")))
        .otherwise(F.lit(0.0))
    )
    out = {"mae": if_rows(F.col("_mae")), "rmse": if_rows(F.col("_rmse")), "mape": if_rows(mape)}
    if extra:
        out["wape"] = F.when(F.col("_actual") > 0, F.col("_error") / F.col("_actual"))
        out["r2"] = F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst"))
        if scale is not None:
            out["mase"] = F.when(scale > 0, F.col("_mae") / scale)
    return got.select(*by, "n", *[c.alias(name) for name, c in out.items()])


def accuracy_by(df: DataFrame, id: str = "series_id", extra: bool = False) -> DataFrame:
    return accuracy(df, [id], extra)
