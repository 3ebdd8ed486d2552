"""Accuracy of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def mae_rmse(df: DataFrame, label: Column, prediction: Column) -> DataFrame:
    miss = label - prediction
    return df.agg(F.avg(F.abs(miss)).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse"))


def mape(df: DataFrame, label: Column, prediction: Column) -> DataFrame:
    """Mean absolute percentage error with one second added to the denominator."""
    share = F.abs(label - prediction) / (F.abs(label) + 1.0)
    return df.agg((F.avg(share) * 100).alias("mape"))


ERROR_SUMS = "predictor string, samples bigint, error_sum double"


def error_sums(arrivals: DataFrame, errors: dict[str, str]) -> DataFrame:
    """Samples and summed error per predictor, which add up over parts of the arrivals.

    ``errors`` maps a predictor to its column; negative and null errors do not count.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("predictor"), F.col(c).alias("abs_error"))
                      for name, c in errors.items()])
    return (arrivals.select(F.inline(pairs)).filter(F.col("abs_error") >= 0)
            .groupBy("predictor")
            .agg(F.count("*").alias("samples"), F.sum("abs_error").alias("error_sum")))


def mean_errors(sums: DataFrame) -> DataFrame:
    return sums.select("predictor", "samples", (F.col("error_sum") / F.col("samples")).alias("mae"))


def mae_summary(arrivals: DataFrame, errors: dict[str, str]) -> DataFrame:
    """Samples and mean error per predictor. ``errors`` maps a predictor to its column."""
    return mean_errors(error_sums(arrivals, errors))
