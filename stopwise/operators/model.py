"""Random-forest delay model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import FEATURES
from .forest import DelayForest, fit_forest
from .training import add_features

LABEL = "true_delay_seconds"


def fit_delay_model(training: DataFrame, num_trees: int = 400, max_depth: int = 25,
                    min_instances: int = 2, seed: int = 42) -> DelayForest:
    """Fit on all rows that have every feature."""
    return fit_forest(training, list(FEATURES), LABEL, num_trees=num_trees, max_depth=max_depth,
                      min_instances=min_instances, seed=seed)


def score(df: DataFrame, model: DelayForest | None,
          name: str = "predicted_delay_seconds") -> DataFrame:
    """Add the model's prediction; null for every row when there is no model."""
    if model is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    return model.transform(df, name)


def score_live_status(status: DataFrame, model: DelayForest | None) -> DataFrame:
    """Predictions for a live status table."""
    wait = F.unix_seconds("next_scheduled_time") - F.unix_seconds("timestamp")
    ready = add_features(status.withColumn("seconds_to_scheduled", wait))
    return score(ready, model).select(
        "codBus", "timestamp", "lat", "lon", "stop_sequence", "distance_m",
        "seconds_to_scheduled", "predicted_delay_seconds")


def feature_importance(model: DelayForest) -> DataFrame:
    """One row per feature, the most important first."""
    from pyspark.sql import SparkSession
    scores = model.importances()
    rows = [(name, float(value)) for name, value in zip(FEATURES, scores)]
    return (SparkSession.active()
            .createDataFrame(rows, "feature string, importance double")
            .orderBy(F.col("importance").desc(), "feature"))
