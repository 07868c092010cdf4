"""Z-score outliers against the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardflow import config
from hazardflow.functions.stats import abs_zscore, any_of, over, with_statistics


def feature_statistics(df: DataFrame, features=None) -> DataFrame:
    """Mean and sample deviation of every feature, one row, one pass."""
    features = features or config.STAT_FEATURES
    return df.agg(*[expr.alias(name) for name, expr in _moments(features).items()])


def _moments(features) -> dict:
    moments = {}
    for name in features:
        moments[f"{name}_mean"] = F.avg(name)
        moments[f"{name}_std"] = F.stddev(name)
    return moments


def flag_outliers(df: DataFrame, features=None, limit: float = config.ZSCORE_LIMIT) -> DataFrame:
    """Adds ``{feature}_zscore``, ``{feature}_anomaly`` and their OR.

    The flags are computed on the rows themselves, so no self-join on the id
    is needed afterwards.
    """
    features = features or config.STAT_FEATURES
    scored = with_statistics(df, _moments(features), df, "_moments").withColumns({
        f"{name}_zscore": abs_zscore(
            F.col(name), F.col(f"_moments.{name}_mean"), F.col(f"_moments.{name}_std")
        )
        for name in features
    })
    flagged = scored.withColumns({
        f"{name}_anomaly": over(F.col(f"{name}_zscore"), limit) for name in features
    })
    return flagged.withColumn(
        "statistical_anomaly", any_of([F.col(f"{name}_anomaly") for name in features])
    ).drop("_moments")
