"""One verdict per event from the statistical, cluster and grid detectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardflow import config
from hazardflow.functions.stats import any_of
from hazardflow.functions.time import moment
from hazardflow.operators.cluster import ClusterModel, cluster_anomalies
from hazardflow.operators.grid import attach_cell_flags, geographic_anomalies
from hazardflow.operators.statistical import flag_outliers

DETECTORS = {
    "statistical": "statistical_anomaly",
    "clustering": "clustering_anomaly",
    "geographic": "geographic_anomaly",
}


def detect(events: DataFrame, model: ClusterModel | None) -> DataFrame:
    """Run the three detectors on silver events; one row in, one row out.

    Statistics arrive as scalar subqueries and the grid as a bounded broadcast,
    so the events themselves are never shuffled.
    """
    flagged = flag_outliers(events).drop(*[f"{name}_anomaly" for name in config.STAT_FEATURES])
    clustered = cluster_anomalies(flagged, model).drop("cluster_distance")
    return attach_cell_flags(clustered, geographic_anomalies(events))


def fuse(detected: DataFrame) -> DataFrame:
    """``is_anomaly``, the comma list of types, and the largest score.

    A detector that judged nothing (its flag is NULL) adds nothing; its own
    columns stay NULL.
    """
    filled = detected.withColumns({flag: F.coalesce(flag, F.lit(False)) for flag in DETECTORS.values() if flag != "clustering_anomaly"})
    names = [F.when(F.col(flag), F.lit(name)) for name, flag in DETECTORS.items()]
    return filled.withColumns({
        "is_anomaly": any_of([F.coalesce(flag, F.lit(False)) for flag in DETECTORS.values()]),
        "anomaly_types": F.concat_ws(",", *names),
        "anomaly_score": F.greatest(
            F.coalesce("magnitude_zscore", F.lit(0.0)) / config.ZSCORE_LIMIT,
            F.coalesce("clustering_anomaly_score", F.lit(0.0)),
            F.when(F.col("geographic_anomaly"), F.lit(1.0)).otherwise(F.lit(0.0)),
        ),
    })


def stamp_detection(df: DataFrame, as_of, batch_id: str) -> DataFrame:
    return df.withColumns({
        "detection_timestamp": moment(as_of),
        "detection_batch_id": F.lit(batch_id),
    })
