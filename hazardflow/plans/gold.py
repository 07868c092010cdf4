"""Silver to anomaly results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazardflow import config
from hazardflow.operators import cluster, frequency, fusion, quality, weather_patterns
from hazardflow.sources import tables


def quake_anomalies(
    silver: DataFrame,
    as_of,
    batch_id: str = "batch",
    model: cluster.ClusterModel | None = None,
) -> DataFrame:
    """Fused verdict per event of the look-back; fits the clusters unless given.

    ``silver`` is read once per detector, so pass a table (``workspace.stored``
    makes one of any rows). Every event gets a verdict, however few there are.
    With fewer complete events than clusters there is no model, and the cluster
    flag and score are NULL.
    """
    events = quality.anomaly_window(silver, as_of)
    if model is None:
        model = cluster.fit_clusters(events, checkpoint=False)
    result = fusion.fuse(fusion.detect(events, model))
    return fusion.stamp_detection(result, as_of, batch_id)


def run_quakes(spark: SparkSession, silver_root: str, root: str, as_of, batch_id: str) -> None:
    """Detect on a stored silver table, reading the look-back's days only, and write the batch."""
    tables.write_batch(quake_anomalies(tables.scan(spark, silver_root), as_of, batch_id), root)


def run_weather(spark: SparkSession, silver_root: str, root: str, as_of, batch_id: str) -> None:
    tables.write_batch(weather_anomalies(tables.scan(spark, silver_root), as_of, batch_id), root)


def quake_frequency(silver: DataFrame, as_of, mode: str = "rows") -> DataFrame:
    return frequency.frequency_anomalies(quality.anomaly_window(silver, as_of), mode)


def weather_anomalies(
    silver: DataFrame,
    as_of,
    batch_id: str = "batch",
    days: int = config.ANOMALY_LOOKBACK_DAYS,
) -> DataFrame:
    alerts = quality.weather_window(silver, as_of, days)
    flagged = weather_patterns.flag_patterns(weather_patterns.pattern_profile(alerts))
    return fusion.stamp_detection(flagged, as_of, batch_id)
