"""Feed queries: recent, significant and live earthquakes, active alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardflow import config
from hazardflow.functions.time import days_before, hours_before, moment


def recent_quakes(
    df: DataFrame,
    start,
    end,
    min_magnitude: float = config.FEED_MIN_MAGNITUDE,
    limit: int | None = None,
    bbox: dict[str, float] | None = None,
) -> DataFrame:
    """Oldest first within a time range, at least a magnitude, optionally in a box.

    All of them, or the first ``limit`` where a caller asks for a page.
    """
    chosen = df.filter(
        F.col("event_time").between(moment(start), moment(end))
        & (F.col("magnitude") >= min_magnitude)
    )
    if bbox:
        chosen = chosen.filter(
            F.col("latitude").between(bbox["min_lat"], bbox["max_lat"])
            & F.col("longitude").between(bbox["min_lon"], bbox["max_lon"])
        )
    ordered = chosen.orderBy("event_time", "event_id")
    return ordered if limit is None else ordered.limit(limit)


def significant_quakes(
    df: DataFrame, as_of, days: int | None = None, limit: int | None = None
) -> DataFrame:
    """Significant events of the last days, newest first; all, or the first ``limit``."""
    feed = config.SIGNIFICANT_FEED
    since = days_before(as_of, feed["days"] if days is None else days)
    chosen = df.filter(
        (F.col("event_time") >= since) & (F.col("significance") >= feed["min_significance"])
    ).orderBy(F.col("event_time").desc(), "event_id")
    return chosen if limit is None else chosen.limit(limit)


def live_feed(df: DataFrame, as_of, name: str = "significant_month") -> DataFrame:
    """One of the named summary feeds."""
    if name not in config.LIVE_FEEDS:
        raise ValueError(f"unknown feed: {name}")
    column, lowest, hours = config.LIVE_FEEDS[name]
    recent = df.filter(
        (F.col("event_time") > hours_before(as_of, hours)) & (F.col("event_time") <= moment(as_of))
    )
    return recent if column is None else recent.filter(F.col(column) >= lowest)


def active_weather(df: DataFrame, as_of) -> DataFrame:
    expires = F.col("expires_time")
    return df.filter(expires.isNull() | (expires > moment(as_of)))
