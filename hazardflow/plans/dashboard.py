"""Tables behind the dashboard: KPIs, map, feeds, charts, filters, drill-through."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hazardflow import config
from hazardflow.functions import text
from hazardflow.functions.severity import alert_level_for_quake, alert_level_for_weather
from hazardflow.functions.time import days_before, hours_before, moment
from hazardflow.operators.frequency import hourly_activity


def _trend(at: Column, as_of, counted: Column, name: str, trend: str) -> list[Column]:
    """Count of the last 24 hours, and its change against the mean of 7 days before."""
    end, day_ago, week_ago = moment(as_of), hours_before(as_of, 24), hours_before(as_of, 8 * 24)
    last = F.count_if(counted & (at > day_ago) & (at <= end))
    before = F.count_if(counted & (at > week_ago) & (at <= day_ago))
    change = last * 7.0 / F.nullif(before, F.lit(0)) - 1
    return [last.alias(name), F.round(change, 4).alias(trend)]


def quake_kpi(silver: DataFrame, as_of) -> DataFrame:
    return silver.agg(
        *_trend(
            F.col("event_time"), as_of, F.lit(True), "earthquake_count_24h", "earthquake_trend_7d"
        )
    )


def weather_kpi(silver: DataFrame, as_of) -> DataFrame:
    sent = F.col("sent_time")
    return silver.agg(
        F.count_if("is_active").alias("weather_alerts_active"),
        *_trend(sent, as_of, F.lit(True), "weather_alerts_24h", "weather_alert_trend"),
    )


def anomaly_kpi(fused: DataFrame, as_of) -> DataFrame:
    return fused.agg(
        *_trend(
            F.col("event_time"), as_of, F.col("is_anomaly"), "anomalies_detected_24h",
            "anomaly_trend",
        )
    )


def _freshness(latest: Column, at: Column) -> Column:
    minutes = (F.unix_timestamp(at) - F.unix_timestamp(latest)) / 60
    return F.round(F.greatest(F.lit(0.0), 1 - minutes / 60) * 100, 2)


def health_kpi(df: DataFrame, as_of) -> DataFrame:
    """100 at zero minutes of age, 0 at an hour or more; the trend is the change since a day before."""
    day_ago = hours_before(as_of, 24)
    latest = F.max("ingestion_time")
    before = F.max(F.when(F.col("ingestion_time") <= day_ago, F.col("ingestion_time")))
    now, then = _freshness(latest, moment(as_of)), _freshness(before, day_ago)
    return df.agg(
        latest.alias("latest_ingestion"),
        now.alias("system_health_score"),
        F.round(now - F.when(before.isNotNull(), then), 2).alias("health_trend"),
    )


def map_feed(silver: DataFrame, as_of) -> DataFrame:
    """Marker rows of the last week with their tooltip."""
    tooltip = F.concat(
        F.lit("Magnitude "), text.fixed_decimals(F.col("magnitude"), 1),
        F.lit(" • "), F.coalesce("place", F.lit("an unknown place")),
        F.lit("<br/>Time: "), F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"),
        F.lit("<br/>Depth: "), text.fixed_decimals(F.col("depth_km"), 1), F.lit(" km"),
    )
    return silver.filter(
        (F.col("event_time") >= days_before(as_of, config.MAP_DAYS))
        & (F.col("magnitude") >= config.MAP_MIN_MAGNITUDE)
    ).select(
        "event_id", "latitude", "longitude", "magnitude", "severity_category", "place",
        "event_time", "depth_km", tooltip.alias("tooltip"),
    )


def recent_alerts(
    quakes: DataFrame, weather: DataFrame, as_of, n: int = config.RECENT_ALERT_ITEMS
) -> DataFrame:
    """Newest alerts of both feeds with their age in words."""
    from_quakes = quakes.filter("requires_alert").select(
        F.concat(
            F.lit("Earthquake Alert - Magnitude "), text.fixed_decimals(F.col("magnitude"), 1)
        ).alias("headline"),
        F.col("place").alias("location"),
        F.col("event_time").alias("alert_time"),
        alert_level_for_quake("magnitude").alias("severity_level"),
        "event_id",
    )
    from_weather = weather.filter("requires_alert").select(
        F.concat(F.lit("Weather Alert - "), F.col("event_type")).alias("headline"),
        F.col("area_desc").alias("location"),
        F.col("sent_time").alias("alert_time"),
        alert_level_for_weather("severity").alias("severity_level"),
        F.col("alert_id").alias("event_id"),
    )
    newest = (
        from_quakes.unionByName(from_weather)
        .orderBy(F.col("alert_time").desc(), "event_id")
        .limit(n)
    )
    return newest.withColumn("time_ago", text.elapsed_text(F.col("alert_time"), moment(as_of)))


def hourly_stats(silver: DataFrame, as_of, days: int = config.MAP_DAYS) -> DataFrame:
    recent = silver.filter(F.col("event_time") >= days_before(as_of, days))
    return hourly_activity(recent, ["hour_window"]).select(
        "hour_window", "avg_magnitude", "earthquake_count"
    )


def weather_breakdown(silver: DataFrame) -> DataFrame:
    """Alerts per severity, with the grand total on every row."""
    counts = silver.groupBy("severity").agg(F.count("*").alias("alert_count"))
    total = counts.agg(F.sum("alert_count"))
    return counts.withColumn("total_alerts", total.scalar())


def anomaly_heatmap(fused: DataFrame) -> DataFrame:
    """Region by anomaly type; an event counts once under each of its types."""
    typed = fused.filter("is_anomaly").select(
        "geographic_region", F.explode(F.split("anomaly_types", ",")).alias("anomaly_type")
    )
    return typed.groupBy("geographic_region").agg(*[
        F.count_if(F.col("anomaly_type") == name).alias(name) for name in config.ANOMALY_TYPES
    ])


def events_timeline(
    quakes: DataFrame, weather: DataFrame, anomalies: DataFrame, as_of, hours: int | None = 24
) -> DataFrame:
    """One time line over the three tables; ``hours=None`` keeps all of it."""
    parts = [
        quakes.select("event_time", F.lit("earthquake").alias("event_type"), "severity_score",
                      F.lit("earthquake").alias("event_category")),
        weather.select(F.col("sent_time").alias("event_time"), "event_type",
                       F.col("combined_severity_score").alias("severity_score"),
                       F.lit("weather").alias("event_category")),
        anomalies.filter("is_anomaly").select(
            "event_time", F.col("anomaly_types").alias("event_type"),
            F.col("anomaly_score").alias("severity_score"),
            F.lit("anomaly").alias("event_category")),
    ]
    if hours is not None:
        since = hours_before(as_of, hours)
        parts = [part.filter(F.col("event_time") > since) for part in parts]
    return reduce(DataFrame.unionByName, parts)


def global_filter(
    df: DataFrame, start=None, end=None, regions=None, magnitude=None
) -> DataFrame:
    """The dashboard's date, region and magnitude filters; None leaves one open."""
    if start is not None:
        df = df.filter(F.col("event_time") >= moment(start))
    if end is not None:
        df = df.filter(F.col("event_time") <= moment(end))
    if regions:
        df = df.filter(F.col("geographic_region").isin(*regions))
    if magnitude is not None:
        df = df.filter(F.col("magnitude").between(*magnitude))
    return df


def bookmark(df: DataFrame, name: str, as_of) -> DataFrame:
    """Rows of a saved filter: by alert level and age, or by region and magnitude."""
    if name not in config.BOOKMARKS:
        raise ValueError(f"unknown bookmark: {name}")
    saved = config.BOOKMARKS[name]
    if "severity" in saved:
        df = df.filter(alert_level_for_quake("magnitude").isin(*saved["severity"]))
    since = hours_before(as_of, saved["hours"]) if "hours" in saved else None
    return global_filter(df, since, None, saved.get("regions"), saved.get("magnitude"))


def chart_points(df: DataFrame, level: str = "event") -> DataFrame:
    """Chart points: every event, or hourly or daily ones. The caller chooses the level."""
    if level not in config.POINT_LEVELS:
        raise ValueError(f"unknown level: {level}")
    at = F.col("event_time")
    if level == "event":  # silver has one row per event, so there is nothing to group
        return df.select(
            F.lit(level).alias("level"), at.alias("point_time"), "event_id", F.lit(1).cast("bigint").alias("event_count"),
            F.col("magnitude").alias("avg_magnitude"), F.col("magnitude").alias("max_magnitude"),
        )
    return df.groupBy(
        F.lit(level).alias("level"), F.date_trunc(level, at).alias("point_time"), F.lit(None).cast("string").alias("event_id"),
    ).agg(
        F.count("*").alias("event_count"),
        F.avg("magnitude").alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"),
    )


def reduced_points(df: DataFrame, seconds: int) -> DataFrame:
    """Points that draw the same line with fewer: of each time bucket the first, the last, the least and the
    greatest event, each once. The caller names the bucket's width, for example a pixel's.

    Equal times or magnitudes fall back to the id. Events without a time or magnitude have no point.
    One aggregate with map-side partials, however many events a bucket has.
    """
    if seconds < 1:
        raise ValueError("a bucket has at least a second")
    width = F.lit(seconds)
    bucket = F.timestamp_seconds(F.floor(F.unix_seconds("event_time") / width) * width)
    by_time = F.struct("event_time", "event_id", "magnitude")
    by_size = F.struct("magnitude", "event_time", "event_id")
    ends = df.filter("event_time IS NOT NULL AND magnitude IS NOT NULL").groupBy(bucket.alias("bucket")).agg(
        F.min(by_time).alias("first"), F.max(by_time).alias("last"), F.min(by_size).alias("least"), F.max(by_size).alias("greatest"))
    picked = F.array_distinct(F.array(*[
        F.struct(*[F.col(f"{name}.{field}").alias(field) for field in ("event_id", "event_time", "magnitude")])
        for name in ("first", "last", "least", "greatest")
    ]))
    return ends.select("bucket", F.inline(picked))


def drill_through(df: DataFrame, key: str, value) -> DataFrame:
    """Detail row of one id; the id may be a value or a scalar subquery column."""
    return df.filter(F.col(key) == value)
