"""Live counts, frequency alerts, rapid succession, late rows and the outbox."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from hazardflow import config
from hazardflow.functions import geo
from hazardflow.functions.time import hours_before, moment
from hazardflow.operators import alerts, dedup, frequency
from hazardflow.sources import tables
from hazardflow.sources.layers import LAYER, Layers, newest
from hazardflow.workspace import stored

#: Microseconds of a block in which bursts are totalled.
SUCCESSION_BLOCK = 600_000_000


def _touched(spark: SparkSession, root: str, days: set[dt.date], around: int = 0) -> DataFrame:
    """Rows of the touched days of a table, and of ``around`` days before them."""
    wanted = {day - dt.timedelta(n) for day in days for n in range(around + 1)}
    return spark.read.parquet(root).filter(F.expr(tables.DAY).isin(sorted(wanted)))


def _parted(df: DataFrame, at: str) -> DataFrame:
    return df.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)})


HOUR_LOG = T.StructType([
    T.StructField("geographic_region", T.StringType()), T.StructField("hour_window", T.TimestampType()),
    T.StructField("magnitude", T.DoubleType()), T.StructField("events", T.LongType()),
])


def _summed(rows: DataFrame) -> DataFrame:
    keys = HOUR_LOG.names[:-1]
    summed = rows.groupBy(*keys).agg(F.sum("events").alias("events"), F.max(LAYER).alias(LAYER))
    return summed.filter("events != 0")


def hour_log(root: str) -> Layers:
    """Events per region, hour and magnitude, as a log of what each batch added and took away."""
    return Layers(root, HOUR_LOG, frequency.REGION_HOUR, _summed)


def log_hours(touched: tables.Touched, root: str, number: int) -> None:
    """Adds a batch's changes to the hourly counts: +1 for each version that came, -1 for each that went.

    Silver has one row per event, its newest version, so revisions are not counted twice, an event that
    moves leaves its old hour, and a late row is counted whenever it comes. No day is counted again, and the
    result does not depend on the batches. A batch that is repeated is not added again.
    """
    log = hour_log(root)
    log.compact(touched.changes.sparkSession)
    counted = touched.changes.withColumn("hour_window", F.date_trunc("hour", "event_time"))
    log.add(counted.groupBy(*HOUR_LOG.names[:-1]).agg(F.sum("change").cast("bigint").alias("events")).filter("events != 0"), number)


def _hourly(log: DataFrame) -> DataFrame:
    weighted = F.sum(F.col("magnitude") * F.col("events"))
    return log.groupBy(*frequency.REGION_HOUR).agg(
        F.sum("events").alias("earthquake_count"),
        (weighted / F.sum(F.when(F.col("magnitude").isNotNull(), F.col("events")))).alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"),
    )


def hourly_table(spark: SparkSession, root: str) -> DataFrame:
    """``frequency.hourly_activity`` of the silver table whose changes ``log_hours`` got."""
    return _hourly(hour_log(root).table(spark))


def flag_table(root: str, schema: T.StructType) -> Layers:
    """Flagged hours by region and hour; the newest batch that judged an hour counts."""
    return Layers(root, schema, frequency.REGION_HOUR, newest(frequency.REGION_HOUR))


def log_alerts(touched: tables.Touched, hours: str, baseline: DataFrame, root: str, number: int) -> None:
    """Judges the hours that a batch changed against the stored baseline; an hour without events left gets count 0."""
    spark = touched.changes.sparkSession
    changed = touched.changes.select("geographic_region", F.date_trunc("hour", "event_time").alias("hour_window")).distinct()
    left = _hourly(_summed(hour_log(hours).lookup(changed).withColumn(LAYER, F.lit(0))))
    current = changed.join(left, frequency.REGION_HOUR, "left").fillna(0, ["earthquake_count"])
    flagged = frequency_alerts(current, baseline)
    table = flag_table(root, flagged.schema)
    table.compact(spark)
    table.add(flagged, number)


def alert_table(spark: SparkSession, root: str, baseline: DataFrame) -> DataFrame:
    """``frequency_alerts`` of the hourly table, each hour as it was judged last."""
    schema = frequency_alerts(_hourly(spark.createDataFrame([], HOUR_LOG)), baseline).schema
    return flag_table(root, schema).table(spark).filter("earthquake_count > 0")


def region_baseline(silver: DataFrame, as_of, hours: int = config.BASELINE_HOURS) -> DataFrame:
    """Stored baseline per region over the hours before ``as_of``."""
    at = F.col("event_time")
    recent = silver.filter((at >= hours_before(as_of, hours)) & (at < moment(as_of)))
    return (
        frequency.hourly_activity(recent)
        .groupBy("geographic_region")
        .agg(
            F.avg("earthquake_count").alias("baseline_count_mean"),
            F.stddev("earthquake_count").alias("baseline_count_std"),
            F.avg("avg_magnitude").alias("baseline_mag_mean"),
        )
    )


def frequency_alerts(hourly: DataFrame, baseline: DataFrame) -> DataFrame:
    """Live hourly counts against the stored baseline.

    The baseline has a row per region; Spark broadcasts it if it is small.
    """
    return frequency.flag_frequency(hourly.join(baseline, "geographic_region", "left"))


def rapid_succession(events: DataFrame, degrees: float = config.GRID_DEGREES) -> DataFrame:
    """Events that end a burst: at least five in their cell in the 24 hours up to them, ends included.

    Each event is a mark when it comes and one just after the 24 hours for which it counts. An event's
    count is then a running total over the marks of its cell up to it, and the burst's first event is
    that of the next mark of the second kind. Both run within blocks of ten minutes and, over the blocks'
    totals, along the cell: the work is linear, and a cell with most of the events has as many tasks as
    its history has blocks. Rows without a time or a place end no burst.
    """
    lasting = config.SUCCESSION_HOURS * 3_600_000_000
    at = F.unix_micros("event_time")
    located = events.filter(F.col("event_time").isNotNull()).select(
        geo.grid_floor(F.col("latitude"), degrees).alias("lat_grid"),
        geo.grid_floor(F.col("longitude"), degrees).alias("lon_grid"), "event_id", "event_time", at.alias("at"))
    located = located.filter("lat_grid IS NOT NULL AND lon_grid IS NOT NULL")
    nothing = F.lit(None)
    marks = located.select("lat_grid", "lon_grid", F.inline(F.array(
        F.struct((2 * F.col("at")).alias("mark"), F.lit(1).alias("step"), F.col("event_id"), F.col("event_time"), nothing.cast("timestamp").alias("leaves")),
        F.struct((2 * (F.col("at") + lasting) + 1).alias("mark"), F.lit(-1).alias("step"), nothing.cast("string").alias("event_id"), nothing.cast("timestamp").alias("event_time"), F.col("event_time").alias("leaves")),
    )))
    cell = ["lat_grid", "lon_grid"]
    block = [*cell, "block"]
    marks = marks.withColumn("block", F.floor(F.col("mark") / F.lit(2 * SUCCESSION_BLOCK)))
    up_to = Window.partitionBy(*block).orderBy("mark")
    back_to = Window.partitionBy(*block).orderBy(F.desc("mark"))
    ran = marks.withColumns({"inside": F.sum("step").over(up_to), "first_inside": F.last("leaves", ignorenulls=True).over(back_to)}).filter("step = 1")
    totals = marks.groupBy(*block).agg(F.sum("step").alias("total"), F.min("leaves").alias("leaves"))
    earlier = Window.partitionBy(*cell).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*cell).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    beyond = totals.select(*block, F.sum("total").over(earlier).alias("before"), F.last("leaves", ignorenulls=True).over(later).alias("first_after"))
    counted = ran.join(beyond, block).withColumns({
        "event_count": F.col("inside") + F.coalesce("before", F.lit(0)), "window_start": F.coalesce("first_inside", "first_after"),
    })
    return counted.filter(F.col("event_count") >= config.SUCCESSION_COUNT).select(
        geo.grid_label(F.col("lat_grid"), F.col("lon_grid")).alias("grid_cell"),
        "event_id", "window_start", F.col("event_time").alias("window_end"), "event_count",
    )


def refresh_succession(spark: SparkSession, silver: str, root: str, days: set[dt.date]) -> None:
    """Bursts that end on the touched days or the days after them."""
    ends = days | {day + dt.timedelta(1) for day in days}
    found = _parted(rapid_succession(_touched(spark, silver, ends, around=1)), "window_end")
    tables.replace_days(stored(found.filter(F.expr(tables.DAY).isin(sorted(ends))), "succession"), root, ends)


def is_late(hours: int = config.DEDUP_HORIZON_HOURS) -> Column:
    """Ingested longer after the event than the dedup horizon covers."""
    return F.col("event_time") < F.col("ingestion_time") - F.expr(f"INTERVAL {int(hours)} HOURS")


def split_late(df: DataFrame, hours: int = config.DEDUP_HORIZON_HOURS) -> tuple[DataFrame, DataFrame]:
    """(on time, late); the late ones belong in the quarantine."""
    late = F.coalesce(is_late(hours), F.lit(False))
    return df.filter(~late), df.filter(late)


def outbox_rows(silver: DataFrame, batch_id: int = 0) -> DataFrame:
    """Outbox rows of the events that need an alert, with a key per delivery."""
    due = alerts.outbox(alerts.quake_alerts(silver.filter("requires_alert")))
    return due.withColumns({
        "outbox_key": F.concat_ws("|", "event_id", "channel", "recipient"),
        "queued_batch": F.lit(batch_id).cast("bigint"),
        "year": F.year("timestamp"),
        "month": F.month("timestamp"),
        "day": F.dayofmonth("timestamp"),
    })


def first_per_delivery(df: DataFrame) -> DataFrame:
    """Merge rule of the outbox: what is queued stays, a revised event adds nothing."""
    order = [F.col("queued_batch").asc(), F.col("timestamp").desc(), F.xxhash64("payload").asc()]
    return dedup.latest(df, "outbox_key", order)
