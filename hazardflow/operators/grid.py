"""Spatial grid profile and unusual cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardflow import config
from hazardflow.functions import geo
from hazardflow.functions.stats import any_of, over, with_statistics, zscore
from hazardflow.functions.time import span_hours

# A cell row in the join is a few dozen bytes; this many stay far below 64 MB.
MAX_BROADCAST_CELLS = 500_000
CELL_FLAGS = ["geographic_anomaly", "high_activity_anomaly", "rapid_succession_anomaly"]
_SALT, _HOT = "_cell_salt", "_hot_cell"
# A cell is hot with more than this part of all events.
HOT_SHARE = 1_000


def add_cell(df: DataFrame, degrees: float = config.GRID_DEGREES) -> DataFrame:
    return df.withColumns({
        "lat_grid": geo.grid_floor(F.col("latitude"), degrees),
        "lon_grid": geo.grid_floor(F.col("longitude"), degrees),
    }).withColumn("grid_cell", geo.grid_label(F.col("lat_grid"), F.col("lon_grid")))


def grid_profile(df: DataFrame, degrees: float = config.GRID_DEGREES) -> DataFrame:
    """Activity per cell. Grouping uses the numeric pair; the label is added after."""
    span = F.col("time_span_hours")
    cells = df.select(
        geo.grid_floor(F.col("latitude"), degrees).alias("lat_grid"),
        geo.grid_floor(F.col("longitude"), degrees).alias("lon_grid"),
        "magnitude",
        "event_time",
    )
    return (
        cells.groupBy("lat_grid", "lon_grid")
        .agg(
            F.count("*").alias("event_count"),
            F.avg("magnitude").alias("avg_magnitude"),
            F.max("magnitude").alias("max_magnitude"),
            F.stddev("magnitude").alias("magnitude_std"),
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
        )
        .withColumn("grid_cell", geo.grid_label(F.col("lat_grid"), F.col("lon_grid")))
        .withColumn("time_span_hours", span_hours(F.col("first_event"), F.col("last_event")))
        .withColumn(
            "event_rate_per_hour",
            F.when(span > 0, F.col("event_count") / span).otherwise(F.col("event_count")),
        )
    )


def flag_cells(profile: DataFrame) -> DataFrame:
    """Cells with unusual activity, magnitude, or rapid succession."""
    stats = {
        "avg_count": F.avg("event_count"),
        "std_count": F.stddev("event_count"),
        "avg_magnitude": F.avg("avg_magnitude"),
    }
    scored = with_statistics(profile, stats, profile, "_cells").withColumn(
        "count_zscore",
        zscore(F.col("event_count"), F.col("_cells.avg_count"), F.col("_cells.std_count")),
    )
    flagged = scored.withColumns({
        "high_activity_anomaly": over(F.col("count_zscore"), config.GRID_ZSCORE_LIMIT),
        "high_magnitude_anomaly": over(
            F.col("avg_magnitude"), F.col("_cells.avg_magnitude") + config.GRID_MAGNITUDE_EXCESS
        ),
        "rapid_succession_anomaly": F.coalesce(
            (F.col("event_count") >= config.SUCCESSION_COUNT)
            & (F.col("time_span_hours") <= config.SUCCESSION_HOURS),
            F.lit(False),
        ),
    })
    return flagged.withColumn(
        "geographic_anomaly",
        any_of([
            F.col("high_activity_anomaly"),
            F.col("high_magnitude_anomaly"),
            F.col("rapid_succession_anomaly"),
        ]),
    ).drop("_cells")


def grid_global_statistics(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.avg("event_count").alias("global_avg_count"),
        F.stddev("event_count").alias("global_std_count"),
        F.avg("avg_magnitude").alias("global_avg_magnitude"),
        F.avg("event_rate_per_hour").alias("global_avg_rate"),
    )


def geographic_anomalies(df: DataFrame, degrees: float = config.GRID_DEGREES) -> DataFrame:
    return flag_cells(grid_profile(df, degrees))


def attach_cell_flags(
    events: DataFrame, cells: DataFrame, degrees: float = config.GRID_DEGREES, salts: int = 32
) -> DataFrame:
    """Left join of cell flags onto events.

    Events outside the coordinate range get no flags. The number of cells follows from the cell size and not from the data, so a
    coarse grid is broadcast and the events are not shuffled. On a finer grid
    the hot cells are spread over ``salts`` sub-keys, so that a cell that holds a third of
    all events is split over that many tasks; the others are not copied. Hot is a cell with more
    than one in ``HOT_SHARE`` of the events, which the profile's counts tell, so there are fewer
    than ``HOT_SHARE`` of them, and their list is broadcast.
    """
    keys = ["lat_grid", "lon_grid"]
    # No-op on validated events. It makes the bound of the broadcast hold for any input,
    # and both ways below see the same cells.
    inside = geo.coordinates_valid(F.col("lat_grid"), F.col("lon_grid"))
    flags = cells.filter(inside).select(*keys, *CELL_FLAGS)
    located = add_cell(events, degrees)
    if geo.max_grid_cells(degrees) <= MAX_BROADCAST_CELLS:
        return located.join(F.broadcast(flags), keys, "left")
    counted = cells.filter(inside).select(*keys, "event_count")
    hot = with_statistics(counted, {"total": F.sum("event_count")}, counted, "_all").filter(
        F.col("event_count") * HOT_SHARE > F.col("_all.total")).select(*keys, F.lit(True).alias(_HOT))
    marked = located.join(F.broadcast(hot), keys, "left")
    spread = marked.withColumn(_SALT, F.when(F.col(_HOT), F.pmod(F.xxhash64("event_id"), F.lit(salts))).otherwise(0).cast("int"))
    last = F.when(F.col(_HOT), F.lit(salts - 1)).otherwise(F.lit(0))
    copies = flags.join(F.broadcast(hot), keys, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), last)))
    return spread.drop(_HOT).join(copies.drop(_HOT), [*keys, _SALT], "left").drop(_SALT)
