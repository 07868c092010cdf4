"""Layer tables: pruned scans, partitioned writes, upserts and retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hazardflow import schemas
from hazardflow.functions.time import days_before, moment
from hazardflow.sources.layers import Layers, newest
from hazardflow.workspace import delete_path, fresh_path, path_exists

PARTS = schemas.PARTITION_COLUMNS
INGESTION_DAY = "ingestion_day"
DAY = "make_date(year, month, day)"


class Touched(set):
    """Days that an upsert touched. ``changes`` has the rows that went, with ``change`` -1, and those that came,
    with +1: the old and the new version of each key of the batch, alike or not."""

    changes: DataFrame


def scan(
    spark: SparkSession,
    root: str,
    schema: T.StructType | None = None,
    since=None,
    until=None,
    ingested_since=None,
) -> DataFrame:
    """Parquet scan; ``since``/``until`` prune whole days before any file is opened, and so does
    ``ingested_since`` in a table that ``append_bronze`` wrote.

    The predicates use the partition columns only. Add the exact time filter on
    top; these keep the days that can hold matching rows.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(root)
    if INGESTION_DAY in df.columns:
        if ingested_since is not None:
            df = df.filter(F.col(INGESTION_DAY) >= F.to_date(moment(ingested_since)))
        df = df.drop(INGESTION_DAY)
    if since is not None:
        df = df.filter(F.expr(DAY) >= F.to_date(moment(since)))
    if until is not None:
        df = df.filter(F.expr(DAY) <= F.to_date(moment(until)))
    return df


def _balanced(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one partition value together, hot values split, small ones merged."""
    return df.hint("rebalance", *columns)


def append(df: DataFrame, root: str, columns: list[str] | None = None) -> None:
    """Append to the table root; ``batch_id`` stays a column."""
    columns = columns or PARTS
    _balanced(df, columns).write.mode("append").partitionBy(*columns).parquet(root)


def append_bronze(df: DataFrame, root: str) -> None:
    """Append with the day of ingestion as a partition below the event's day, for refreshes to prune by."""
    append(df.withColumn(INGESTION_DAY, F.to_date("ingestion_time")), root, [*PARTS, INGESTION_DAY])


def overwrite_partitions(df: DataFrame, root: str, columns: list[str] | None = None) -> None:
    """Replace only the partitions present in ``df``."""
    columns = columns or PARTS
    (
        _balanced(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*columns)
        .parquet(root)
    )


def write_batch(df: DataFrame, root: str) -> None:
    """Result rows of one detection batch; a rerun replaces that batch only."""
    overwrite_partitions(df, root, ["detection_batch_id"])


def retain(df: DataFrame, as_of, days: int, column: str = "event_date") -> DataFrame:
    """Rows young enough to keep."""
    return df.filter(F.col(column) >= F.to_date(days_before(as_of, days)))


def replace_days(df: DataFrame, root: str, days: set[dt.date]) -> None:
    """Make ``df``, a stored table, the content of the given days; a day without rows disappears."""
    overwrite_partitions(df, root)
    for day in days - _days(df):
        delete_path(df.sparkSession, _day_path(root, day))


def drop_expired(spark: SparkSession, root: str, as_of, days: int) -> set[dt.date]:
    """Delete the day partitions older than ``days``; returns what was deleted. No row is read."""
    limit = spark.range(1).select(F.to_date(days_before(as_of, days))).first()[0]
    expired = {day for day in _days(spark.read.parquet(root)) if day < limit}
    for day in expired:
        delete_path(spark, _day_path(root, day))
    return expired


def upsert_days(
    updates: DataFrame,
    root: str,
    merge: Callable[[DataFrame], DataFrame],
    key: list[str],
    stage: str | None = None,
    then: Callable[[Touched], None] | None = None,
) -> set[dt.date]:
    """Merge rows into a day-partitioned table; reads and rewrites the touched days only.

    ``merge`` reduces old and new rows together, for example to the latest per
    ``key``. Touched are the days of the updates and the days where their keys
    stand now, which an index beside the table knows: a row may move any number
    of days. Returns the touched days.

    The index has (key, day) rows in layers, one for each batch, that are compacted
    to one row per key; a lookup reads the buckets of its keys (``layers``).

    ``stage`` is a path that belongs to this batch alone. The updates are written
    there once, then the merged days and, for ``then``, the rows that go; the days are
    swapped in, and ``then`` is called last, with the touched days. A retry goes on
    from the last finished step and never reads a half-swapped table. Indexing a
    key again changes nothing; what ``then`` does must bear a repetition.
    """
    spark, columns = updates.sparkSession, updates.columns
    stage = stage or fresh_path(spark, "stage")
    index = key_index(root, updates.schema, key)
    anew = not path_exists(spark, f"{stage}/merged/_SUCCESS")
    if anew:
        # not on a retry: the first try has indexed the new places of keys whose old ones are still needed
        index.compact(spark)

    def staged(name: str, make: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
        path = f"{stage}/{name}"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").parquet(path)
        return spark.read.schema(schema).parquet(path)

    fresh = staged("updates", lambda: updates, updates.schema)
    keys = fresh.select(*key).distinct()
    indexed, stands = path_exists(spark, index.root), path_exists(spark, root)
    known = index.lookup(keys) if indexed else None
    places = fresh.select(F.expr(DAY).alias("day"))
    if known is not None:
        places = places.unionByName(known.select("day"))
    touched = Touched(row[0] for row in places.distinct().collect())
    if not touched:
        delete_path(spark, stage)
        return touched

    def old() -> DataFrame:
        rows = spark.read.schema(updates.schema).parquet(root).select(*columns)
        return rows.filter(F.expr(DAY).isin(sorted(touched)))

    merged = staged("merged", lambda: merge(old().unionByName(fresh) if stands else fresh).select(*columns), updates.schema)
    now = merged.join(keys, key, "left_semi")
    if then is not None:
        touched.changes = now.withColumn("change", F.lit(1))
        if stands:
            replaced = staged("replaced", lambda: old().join(keys, key, "left_semi"), updates.schema)
            touched.changes = touched.changes.unionByName(replaced.withColumn("change", F.lit(-1)))
    moved = now.select(*key, F.expr(DAY).alias("day"))
    index.add(moved if known is None else moved.join(known, [*key, "day"], "left_anti"))
    replace_days(merged, root, touched)
    if then is not None:
        then(touched)
    delete_path(spark, stage)
    return touched


def key_index(root: str, schema: T.StructType, key: list[str]) -> Layers:
    """The index from key to day beside an upserted table."""
    fields = [schema[name] for name in key]
    return Layers(f"{root}__index", T.StructType([*fields, T.StructField("day", T.DateType())]), key, newest(key))


def _day_path(root: str, day: dt.date) -> str:
    return f"{root}/year={day.year}/month={day.month}/day={day.day}"


def _days(df: DataFrame) -> set[dt.date]:
    """Days present in a stored table; as many as the calendar has, however many rows."""
    return {row[0] for row in df.select(F.expr(DAY)).distinct().collect()}
