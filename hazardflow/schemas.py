"""Explicit schemas of the bronze tables."""

from __future__ import annotations

from pyspark.sql import types as T

def _fields(kind: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names.split()]


BRONZE_QUAKES = T.StructType(
    _fields(T.StringType(), "event_id net code")
    + _fields(T.DoubleType(), "latitude longitude depth_km")
    + _fields(T.StringType(), "place")
    + _fields(T.DoubleType(), "magnitude")
    + _fields(T.StringType(), "magnitude_type")
    + _fields(T.DoubleType(), "cdi mmi")
    + _fields(T.StringType(), "event_type status")
    + _fields(T.LongType(), "significance")
    + _fields(T.StringType(), "alert_level")
    + _fields(T.BooleanType(), "tsunami_warning")
    + _fields(T.LongType(), "nst")
    + _fields(T.DoubleType(), "gap dmin rms")
    + _fields(T.LongType(), "felt_reports")
    + _fields(T.TimestampType(), "event_time updated_time ingestion_time")
    + _fields(T.StringType(), "detail_url url data_source api_version batch_id")
)

BRONZE_WEATHER = T.StructType(
    _fields(
        T.StringType(),
        "alert_id identifier sender sender_name event_type headline description instruction "
        "severity certainty urgency response_type area_desc geocode geometry message_type "
        "category status",
    )
    + _fields(
        T.TimestampType(),
        "sent_time effective_time onset_time expires_time ends_time ingestion_time",
    )
    + _fields(T.StringType(), "data_source api_version batch_id")
)

PARTITION_COLUMNS = ["year", "month", "day"]
PARTITION_FIELDS = _fields(T.IntegerType(), "year month day")
