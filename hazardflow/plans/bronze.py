"""Landed documents to the bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from hazardflow.operators import enrich
from hazardflow.sources import geojson, tables


def quakes(documents: DataFrame, as_of, batch_id: str) -> DataFrame:
    return geojson.parse_quakes(documents, as_of, batch_id).transform(
        enrich.add_quake_partitions, hour=True
    )


def weather(documents: DataFrame, as_of, batch_id: str) -> DataFrame:
    return geojson.parse_weather(documents, as_of, batch_id).transform(
        enrich.add_weather_partitions, hour=True
    )


def _append(rows: DataFrame, root: str, figures: Observation) -> dict[str, int]:
    tables.append_bronze(rows, root)
    found = figures.get
    return {**found, "rows_rejected": found["rows_in"] - found["rows_kept"]}


def ingest_quakes(
    spark: SparkSession, landing: str, root: str, as_of, batch_id: str, multi_line: bool = False
) -> dict[str, int]:
    """Appends the landed features; returns rows_in, rows_kept and rows_rejected, counted by the write itself."""
    documents, figures = geojson.read_documents(spark, landing, multi_line), Observation()
    rows = geojson.parse_quakes(documents, as_of, batch_id, figures).transform(enrich.add_quake_partitions, hour=True)
    return _append(rows, root, figures)


def ingest_weather(
    spark: SparkSession, landing: str, root: str, as_of, batch_id: str, multi_line: bool = False
) -> dict[str, int]:
    """As ``ingest_quakes``, for alerts."""
    documents, figures = geojson.read_documents(spark, landing, multi_line), Observation()
    rows = geojson.parse_weather(documents, as_of, batch_id, figures).transform(enrich.add_weather_partitions, hour=True)
    return _append(rows, root, figures)
