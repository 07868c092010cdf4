"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import Observation, functions as F

from checks import projections as P
from hazardflow import workspace
from hazardflow.operators import enrich, fusion, grid, quality, statistical, weather_patterns
from hazardflow.plans import dashboard, reports, silver
from hazardflow.sources import tables

@pytest.fixture(scope="module", autouse=True)
def whole_metadata(spark):
    """Scan metadata in full; the default cuts the pushed filters off."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark, sf):
    return workspace.stored(P.quakes(spark, sf), "bronze")


@pytest.fixture(scope="module")
def silver_table(spark, bronze):
    return workspace.stored(silver.quakes(bronze, P.AS_OF_QUAKES), "silver")


def test_validity_reaches_the_scan(spark, bronze):
    plan = plan_of(bronze.transform(quality.valid_coordinates).transform(quality.valid_quakes))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    for bound in ("latitude", "longitude", "magnitude", "depth_km", "event_time"):
        assert f"IsNotNull({bound})" in pushed


def test_reports_read_only_their_columns(spark, silver_table):
    plan = plan_of(reports.severity_distribution(silver_table))
    assert "ReadSchema: struct<magnitude:double,severity_category:string>" in plan
    plan = plan_of(dashboard.quake_kpi(silver_table, P.AS_OF_QUAKES))
    assert "ReadSchema: struct<event_time:timestamp>" in plan


def test_fusion_does_not_shuffle_the_events(spark, silver_table):
    """Only aggregates cross an exchange: cells, one-row statistics, and the bounded broadcast."""
    df = fusion.fuse(fusion.detect(silver_table, P.FIXED_MODEL)).select("event_id", "anomaly_score")
    plan = plan_of(df)
    exchanges = re.findall(r"(?<!Broadcast)Exchange (\w+)\((.*?)[,)]", plan)
    assert {kind for kind, _ in exchanges} <= {"hashpartitioning"}
    assert all(key.startswith(("lat_grid", "knownfloatingpointnormalized", "_groupingexpression")) for _, key in exchanges)
    assert "SortMergeJoin" not in plan


def test_shared_folder_follows_the_session(spark):
    folder = workspace.shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert folder == (configured or spark.sparkContext.getCheckpointDir())
    assert workspace.fresh_path(spark, "x") != workspace.fresh_path(spark, "x")


def test_statistics_are_one_subquery(spark, silver_table):
    plan = plan_of(statistical.flag_outliers(silver_table).filter("statistical_anomaly"))
    assert len(set(re.findall(r"Subquery subquery#(\d+)", plan))) == 1


def test_refresh_prunes_by_ingestion_day(spark, tmp_path):
    """Both refreshes of silver open only the days of ingestion in the look-back."""
    folders = {}
    for feed, table, parts in (("quakes", P.quakes(spark, "/root/testdata/sf0.001"), enrich.add_quake_partitions),
                               ("weather", P.weather(spark, "/root/testdata/sf0.001"), enrich.add_weather_partitions)):
        folders[feed] = str(tmp_path / feed)
        tables.append_bronze(parts(table.limit(200), hour=True), folders[feed])
        assert tables.INGESTION_DAY not in tables.scan(spark, folders[feed]).columns
    for feed, make, as_of in (("quakes", silver.quakes, P.AS_OF_QUAKES), ("weather", silver.weather, P.AS_OF_WEATHER)):
        plan = plan_of(make(silver.recent_bronze(spark, folders[feed], as_of), as_of))
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
        assert "ingestion_day" in filters, plan


def test_figures_come_with_the_write(spark, tmp_path):
    """Rows in and kept are counted in the plan that writes: one scan, no second job."""
    rows = tables.scan(spark, "/root/testdata/sf0.001/events.parquet")
    seen = Observation()
    kept = quality.observed(P.quake_columns(rows), quality.all_quake_rules(), seen).transform(quality.valid_quakes)
    plan = plan_of(kept)
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    kept.write.parquet(str(tmp_path / "kept"))
    assert seen.get["rows_in"] == rows.count() >= seen.get["rows_kept"] > 0


def test_chart_events_and_patterns_shuffle_no_more_than_they_need(spark, silver_table):
    assert "Exchange" not in plan_of(dashboard.chart_points(silver_table, "event"))
    profile = weather_patterns.pattern_profile(silver.weather(P.weather(spark, "/root/testdata/sf0.001").limit(50), P.AS_OF_WEATHER))
    assert "Expand" not in plan_of(profile) and "distinct" not in plan_of(profile)


def test_only_hot_cells_are_copied(spark, silver_table, monkeypatch):
    """Cells of a fine grid meet their events unsalted, except those with many events."""
    monkeypatch.setattr(grid, "MAX_BROADCAST_CELLS", 0)
    events = spark.range(6000).selectExpr(
        "cast(id AS string) AS event_id", "IF(id % 3 = 0, 10.5D, CAST(id % 80 AS DOUBLE)) AS latitude", "CAST(id % 170 AS DOUBLE) AS longitude",
        "3.0D AS magnitude", "timestamp_seconds(id) AS event_time").withColumn("longitude", F.when(F.col("latitude") == 10.5, 20.5).otherwise(F.col("longitude")))
    monkeypatch.setattr(grid, "HOT_SHARE", 10)
    cells = grid.geographic_anomalies(events)
    joined = grid.attach_cell_flags(events, cells)
    assert joined.count() == 6000
    sizes = [r[0] for r in joined.filter("latitude = 10.5").select(F.pmod(F.xxhash64("event_id"), F.lit(32))).distinct().collect()]
    assert len(sizes) == 32
    generated = re.search(r"Generate explode\(sequence\(0, (.*?), None", plan_of(joined)).group(1)
    assert "hot" in generated
