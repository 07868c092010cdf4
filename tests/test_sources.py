import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import at
from hazardflow import config, schemas
from hazardflow.operators import dedup, enrich
from hazardflow.plans import bronze, silver
from hazardflow.sources import feeds, geojson, tables

AS_OF = "2024-01-10 00:00:00"
MILLIS = 1704067200500


def feature(id_="ev0001", coordinates=(10.5, 20.25, 7), **props):
    return {"type": "Feature", "id": id_, "geometry": {"type": "Point", "coordinates": list(coordinates)},
            "properties": {"mag": 4.5, "time": MILLIS, "sig": 300, **props}}


def land(tmp_path, features, multi_line=False):
    text = json.dumps({"type": "FeatureCollection", "features": features}, indent=2 if multi_line else None)
    (tmp_path / "poll.json").write_text(text + "\n")
    return str(tmp_path)


def parse(spark, tmp_path, features, parser=geojson.parse_quakes, multi_line=False):
    docs = geojson.read_documents(spark, land(tmp_path, features, multi_line), multi_line)
    return {r["event_id"]: r for r in parser(docs, AS_OF, "b1").collect()}


@pytest.mark.parametrize("multi_line", [False, True])
def test_all_fields(spark, tmp_path, multi_line):
    full = feature(
        net="us", code="x", place="5 km N of Town", magType="mb", cdi=1, mmi="2.5", type="quarry blast",
        status="reviewed", alert=None, tsunami=1, nst=12, gap=40.5, dmin=0.1, rms=0.9, felt=3,
        updated=MILLIS + 1000, detail="d", url="u")
    row = parse(spark, tmp_path, [full], multi_line=multi_line)["ev0001"].asDict()
    assert (row["longitude"], row["latitude"]) == (10.5, 20.25)
    assert row["depth_km"] == 7.0 and row["magnitude"] == 4.5 and row["mmi"] == 2.5
    assert row["event_time"] == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert row["updated_time"] == dt.datetime(2024, 1, 1, 0, 0, 1, 500000)
    assert row["alert_level"] is None and row["tsunami_warning"] is True and row["nst"] == 12
    assert row["event_type"] == "quarry blast" and row["place"] == "5 km N of Town"
    assert row["batch_id"] == "b1" and row["data_source"] == "usgs_api"


def test_defaults_nulls_and_rejects(spark, tmp_path):
    no_sig = feature("no-sig")
    del no_sig["properties"]["sig"]
    cases = [
        feature("plain"), no_sig, feature("null-sig", sig=None), feature("float-sig", sig=600.7),
        feature("null-mag", mag=None), feature("text-mag", mag="n/a"), feature("quoted-mag", mag="5.5"),
        feature("time-zero", time=0), feature("no-time", time=None), feature("bad-time", time="noon"),
        feature("two", coordinates=(1, 2)), feature("four", coordinates=(1, 2, 3, 4)),
        feature("null-depth", coordinates=(1, 2, None)), feature("bad-lat", coordinates=(1, "x", 3)),
        {**feature("no-geometry"), "geometry": None}, {**feature("no-props"), "properties": None},
        feature("null-place", place=None),
    ]
    good = parse(spark, tmp_path, cases)
    bad = parse(spark, tmp_path, cases, geojson.rejected_quakes)
    assert {k: v["reasons"] for k, v in bad.items()} == {
        "null-sig": ["significance"], "text-mag": ["magnitude"], "bad-time": ["event_time"],
        "two": ["coordinates"], "bad-lat": ["latitude"], "no-geometry": ["coordinates"],
        "no-props": ["properties"],
    }
    assert set(good) | set(bad) == {c["id"] for c in cases} and not set(good) & set(bad)
    assert good["no-sig"]["significance"] == 0 and good["float-sig"]["significance"] == 600
    assert good["null-mag"]["magnitude"] is None and good["quoted-mag"]["magnitude"] == 5.5
    assert good["time-zero"]["event_time"] is None and good["no-time"]["event_time"] is None
    assert good["plain"]["event_type"] == "earthquake" and good["plain"]["place"] == ""
    assert good["null-place"]["place"] is None and good["null-depth"]["depth_km"] is None
    assert good["plain"]["tsunami_warning"] is False


def test_strict_defaults(spark, tmp_path):
    cases = [feature("null-depth", coordinates=(1.00005, 2, None)), feature("far", coordinates=(1, 91, 3)),
             feature("weak", mag=0.5), feature("no-mag", mag=None), feature("no-time", time=None)]
    rows = parse(spark, tmp_path, cases, geojson.parse_quakes_strict)
    assert set(rows) == {"null-depth", "no-time"}
    assert rows["null-depth"]["depth_km"] == 0.0 and rows["null-depth"]["place"] == "Unknown"
    assert rows["no-time"]["event_time"] == at(AS_OF)
    assert rows["null-depth"]["location"] == f"{2:.4f},{1.00005:.4f}"


def test_weather_documents(spark, tmp_path):
    props = {"id": "wx0001", "event": "Flood", "severity": "Severe", "sent": "2024-01-01T10:00:00-05:00",
             "expires": "2024-01-02T00:00:00Z", "onset": "later", "ends": None, "geocode": {"SAME": ["1"]}}
    features = [{"geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": props},
                {"geometry": None, "properties": {"id": "wx0002"}}, {"geometry": {}, "properties": {"id": "wx0003"}},
                {"geometry": {}, "properties": None}]
    docs = geojson.read_documents(spark, land(tmp_path, features))
    rows = {r["alert_id"]: r for r in geojson.parse_weather(docs, AS_OF, "b1").collect()}
    assert set(rows) == {"wx0001", "wx0002", "wx0003"}
    first = rows["wx0001"]
    assert first["sent_time"] == at("2024-01-01 15:00:00") and first["expires_time"] == at("2024-01-02 00:00:00")
    assert first["onset_time"] is None and first["ends_time"] is None
    assert json.loads(first["geocode"]) == {"SAME": ["1"]}
    assert json.loads(first["geometry"]) == {"type": "Point", "coordinates": [1, 2]}
    assert rows["wx0002"]["geometry"] is None and rows["wx0003"]["geometry"] is None
    assert rows["wx0002"]["geocode"] == "{}" and rows["wx0002"]["severity"] == ""


def test_bronze_round_trip_and_pruning(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    land(landing, [feature("ev0001"), feature("ev0002", time=MILLIS + 86_400_000)])
    bronze.ingest_quakes(spark, str(landing), root, AS_OF, "b1")
    bronze.ingest_quakes(spark, str(landing), root, AS_OF, "b2")
    everything = tables.scan(spark, root)
    assert everything.count() == 4
    assert set(schemas.BRONZE_QUAKES.names) | {"year", "month", "day", "hour"} == set(everything.columns)
    pruned = tables.scan(spark, root, since="2024-01-02", until="2024-01-02")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "make_date" in partition_filters
    assert [r["event_id"] for r in pruned.collect()] == ["ev0002", "ev0002"]


def versions(spark, rows):
    df = spark.createDataFrame(
        [(i, at(e), at(n), m) for i, e, n, m in rows],
        "event_id string, event_time timestamp, ingestion_time timestamp, magnitude double")
    return enrich.add_quake_partitions(df)


def stored(spark, root):
    return {r["event_id"]: (r["magnitude"], r["day"]) for r in spark.read.parquet(root).collect()}


def test_upsert_moves_events_and_ignores_old_versions(spark, tmp_path):
    root = str(tmp_path / "silver")
    first = [("a", "2024-01-01 23:59:00", "2024-01-02 00:00:00", 1.0),
             ("b", "2024-01-05 00:00:00", "2024-01-05 01:00:00", 2.0),
             ("c", "2024-01-09 00:00:00", "2024-01-09 01:00:00", 3.0)]
    tables.upsert_days(versions(spark, first), root, dedup.latest_quakes, ["event_id"])
    second = [("a", "2024-01-02 00:01:00", "2024-01-02 03:00:00", 1.5),
              ("b", "2024-01-05 00:00:00", "2024-01-05 00:30:00", 9.0),
              ("d", "2024-01-05 02:00:00", "2024-01-05 03:00:00", 4.0)]
    tables.upsert_days(versions(spark, second), root, dedup.latest_quakes, ["event_id"])
    want = {"a": (1.5, 2), "b": (2.0, 5), "c": (3.0, 9), "d": (4.0, 5)}
    assert stored(spark, root) == want
    tables.upsert_days(versions(spark, second), root, dedup.latest_quakes, ["event_id"])
    assert stored(spark, root) == want


@pytest.mark.parametrize("days", [1, 3, 400])
def test_upsert_finds_a_row_however_far_it_moves(spark, tmp_path, days):
    root = str(tmp_path / "silver")
    start = dt.datetime(2024, 1, 1, 12)
    moved = start + dt.timedelta(days)
    first = [("a", str(start), str(start), 1.0), ("b", str(start), str(start), 2.0),
             ("c", str(start + dt.timedelta(2)), str(start), 3.0)]
    tables.upsert_days(versions(spark, first), root, dedup.latest_quakes, ["event_id"])
    files = {str(p) for p in (tmp_path / "silver").rglob("*.parquet")}
    touched = tables.upsert_days(versions(spark, [("a", str(moved), str(moved), 1.5)]), root, dedup.latest_quakes, ["event_id"])
    assert touched == {start.date(), moved.date()}
    rows = spark.read.parquet(root).collect()
    assert sorted((r["event_id"], r["magnitude"]) for r in rows) == [("a", 1.5), ("b", 2.0), ("c", 3.0)]
    kept = {f for f in files if "day=3" in f}
    assert kept and kept <= {str(p) for p in (tmp_path / "silver").rglob("*.parquet")}
    # back again: the index knows the newest place although the oldest is in it too
    back = [("a", str(start), str(moved + dt.timedelta(1)), 1.7)]
    tables.upsert_days(versions(spark, back), root, dedup.latest_quakes, ["event_id"])
    assert sorted((r["event_id"], r["magnitude"]) for r in spark.read.parquet(root).collect()) == [("a", 1.7), ("b", 2.0), ("c", 3.0)]


def test_a_finished_stage_is_used_by_the_retry(spark, tmp_path):
    root, stage = str(tmp_path / "silver"), str(tmp_path / "stage")
    day = "2024-01-01 00:00:00"
    tables.upsert_days(versions(spark, [("a", day, "2024-01-01 01:00:00", 1.0)]), root, dedup.latest_quakes, ["event_id"])
    both = [("a", day, "2024-01-01 01:00:00", 1.0), ("b", day, "2024-01-01 02:00:00", 2.0)]
    for step, rows in (("updates", both[1:]), ("merged", both)):
        versions(spark, rows).write.parquet(f"{stage}/{step}")
    # The swap of the first try stopped half-way and lost the day.
    shutil.rmtree(f"{root}/year=2024/month=1/day=1")
    tables.upsert_days(versions(spark, both[1:]), root, dedup.latest_quakes, ["event_id"], stage)
    assert stored(spark, root) == {"a": (1.0, 1), "b": (2.0, 1)}
    assert not (tmp_path / "stage").exists()


def test_silver_refresh_keeps_older_days(spark, tmp_path):
    bronze_root, root = str(tmp_path / "bronze"), str(tmp_path / "silver")
    def quake(id_, event, ingested, magnitude):
        return (id_, at(event), at(ingested), magnitude, 10.0, 0.0, 0.0, 100, "here")
    schema = ("event_id string, event_time timestamp, ingestion_time timestamp, magnitude double, depth_km double, "
              "latitude double, longitude double, significance bigint, place string")
    for day, rows in {
        "2024-01-02 00:00:00": [quake("ev0001", "2024-01-01 10:00:00", "2024-01-01 10:05:00", 4.0)],
        "2024-01-05 00:00:00": [quake("ev0002", "2024-01-04 10:00:00", "2024-01-04 10:05:00", 5.0),
                                quake("ev0002", "2024-01-04 10:00:00", "2024-01-04 11:00:00", 5.5)],
    }.items():
        tables.append(enrich.add_quake_partitions(spark.createDataFrame(rows, schema)), bronze_root)
        silver.refresh_quakes(spark, bronze_root, root, day, day[:10])
    assert stored(spark, root) == {"ev0001": (4.0, 1), "ev0002": (5.5, 4)}


def test_bad_documents_and_elements_lose_nothing_else(spark, tmp_path):
    good = {"id": "ev0001", "geometry": {"coordinates": [1, 2, 3]}, "properties": {"mag": 4, "sig": 1}}
    lines = [json.dumps({"features": [good, "text", good]}), '{"features": [', json.dumps({"features": {"a": 1}}), json.dumps({"other": 1}),
             json.dumps({"features": [None, good, 5, {"id": "x"}, {"properties": [1]}]}), json.dumps({"features": []})]
    (tmp_path / "docs.json").write_text("\n".join(lines) + "\n")
    docs = geojson.read_documents(spark, str(tmp_path / "docs.json"))
    kept, bad = geojson.parse_quakes(docs, AS_OF, "b1"), geojson.rejected_quakes(docs, AS_OF, "b1")
    assert (kept.count(), bad.count()) == (3, 5)
    assert all("properties" in r["reasons"] for r in bad.collect())
    reasons = sorted((r["reason"], r["document"]) for r in geojson.rejected_documents(docs).na.fill("").collect())
    assert reasons == [("no features", ""), ("unreadable", lines[1]), ("unreadable", lines[2])]
    assert geojson.parse_weather(docs, AS_OF, "b1").count() + geojson.rejected_weather(docs).count() == 8


def test_batches_and_retention(spark, tmp_path):
    root = str(tmp_path / "gold")
    df = spark.createDataFrame([(1, at(AS_OF))], "n int, t timestamp")
    for batch in ("x", "y", "x"):
        tables.write_batch(df.withColumn("detection_batch_id", F.lit(batch)), root)
    assert spark.read.parquet(root).count() == 2
    days = spark.createDataFrame([("2023-10-12",), ("2023-10-11",)], "d string").select(F.to_date("d").alias("event_date"))
    assert [str(r[0]) for r in tables.retain(days, AS_OF, 90).collect()] == ["2023-10-12"]
    root = str(tmp_path / "raw")
    tables.append(versions(spark, [("a", "2023-10-11 23:00:00", AS_OF, 1.0), ("b", "2023-10-12 01:00:00", AS_OF, 2.0)]), root)
    assert [str(d) for d in tables.drop_expired(spark, root, AS_OF, 90)] == ["2023-10-11"]
    assert [r["event_id"] for r in spark.read.parquet(root).collect()] == ["b"]


def test_feeds(spark):
    rows = [("a", "2024-01-09 23:30:00", 1.0, 700), ("b", "2024-01-09 12:00:00", 4.5, 10), ("c", "2023-12-20 00:00:00", 2.5, 600)]
    df = spark.createDataFrame([(i, at(t), m, s) for i, t, m, s in rows],
                               "event_id string, event_time timestamp, magnitude double, significance bigint")
    got = {name: sorted(r["event_id"] for r in feeds.live_feed(df, AS_OF, name).collect()) for name in config.LIVE_FEEDS}
    assert got == {"significant_month": ["a", "c"], "4.5_month": ["b"], "2.5_month": ["b", "c"],
                   "all_hour": ["a"], "all_day": ["a", "b"]}
    with pytest.raises(ValueError):
        feeds.live_feed(df, AS_OF, "all_year")
    first = feeds.recent_quakes(df, "2023-12-01", AS_OF, min_magnitude=1.0, limit=2)
    assert [r["event_id"] for r in first.collect()] == ["c", "b"]
    many = spark.range(1500).selectExpr("cast(id AS string) AS event_id", f"TIMESTAMP '{AS_OF}' AS event_time", "5.0 AS magnitude", "700L AS significance")
    assert feeds.recent_quakes(many, "2023-12-01", AS_OF).count() == feeds.significant_quakes(many, AS_OF).count() == 1500
    assert feeds.significant_quakes(many, AS_OF, limit=100).count() == 100
