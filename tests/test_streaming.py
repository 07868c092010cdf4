import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import at
from hazardflow.operators import dedup, enrich, frequency
from hazardflow.plans import bronze, silver
from hazardflow.sources import geojson, layers, tables
from hazardflow.streaming import ingest, live
from hazardflow import schemas

AS_OF = "2024-01-10 00:00:00"
BASE = 1704067200  # 2024-01-01


def drain(writer):
    ingest.start(writer, available_now=True).awaitTermination()


class Landing:
    """A folder that gets one file per call, each later than the one before."""

    def __init__(self, path):
        self.path, self.files = path, 0
        path.mkdir()

    def add(self, *features):
        self.files += 1
        file = self.path / f"poll-{self.files}.json"
        file.write_text(json.dumps({"features": list(features)}) + "\n")
        os.utime(file, (BASE + self.files, BASE + self.files))


def feature(id_, seconds, mag, updated=0, lat=35.0, lon=139.0):
    return {"id": id_, "geometry": {"coordinates": [lon, lat, 10]},
            "properties": {"mag": mag, "time": (BASE + seconds) * 1000, "updated": (BASE + updated) * 1000, "sig": 700, "place": "P"}}


def bronze_stream(spark, landing):
    documents = ingest.landed_documents(spark, str(landing.path), files_per_batch=1)
    return bronze.quakes(documents, AS_OF, "b1")


def test_ingest_appends_every_file_once(spark, tmp_path):
    landing = Landing(tmp_path / "landing")
    landing.add(feature("ev0001", 0, 4.0))
    landing.add(feature("ev0002", 90_000, 4.0), {"id": "bad", "geometry": None, "properties": {}})
    for _ in range(2):
        drain(ingest.append_table(bronze_stream(spark, landing), str(tmp_path / "bronze"), str(tmp_path / "check")))
    rows = spark.read.parquet(str(tmp_path / "bronze"))
    assert sorted((r["event_id"], r["day"]) for r in rows.collect()) == [("ev0001", 1), ("ev0002", 2)]
    assert set(schemas.BRONZE_QUAKES.names) <= set(rows.columns)


def test_latest_version_wins_across_batches(spark, tmp_path):
    landing, root = Landing(tmp_path / "landing"), str(tmp_path / "silver")
    landing.add(feature("ev0001", 86_399, 4.0, updated=10), feature("ev0002", 0, 3.0, updated=50))
    landing.add(feature("ev0001", 86_401, 4.5, updated=20), feature("ev0002", 0, 9.0, updated=40))
    landing.add(feature("ev0003", 0, 0.5), feature("ev0001", 86_401, 4.1, updated=15))
    stream = bronze_stream(spark, landing).drop("year", "month", "day", "hour")
    writer = ingest.upsert_table(stream, root, str(tmp_path / "check"), prepare=lambda batch, n: silver.quakes(batch, AS_OF, f"b{n}"))
    drain(writer)
    got = {r["event_id"]: (r["magnitude"], r["day"]) for r in spark.read.parquet(root).collect()}
    assert got == {"ev0001": (4.5, 2), "ev0002": (3.0, 1)}


def test_live_tables_equal_the_batch_job_in_falling_time_order(spark, tmp_path):
    """Three files, newest first, one a batch: a late row two days old, a revision that moves an
    event to another hour, and a burst of 23.75 hours over midnight."""
    landing, root = Landing(tmp_path / "landing"), str(tmp_path / "silver")
    hours, bursts = str(tmp_path / "hours"), str(tmp_path / "bursts")
    landing.add(*[feature(f"ev1{i:03}", 3 * 86_400 + 3600 * (i % 4), 3.0 + i % 2, lat=35.0 if i % 3 else 0.0) for i in range(12)])
    landing.add(*[feature(f"ev2{i:03}", 2 * 86_400 - 900 - i * 21_300, 4.0, lat=10.2, lon=10.2) for i in range(5)])
    landing.add(feature("ev3000", 60, 5.0), feature("ev1001", 3 * 86_400 + 10, 3.3, updated=99))

    def then(touched, number):
        live.log_hours(touched, hours, number)
        live.refresh_succession(spark, root, bursts, touched)

    stream = bronze_stream(spark, landing).drop("year", "month", "day", "hour")
    drain(ingest.upsert_table(stream, root, str(tmp_path / "check"), prepare=lambda batch, n: silver.quakes(batch, AS_OF, f"b{n}"), then=then))
    documents = geojson.read_documents(spark, str(landing.path))
    whole = silver.quakes(bronze.quakes(documents, AS_OF, "b1").drop("year", "month", "day", "hour"), AS_OF)
    for found, batch in ((live.hourly_table(spark, hours), frequency.hourly_activity(whole)), (spark.read.parquet(bursts), live.rapid_succession(whole))):
        assert sorted(map(str, found.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))
    assert {r["event_id"] for r in spark.read.parquet(bursts).collect()} >= {"ev2000"}
    assert live.hourly_table(spark, hours).agg(F.sum("earthquake_count")).first()[0] == whole.count() == 18


def plain_bursts(rows, hours=24, least=5):
    out = []
    for cell, id_, at_ in rows:
        inside = sorted(t for c, _, t in rows if c == cell and at_ - dt.timedelta(hours=hours) <= t <= at_)
        if len(inside) >= least:
            out.append((id_, inside[0], at_, len(inside)))
    return sorted(out)


@pytest.mark.parametrize("block", [600_000_000, 3_600_000_000, 86_400_000_000 * 3])
def test_rapid_succession_equals_plain_windows(spark, monkeypatch, block):
    """Ties, exact 24 hours and a microsecond more, gaps of days, several cells, rows without time or place."""
    monkeypatch.setattr(live, "SUCCESSION_BLOCK", block)
    rnd = random.Random(8)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for cell in range(3):
        for n in range(70):
            moment = start + dt.timedelta(minutes=rnd.choice((10, 30, 97)) * rnd.randrange(200), microseconds=rnd.choice((0, 0, 1)))
            rows.append((cell, f"c{cell}n{n}", moment))
    rows += [(5, f"edge{n}", start + dt.timedelta(hours=6 * n)) for n in range(5)]
    rows += [(6, f"over{n}", start + dt.timedelta(hours=6 * n, microseconds=n == 4)) for n in range(5)]
    rows += [(7, f"same{n}", start) for n in range(5)]
    table = [(i, t, 10.0 + c, 20.5) for c, i, t in rows]
    table += [(f"none{n}", None, 11.0, 20.5) for n in range(6)] + [(f"lost{n}", start, None, 20.5) for n in range(6)]
    frame = spark.createDataFrame(table, "event_id string, event_time timestamp, latitude double, longitude double").repartition(3)
    got = sorted((r.event_id, r.window_start, r.window_end, r.event_count) for r in live.rapid_succession(frame).collect())
    assert got == plain_bursts(rows)
    assert {r[0] for r in got} >= {"edge4", "same0"} and "over4" not in {r[0] for r in got}


def test_hour_log_does_not_depend_on_batches_and_bears_repetition(spark, tmp_path, monkeypatch):
    """Revisions, moves and removals in forty batches, with compactions; a batch that comes again adds nothing."""
    monkeypatch.setattr(layers, "MOST_LAYERS", 3)
    monkeypatch.setattr(layers, "BUCKET_BYTES", 4_000)
    rnd = random.Random(4)
    root, hours, flags = (str(tmp_path / name) for name in ("silver", "hours", "flags"))
    schema = "event_id string, event_time timestamp, ingestion_time timestamp, magnitude double, geographic_region string"
    baseline = spark.createDataFrame([("A", 2.0, 1.0, 3.0)], "geographic_region string, baseline_count_mean double, baseline_count_std double, baseline_mag_mean double")
    final, batches = {}, []
    for number in range(14):
        rows = []
        for _ in range(6):
            row = (f"e{rnd.randrange(25)}", dt.datetime(2024, 1, 1 + rnd.randrange(3), rnd.randrange(4)), dt.datetime(2024, 2, 1, 0, number), rnd.choice((3.0, 4.5, None)), rnd.choice("AB"))
            rows = [r for r in rows if r[0] != row[0]] + [row]
            final[row[0]] = row
        batches.append(enrich.add_quake_partitions(spark.createDataFrame(rows, schema)))
    for number, batch in enumerate(batches):
        for _ in range(1 + (number == 5)):  # once more, as after a crash before the commit
            def then(touched, number=number):
                live.log_hours(touched, hours, number)
                live.log_alerts(touched, hours, baseline, flags, number)

            tables.upsert_days(batch, root, dedup.latest_quakes, ["event_id"], then=then)
    whole = frequency.hourly_activity(spark.createDataFrame(list(final.values()), schema))
    rounded = lambda df: sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.collect())
    names = whole.columns
    assert rounded(live.hourly_table(spark, hours).select(*names)) == rounded(whole)
    want = live.frequency_alerts(whole, baseline)
    assert rounded(live.alert_table(spark, flags, baseline).select(*want.columns)) == rounded(want)


def test_a_retry_after_the_swap_repeats_the_changes(spark, tmp_path):
    """The first try fails in ``then``, after the days were swapped in; the second counts what the first should have."""
    root, hours, stage = (str(tmp_path / name) for name in ("silver", "hours", "stage"))
    schema = "event_id string, event_time timestamp, ingestion_time timestamp, magnitude double, geographic_region string"
    make = lambda day, minute: enrich.add_quake_partitions(spark.createDataFrame([("a", dt.datetime(2024, 1, day), dt.datetime(2024, 2, 1, 0, minute), 3.0, "A")], schema))
    tables.upsert_days(make(1, 0), root, dedup.latest_quakes, ["event_id"], then=lambda touched: live.log_hours(touched, hours, 0))

    def fails(touched):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        tables.upsert_days(make(2, 1), root, dedup.latest_quakes, ["event_id"], stage, fails)
    tables.upsert_days(make(2, 1), root, dedup.latest_quakes, ["event_id"], stage, lambda touched: live.log_hours(touched, hours, 1))
    assert [(r.day, r.magnitude) for r in spark.read.parquet(root).collect()] == [(2, 3.0)]
    assert [(r.hour_window, r.earthquake_count) for r in live.hourly_table(spark, hours).collect()] == [(dt.datetime(2024, 1, 2), 1)]


def test_live_frequency_alert_against_the_stored_baseline(spark):
    rows = [("A", at(f"2024-01-0{d} 0{h}:00:00"), 3.0) for d in (1, 2, 3) for h in range(5) for _ in range(1 + h % 2)]
    history = spark.createDataFrame(rows, "geographic_region string, event_time timestamp, magnitude double")
    baseline = live.region_baseline(history, "2024-01-04 00:00:00")
    now = [("A", at("2024-01-04 00:00:00"), 3, 3.0, 3.0), ("A", at("2024-01-04 01:00:00"), 2, 3.0, 5.0), ("B", at("2024-01-04 00:00:00"), 10, 3.0, 3.0)]
    hourly = spark.createDataFrame(now, "geographic_region string, hour_window timestamp, earthquake_count bigint, avg_magnitude double, max_magnitude double")
    out = live.frequency_alerts(hourly, baseline).orderBy("geographic_region", "hour_window").collect()
    assert [r["frequency_anomaly"] for r in out] == [True, False, True]
    assert [r["magnitude_anomaly"] for r in out] == [False, True, False]


def test_outbox_queues_an_alert_once(spark, tmp_path):
    landing, root = Landing(tmp_path / "landing"), str(tmp_path / "outbox")
    landing.add(feature("ev0001", 0, 6.5, updated=1, lat=35.67, lon=139.65))
    landing.add(feature("ev0001", 0, 6.7, updated=2, lat=35.67, lon=139.65), feature("ev0002", 60, 5.1, lat=35.67, lon=139.65))
    landing.add(feature("ev0003", 60, 5.9, lat=0.0, lon=0.0))
    stream = bronze_stream(spark, landing).drop("year", "month", "day", "hour")
    writer = ingest.upsert_table(stream, root, str(tmp_path / "check"), merge=live.first_per_delivery, key="outbox_key",
                                 prepare=lambda batch, n: live.outbox_rows(silver.quakes(batch, AS_OF), n))
    drain(writer)
    rows = sorted((r["event_id"], r["channel"], r["recipient"], r["title"][-3:], r["queued_batch"]) for r in spark.read.parquet(root).na.fill("-").collect())
    assert rows == [
        ("ev0001", "sms", "+10000000001", "6.5", 0), ("ev0001", "sms", "+10000000002", "6.5", 0),
        ("ev0001", "teams", "-", "6.5", 0), ("ev0002", "teams", "-", "5.1", 1),
    ]


def test_late_rows_are_kept_apart(spark):
    rows = [("a", at("2024-01-01 00:00:00"), at("2024-01-02 00:00:00")), ("b", at("2024-01-01 00:00:00"), at("2024-01-02 00:00:01")), ("c", None, at("2024-01-02 00:00:00"))]
    df = spark.createDataFrame(rows, "event_id string, event_time timestamp, ingestion_time timestamp")
    on_time, late = live.split_late(df)
    assert sorted(r["event_id"] for r in on_time.collect()) == ["a", "c"]
    assert [r["event_id"] for r in late.collect()] == ["b"]
