import json

import pytest
from pyspark.sql import functions as F

from conftest import at, column
from hazardflow import config
from hazardflow.operators import alerts
from hazardflow.plans import dashboard

SCHEMA = ("n int, title string, message string, severity string, event_type string, location string, "
          "magnitude double, timestamp timestamp, event_id string")


def alert(spark, *rows):
    base = {"title": "T", "message": "M", "severity": "Low", "event_type": "earthquake", "location": "L",
            "magnitude": 5.25, "timestamp": at("2024-01-01 10:00:00"), "event_id": "ev0001"}
    data = [(n, *[{**base, **row}[k] for k in base]) for n, row in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def test_quake_levels_and_text(spark):
    cases = [(4.99, "Low"), (5.0, "Medium"), (6.0, "High"), (7.0, "Critical")]
    df = spark.createDataFrame([(n, m, "Town", at("2024-01-01 00:00:00"), f"ev{n}") for n, (m, _) in enumerate(cases)],
                               "n int, magnitude double, place string, event_time timestamp, event_id string")
    rows = alerts.quake_alerts(df).orderBy("event_id").collect()
    assert [r["severity"] for r in rows] == [level for _, level in cases]
    assert rows[0]["title"] == "Earthquake Alert - Magnitude 5.0"
    assert rows[0]["message"] == "A magnitude 5.0 earthquake has been detected near Town."


def test_routing(spark):
    df = alert(spark, *[{"severity": s} for s in ("Critical", "High", "Medium", "Low", "Odd")])
    got = {}
    for row in alerts.route(df).collect():
        got.setdefault(row["severity"], set()).add(row["channel"])
    assert got == {"Critical": {"teams", "sms"}, "High": {"teams", "sms"}, "Medium": {"teams"}, "Low": {"teams"}, "Odd": {"teams"}}


def test_sms_text(spark):
    head, tail = "🌍 HIGH | ", " | Location: L | Mag: 5.2"
    fits = "x" * (160 - len(head) - len(tail))
    cases = [
        ({"severity": "High", "title": fits}, head + fits + tail),
        ({"severity": "High", "title": fits + "x"}, head + fits + "x | Location: L | Mag:..."),
        ({"location": ""}, "🌍 LOW | T | Mag: 5.2"),
        ({"location": None}, "🌍 LOW | T | Mag: 5.2"),
        ({"magnitude": 0.0}, "🌍 LOW | T | Location: L"),
        ({"magnitude": None}, "🌍 LOW | T | Location: L"),
        ({"event_type": "flood"}, "📢 LOW | T | Location: L | Mag: 5.2"),
        ({"magnitude": 6.35}, "🌍 LOW | T | Location: L | Mag: 6.3"),
    ]
    got = column(alert(spark, *[c for c, _ in cases]).withColumn("sms", alerts.sms_text()), "sms")
    assert got == [want for _, want in cases]


def test_missing_text_does_not_empty_a_message(spark):
    quake = spark.createDataFrame([("ev0001", 5.0, None, at("2024-01-01 00:00:00"))], "event_id string, magnitude double, place string, event_time timestamp")
    assert alerts.quake_alerts(quake).first()["message"] == "A magnitude 5.0 earthquake has been detected near an unknown place."
    weather = spark.createDataFrame([("wx0001", None, None, None, "Severe")], "alert_id string, event_type string, headline string, area_desc string, severity string")
    row = alerts.weather_alerts(weather, "2024-01-01").first()
    assert (row["title"], row["message"]) == ("Weather Alert - ", " affecting an unknown area")


def test_rules_reach_the_contacts_of_their_group(spark):
    df = alert(spark, {"severity": "High"}, {"severity": "Low", "event_id": "ev0002"}).withColumn("place", F.lit("A"))
    rules = [("q", "big", "severity = 'High'", ["teams", "sms"], "x"), ("q", "all", "true", ["sms"], "none")]
    fired = alerts.apply_rules(df, "q", "event_id", rules)
    sent = alerts.rule_outbox(fired, df, {"x": ["+1", "", "+2"], "none": []})
    rows = {(r["event_id"], r["rule"], r["channel"], r["recipient"]) for r in sent.collect()}
    assert rows == {("ev0001", "big", "teams", None), ("ev0001", "big", "sms", "+1"), ("ev0001", "big", "sms", "+2"),
                    ("ev0001", "all", "sms", None), ("ev0002", "all", "sms", None)}



@pytest.mark.parametrize("severity", ["Critical", "High", "Low"])
def test_card(spark, severity):
    text = column(alert(spark, {"severity": severity, "title": 'A "quoted" title'}).withColumn("c", alerts.card_json()), "c")[0]
    card = json.loads(text)["attachments"][0]
    assert card["contentType"] == "application/vnd.microsoft.card.adaptive"
    content = card["content"]
    head, body, place, facts = content["body"]
    urgent = "Attention" if severity in ("Critical", "High") else "Default"
    critical = "Attention" if severity == "Critical" else "Default"
    assert head == {"type": "Container", "style": "emphasis", "items": [
        {"type": "TextBlock", "text": '🌍 A "quoted" title', "size": "Large", "weight": "Bolder", "color": urgent},
        {"type": "TextBlock", "text": f"**Severity:** {severity}", "size": "Medium", "weight": "Bolder", "color": critical}]}
    assert body == {"type": "Container", "items": [{"type": "TextBlock", "text": "M", "wrap": True, "size": "Medium"}]}
    assert place == {"type": "FactSet", "facts": [{"title": "Location:", "value": "L"}]}
    assert facts["facts"] == [{"title": "Magnitude:", "value": "5.2"},
                              {"title": "Time:", "value": "2024-01-01 10:00:00 UTC"}, {"title": "Event ID:", "value": "ev0001"}]
    actions = [{"type": "Action.OpenUrl", "title": t, "url": u} for t, u in config.CARD_ACTIONS]
    assert content.get("actions") == (actions if severity == "Critical" else None)


def test_card_without_optional_parts(spark):
    bare = {"location": "", "magnitude": None, "timestamp": None, "event_id": None, "event_type": "anomaly"}
    content = json.loads(column(alert(spark, bare).withColumn("c", alerts.card_json()), "c")[0])["attachments"][0]["content"]
    assert [part["type"] for part in content["body"]] == ["Container", "Container"]


def test_recipients(spark):
    routed = alerts.route(alert(spark, {"severity": "High"}, {"severity": "Low", "event_id": "ev0002"}))
    rows = {(r["event_id"], r["channel"], r["recipient"]) for r in alerts.with_recipients(routed, ["+1", "", "+2"]).collect()}
    assert rows == {("ev0001", "teams", None), ("ev0001", "sms", "+1"), ("ev0001", "sms", "+2"), ("ev0002", "teams", None)}
    assert alerts.with_recipients(routed, [""]).filter("channel = 'sms' AND recipient IS NULL").count() == 1


def test_rollup(spark):
    df = spark.createDataFrame([("a", "sms", True), ("a", "sms", False), ("b", "sms", False)], "event_id string, channel string, success boolean")
    rows = {r["event_id"]: (r["attempts"], r["delivered"], r["success"]) for r in alerts.delivery_rollup(df).collect()}
    assert rows == {"a": (2, 1, True), "b": (1, 0, False)}


def test_rules_fire_once_each(spark):
    rules = [("q", "big", "magnitude >= 6.0", ["teams"], "x"), ("q", "named", "place == 'A'", ["teams", "sms"], "y"), ("w", "no", "true", [], "z")]
    df = spark.createDataFrame([("a", 6.0, "A"), ("b", 5.9, "B"), ("c", None, "A")], "event_id string, magnitude double, place string")
    rows = {(r["event_id"], r["rule"]) for r in alerts.apply_rules(df, "q", "event_id", rules).collect()}
    assert rows == {("a", "big"), ("a", "named"), ("c", "named")}


def test_points_are_aggregated_and_never_dropped(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("event_id"), F.lit(2.0).alias("magnitude"),
                                 F.timestamp_seconds(F.col("id") * 1800).alias("event_time"))
    for level, rows in (("event", 500), ("hour", 250), ("day", 11)):
        points = dashboard.chart_points(df, level).collect()
        assert {p["level"] for p in points} == {level} and len(points) == rows
        assert sum(p["event_count"] for p in points) == 500


def test_reduced_points_are_the_ends_of_each_bucket(spark):
    """Against plain sorting; ties, empty buckets, events without a magnitude."""
    rows = [(f"e{n:03}", None if n == 5 else float((n * 7) % 11), 1_000 * n // 3) for n in range(300)] + [("lone", 3.0, 900_000), ("x", None, 950_000)]
    df = spark.createDataFrame(rows, "event_id string, magnitude double, at long").withColumn("event_time", F.timestamp_seconds("at"))
    want = set()
    for bucket in {at // 7_200 for _, m, at in rows if m is not None}:
        inside = [(i, m, at) for i, m, at in rows if m is not None and at // 7_200 == bucket]
        by_time, by_size = sorted(inside, key=lambda r: (r[2], r[0])), sorted(inside, key=lambda r: (r[1], r[2], r[0]))
        want |= {(bucket * 7_200, r[0]) for r in (by_time[0], by_time[-1], by_size[0], by_size[-1])}
    got = [(r.b, r.event_id) for r in dashboard.reduced_points(df, 7_200).select(F.unix_seconds("bucket").alias("b"), "event_id").collect()]
    assert set(got) == want and len(got) == len(want)
    with pytest.raises(ValueError):
        dashboard.reduced_points(df, 0)


def test_unknown_bookmark(spark):
    with pytest.raises(ValueError):
        dashboard.bookmark(spark.range(1), "Nothing", "2024-01-01")
