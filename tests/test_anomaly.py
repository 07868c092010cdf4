import hashlib
import math
import statistics
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import at, column
from hazardflow import config
from hazardflow.operators import cluster, frequency, fusion, grid, statistical, weather_patterns
from hazardflow.plans import gold


def values(spark, xs):
    return spark.createDataFrame([(n, float(x) if x is not None else None) for n, x in enumerate(xs)], "n int, x double")


def test_zscore_limit_is_strict(spark):
    xs = [0.0] * 9 + [10.0]
    mean, std = statistics.mean(xs), statistics.stdev(xs)
    exact = (10.0 - mean) / std
    df = values(spark, xs)
    assert column(statistical.flag_outliers(df, ["x"], limit=exact - 1e-9), "x_anomaly")[-1] is True
    out = statistical.flag_outliers(df, ["x"], limit=column(statistical.flag_outliers(df, ["x"]), "x_zscore")[-1])
    assert column(out, "x_anomaly")[-1] is False


@pytest.mark.parametrize("xs", [[5.0], [5.0, 5.0, 5.0]])
def test_no_spread_gives_zero(spark, xs):
    out = statistical.flag_outliers(values(spark, xs), ["x"])
    assert column(out, "x_zscore") == [0.0] * len(xs)
    assert column(out, "statistical_anomaly") == [False] * len(xs)


def test_null_feature_is_not_an_outlier(spark):
    out = statistical.flag_outliers(values(spark, [1.0, 2.0, None]), ["x"])
    assert column(out, "x_zscore")[-1] is None
    assert column(out, "statistical_anomaly") == [False] * 3


def hours(spark, rows):
    return spark.createDataFrame(
        [("r", at(t), c, a, m) for t, c, a, m in rows],
        "geographic_region string, hour_window timestamp, earthquake_count bigint, avg_magnitude double, max_magnitude double",
    )


def test_first_hours_and_the_count_rule(spark):
    df = hours(spark, [("2024-01-01 00:00:00", 9, 3.0, 9.0), ("2024-01-01 01:00:00", 10, 3.0, 3.0),
                       ("2024-01-01 02:00:00", 5, 3.0, 4.51)])
    out = frequency.flag_frequency(frequency.rolling_baseline(df)).orderBy("hour_window").collect()
    assert [r["frequency_zscore"] for r in out][:2] == [0.0, 0.0]
    assert [r["frequency_anomaly"] for r in out] == [False, True, False]
    assert [r["magnitude_anomaly"] for r in out] == [False, False, True]
    assert [r["combined_anomaly"] for r in out] == [False, True, True]


def test_rows_and_range_differ_over_an_idle_week(spark):
    df = hours(spark, [("2024-01-01 00:00:00", 2, 3.0, 3.0), ("2024-01-01 01:00:00", 4, 3.0, 3.0),
                       ("2024-01-08 01:00:00", 6, 3.0, 3.0), ("2024-01-20 00:00:00", 8, 3.0, 3.0)])
    by_rows = frequency.rolling_baseline(df, "rows").orderBy("hour_window").collect()
    by_range = frequency.rolling_baseline(df, "range").orderBy("hour_window").collect()
    assert [r["baseline_count_mean"] for r in by_rows] == [None, 2.0, 3.0, 4.0]
    assert [r["baseline_count_mean"] for r in by_range] == [None, 2.0, 4.0, None]
    with pytest.raises(ValueError):
        frequency.rolling_baseline(df, "days")


def events(spark, rows):
    """(event_id, lat, lon, magnitude, time)"""
    return spark.createDataFrame(
        [(i, la, lo, m, at(t)) for i, la, lo, m, t in rows],
        "event_id string, latitude double, longitude double, magnitude double, event_time timestamp",
    )


def test_rapid_succession_is_inclusive_at_a_day(spark):
    exact = [(f"a{i}", 0.5, 0.5, 3.0, f"2024-01-0{1 + i // 4} 00:00:00") for i in range(5)]
    longer = [(f"b{i}", 5.5, 5.5, 3.0, f"2024-01-0{1 + i // 4} 00:00:0{i // 4}") for i in range(5)]
    few = [(f"c{i}", 9.5, 9.5, 3.0, "2024-01-01 00:00:00") for i in range(4)]
    cells = {r["grid_cell"]: r for r in grid.geographic_anomalies(events(spark, exact + longer + few)).collect()}
    assert cells["0.0_0.0"]["time_span_hours"] == 24.0 and cells["0.0_0.0"]["rapid_succession_anomaly"]
    assert not cells["5.0_5.0"]["rapid_succession_anomaly"]
    assert not cells["9.0_9.0"]["rapid_succession_anomaly"]
    assert cells["9.0_9.0"]["event_rate_per_hour"] == 4.0


def test_one_cell_has_no_activity_score(spark):
    row = grid.geographic_anomalies(events(spark, [("a", 1.0, 1.0, 3.0, "2024-01-01 00:00:00")])).first()
    assert row["count_zscore"] == 0.0 and row["geographic_anomaly"] is False


@pytest.mark.parametrize("degrees", [1.0, 0.1])
def test_cell_flags_with_a_hot_cell(spark, degrees):
    """Broadcast and salted join keep every event, also those of a cell with a third of them."""
    df = spark.range(3000).select(
        F.concat(F.lit("event"), F.col("id").cast("string")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(10.05)).otherwise((F.col("id") % 170 - 85).cast("double")).alias("latitude"),
        F.when(F.col("id") % 3 == 0, F.lit(20.05)).otherwise((F.col("id") % 340 - 170).cast("double")).alias("longitude"),
        (F.col("id") % 5 + 1).cast("double").alias("magnitude"),
        F.timestamp_seconds(F.col("id") * 60).alias("event_time"),
    )
    joined = grid.attach_cell_flags(df, grid.geographic_anomalies(df, degrees), degrees)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan.split("Subquery")[0]) or degrees < 1
    rows = joined.collect()
    assert len(rows) == len({r["event_id"] for r in rows}) == 3000
    assert all(r["high_activity_anomaly"] for r in rows if r["latitude"] == 10.05)
    assert all(r["geographic_anomaly"] is not None for r in rows)


def silver(spark, n, same=False):
    i = F.col("id")
    spread = F.lit(0) if same else i
    return spark.range(n).select(
        F.concat(F.lit("event"), i.cast("string")).alias("event_id"),
        (spread % 7 + 1).cast("double").alias("magnitude"),
        (spread % 300).cast("double").alias("depth_km"),
        (spread % 90).cast("double").alias("latitude"),
        (spread % 180).cast("double").alias("longitude"),
        (spread % 900).alias("significance"),
        F.lit(0.1).alias("severity_score"),
        F.lit("other").alias("geographic_region"),
        F.lit("here").alias("place"),
        F.timestamp_seconds(1704067200 + spread * 600).alias("event_time"),
        (spread % 1000).cast("double").alias("distance_to_major_city_km"),
    )


def test_cluster_distance_equals_a_plain_loop(spark):
    df = silver(spark, 400)
    model = cluster.fit_clusters(df, k=4)
    rows = cluster.cluster_anomalies(df, model).collect()
    features = cluster.complete_features(df).toPandas().set_index("event_id")
    assert len(rows) == 400
    centers = np.array(model.centers)
    distances = []
    for row in rows:
        x = features.loc[row["event_id"]].to_numpy()
        std = np.array(model.stds)
        scaled = np.where(std > 0, (x - np.array(model.means)) / np.where(std > 0, std, 1), 0.0)
        to_centers = np.sqrt(((centers - scaled) ** 2).sum(axis=1))
        assert row["cluster"] == int(to_centers.argmin())
        assert row["cluster_distance"] == pytest.approx(to_centers.min(), abs=1e-9)
        distances.append(to_centers.min())
    limit = statistics.mean(distances) + 2 * statistics.stdev(distances)
    assert [r["clustering_anomaly"] for r in rows] == [d > limit for d in distances]


def plain_fit(points, ids, k):
    """Rounds of k-means over whole numbers, by plain loops."""
    order = sorted(range(len(ids)), key=lambda i: (hashlib.md5(ids[i].encode()).hexdigest(), ids[i]))
    centers = [list(points[i]) for i in order[:k]]
    for _ in range(config.CLUSTER_MAX_ITER):
        members = [[] for _ in centers]
        for p in points:
            members[min(range(k), key=lambda j: (sum((a - b) ** 2 for a, b in zip(p, centers[j])), j))].append(p)
        moved = [[math.floor(Fraction(2 * sum(x) + len(m), 2 * len(m))) for x in zip(*m)] if m else c for m, c in zip(members, centers)]
        still = all(sum((a - b) ** 2 for a, b in zip(x, y)) <= cluster.STILL**2 for x, y in zip(moved, centers))
        centers = moved
        if still:
            break
    return centers


def test_the_fit_does_not_depend_on_partitions_and_equals_plain_loops(spark):
    df = silver(spark, 300).withColumn("depth_km", F.when(F.col("depth_km") > 3, F.col("depth_km")))
    one, other = cluster.fit_clusters(df.repartition(7), k=5), cluster.fit_clusters(df.orderBy(F.desc("magnitude")).coalesce(1), k=5, checkpoint=False)
    assert one == other
    rows = cluster.complete_features(df).collect()
    points = [[math.floor((r[name] - m) / s * cluster.FIXED + 0.5) if s > 0 else 0 for name, m, s in zip(cluster.FEATURES, one.means, one.stds)] for r in rows]
    assert one.stds[list(cluster.FEATURES).index("severity")] == 0.0
    assert [[round(x * cluster.FIXED) for x in c] for c in one.centers] == plain_fit(points, [r["event_id"] for r in rows], 5)
    values = [r["depth_km"] for r in rows]
    at_ = list(cluster.FEATURES).index("depth_km")
    assert one.means[at_] == pytest.approx(statistics.mean(values)) and one.stds[at_] == pytest.approx(statistics.stdev(values))


def test_identical_points_have_no_far_point(spark):
    df = silver(spark, 50, same=True)
    model = cluster.ClusterModel([0.0] * 9, [1.0] * 9, [[0.0] * 9])
    rows = cluster.cluster_anomalies(df, model).collect()
    assert not any(r["clustering_anomaly"] for r in rows)
    assert all(r["clustering_anomaly_score"] == pytest.approx(1 / 1.5) for r in rows)


def test_missing_features_keep_the_row(spark):
    df = silver(spark, 40).withColumn("depth_km", F.when(F.col("depth_km") > 0, F.col("depth_km")))
    model = cluster.ClusterModel([0.0] * 9, [1.0] * 9, [[0.0] * 9, [5.0] * 9])
    rows = cluster.cluster_anomalies(df, model).collect()
    missing = [r for r in rows if r["depth_km"] is None]
    assert len(rows) == 40 and len(missing) == 1
    assert missing[0]["cluster"] is None and missing[0]["clustering_anomaly"] is False


def test_too_few_rows_to_cluster(spark):
    df = silver(spark, 20)
    assert cluster.fit_clusters(df, k=21) is None
    assert cluster.fit_clusters(df, k=4) is not None
    rows = gold.quake_anomalies(df.limit(3), "2024-01-20 00:00:00").collect()
    assert len(rows) == 3  # no gate: a few events are judged like many
    assert {r["clustering_anomaly"] for r in rows} == {None} and {r["cluster"] for r in rows} == {None}
    assert all(r["is_anomaly"] is not None for r in rows)


def test_both_ways_of_attaching_cells_agree(spark, monkeypatch):
    rows = [(f"ev{i}", at("2024-01-01 00:00:00"), 3.0, 95.0 if i < 6 else 10.0, 20.0) for i in range(12)]
    df = spark.createDataFrame(rows, "event_id string, event_time timestamp, magnitude double, latitude double, longitude double")
    cells = grid.geographic_anomalies(df)
    got = []
    for bound in (grid.MAX_BROADCAST_CELLS, 0):
        monkeypatch.setattr(grid, "MAX_BROADCAST_CELLS", bound)
        flags = grid.attach_cell_flags(df, cells).select("event_id", *grid.CELL_FLAGS).collect()
        got.append(sorted(map(str, flags)))
    assert got[0] == got[1]


def test_fusion_of_each_flag(spark):
    rows = [(n, bool(n & 1), bool(n & 2), None if n == 0 else bool(n & 4), 1.5, 0.4) for n in range(8)]
    df = spark.createDataFrame(
        rows, "n int, statistical_anomaly boolean, clustering_anomaly boolean, geographic_anomaly boolean, "
              "magnitude_zscore double, clustering_anomaly_score double")
    out = fusion.fuse(df)
    assert column(out, "is_anomaly") == [False] + [True] * 7
    assert column(out, "anomaly_types") == [
        "", "statistical", "clustering", "statistical,clustering", "geographic",
        "statistical,geographic", "clustering,geographic", "statistical,clustering,geographic"]
    assert column(out, "anomaly_score") == [0.5] * 4 + [1.0] * 4
    bare = df.withColumns({"magnitude_zscore": F.lit(None).cast("double"), "clustering_anomaly_score": F.lit(None).cast("double")})
    assert column(fusion.fuse(bare), "anomaly_score") == [0.0] * 4 + [1.0] * 4


def test_weather_pattern_rules(spark):
    rows = [("Flood", "Extreme", "A", f"wx{i:04}", 1.0, at("2024-01-01 00:00:00")) for i in range(5)]
    rows += [("Flood", "Severe", f"B{i}", f"wy{i:04}", 0.8, at("2024-01-01 00:00:00")) for i in range(4)]
    df = spark.createDataFrame(rows, "event_type string, severity string, area_desc string, alert_id string, "
                                     "combined_severity_score double, sent_time timestamp")
    flags = {r["area_desc"]: r for r in weather_patterns.flag_patterns(weather_patterns.pattern_profile(df)).collect()}
    assert flags["A"]["severe_weather_cluster"] and flags["A"]["weather_anomaly"]
    assert not flags["B0"]["weather_anomaly"]
    single = df.filter("area_desc = 'B0'")
    row = weather_patterns.flag_patterns(weather_patterns.pattern_profile(single)).first()
    assert row["frequency_zscore"] == 0.0 and math.isclose(row["alerts_per_hour"], 1.0)
