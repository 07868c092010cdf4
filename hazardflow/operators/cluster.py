"""K-means distance outliers, scored with plain column expressions."""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazardflow import config
from hazardflow.functions.sql import literal
from hazardflow.functions.stats import computed_once, over, with_statistics
from hazardflow.workspace import cut_lineage, stored

# Distances to this many centres share one generated method; a longer one is
# past the size the JVM compiles.
CENTERS_PER_STEP = 4
# Parts of a standard deviation that points and centres are counted in while a model is fitted.
FIXED = 10_000
# A centre that moves no further than this, in the same parts, stands still.
STILL = 100

# Feature name -> SQL text over a silver event.
FEATURES = {
    "magnitude": "magnitude",
    "depth_km": "depth_km",
    "latitude": "latitude",
    "longitude": "longitude",
    "significance": "significance",
    "severity": "severity_score",
    "hour_of_day": "hour(event_time)",
    "day_of_week": "dayofweek(event_time)",
    "city_distance": "distance_to_major_city_km",
}


@dataclasses.dataclass(frozen=True)
class ClusterModel:
    """Standardisation (feature order) and cluster centres in scaled space."""

    means: list[float]
    stds: list[float]
    centers: list[list[float]]


def complete_features(df: DataFrame) -> DataFrame:
    """Id and features of the rows that have every feature."""
    columns = [f"CAST({text} AS DOUBLE) AS {name}" for name, text in FEATURES.items()]
    return df.selectExpr("event_id", *columns).dropna(subset=list(FEATURES))


def scale(value: str, mean, std) -> str:
    """(x - mean) / std as SQL text; a feature without spread becomes 0."""
    return f"CASE WHEN {std} > 0 THEN ({value} - {mean}) / {std} ELSE 0D END"


def scaled_features(df: DataFrame) -> DataFrame:
    """Standardised features, one column each, against the table's own moments."""
    features = complete_features(df)
    stats = {}
    for name in FEATURES:
        stats[f"{name}_mean"], stats[f"{name}_std"] = F.avg(name), F.stddev(name)
    wide = with_statistics(features, stats, features, "_moments")
    return wide.selectExpr(
        "event_id",
        *[
            f"{scale(name, f'_moments.{name}_mean', f'_moments.{name}_std')} AS {name}_scaled"
            for name in FEATURES
        ],
    )


def _fixed_point(name: str, mean: float, std: float) -> str:
    """Standardised value in whole ten-thousandths; 0 for a feature without spread."""
    return f"CAST(floor(({name} - {literal(mean)}) / {literal(std)} * {FIXED}D + 0.5D) AS BIGINT)" if std > 0 else "0L"


def _moments(features: DataFrame) -> tuple[int, list[float], list[float]]:
    """Rows, means and deviations from exact sums of millionths, the same in any order of the rows."""
    sums = [F.count("*").alias("rows")]
    for name in FEATURES:
        whole = F.floor(F.col(name) * 1_000_000 + 0.5).cast("decimal(19,0)")
        sums += [F.sum(whole).alias(f"{name}_sum"), F.sum(whole * whole).alias(f"{name}_square")]
    row = features.agg(*sums).first()
    n, means, stds = row["rows"], [], []
    for name in FEATURES if n else ():
        total, square = int(row[f"{name}_sum"]), int(row[f"{name}_square"])
        means.append(total / n / 1e6)
        stds.append(math.sqrt((n * square - total * total) / (n * (n - 1))) / 1e6 if n > 1 else 0.0)
    return n, means, stds


def fit_clusters(
    df: DataFrame,
    k: int = config.CLUSTERS,
    checkpoint: bool = True,
) -> ClusterModel | None:
    """Fit k-means on the standardised features; None with fewer rows than clusters.

    Nothing depends on the order or the partitions of the rows, so that any engine comes to the same
    centres: features are standardised to whole ten-thousandths, all sums are whole numbers, the first
    centres are the rows whose ids have the least md5, and of equally near centres the first counts. A
    cluster that loses all its rows keeps its centre. Rounds end when no centre has moved by more than a
    hundredth of a deviation, or with ``CLUSTER_MAX_ITER``. Each sums within its tasks first.

    Training reads its input once for each round, so the nine numbers go to a table in the shared folder; a
    lost executor re-reads files. ``checkpoint`` also keeps the features, for a ``df`` that is
    costly to compute twice; a stored table needs none.
    """
    features = complete_features(df)
    if checkpoint:
        features = cut_lineage(features)
    rows, means, stds = _moments(features)
    if rows < k:
        return None
    names = [f"p{i}" for i in range(len(FEATURES))]
    scaled = [f"{_fixed_point(name, mean, std)} AS {p}" for p, name, mean, std in zip(names, FEATURES, means, stds, strict=True)]
    points = stored(features.selectExpr("event_id", *scaled), "points")
    first = points.orderBy(F.md5(F.col("event_id").cast("binary")), "event_id").limit(k).collect()
    centers = [[row[name] for name in names] for row in first]
    for _ in range(config.CLUSTER_MAX_ITER):
        found = {row["cluster"]: row for row in _totals(points.select(*names), centers).collect()}
        moved = [
            [(2 * found[j][name] + found[j]["n"]) // (2 * found[j]["n"]) for name in names] if j in found else center
            for j, center in enumerate(centers)
        ]
        still = all(sum((a - b) ** 2 for a, b in zip(x, y)) <= STILL * STILL for x, y in zip(moved, centers))
        centers = moved
        if still:
            break
    return ClusterModel(means, stds, [[x / FIXED for x in center] for center in centers])


def _totals(points: DataFrame, centers: list[list[int]]) -> DataFrame:
    """Rows and sums of the points nearest to each centre, summed in each task first.

    A generated expression of all distances would be compiled anew for each round's centres, which takes
    longer than the round; whole numbers in Arrow batches give the same sums.
    """
    names = points.columns
    schema = ", ".join(["cluster int", "n bigint", *(f"{name} bigint" for name in names)])
    given = np.array(centers, np.int64)

    def nearest(batches):
        sums = np.zeros((len(given), 1 + given.shape[1]), np.int64)
        for batch in batches:
            rows = np.column_stack([column.to_numpy() for column in batch.columns])
            own = np.stack([((rows - center) ** 2).sum(axis=1) for center in given]).argmin(axis=0)
            for j in range(len(given)):
                chosen = rows[own == j]
                sums[j, 0] += len(chosen)
                sums[j, 1:] += chosen.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(given)), pa.int32()), *map(pa.array, sums.T)], names=["cluster", "n", *names])

    parts = points.mapInArrow(nearest, schema).filter("n > 0")
    return parts.groupBy("cluster").agg(*[F.sum(name).alias(name) for name in ("n", *names)])


def assign_clusters(df: DataFrame, model: ClusterModel | None) -> DataFrame:
    """Adds ``cluster`` and ``cluster_distance`` to the same rows.

    Both are NULL where a feature is missing or there is no model. Working on
    the rows themselves saves the join on the id, and plain arithmetic keeps
    the distance in generated code.
    """
    if model is None:
        return df.withColumns({
            "cluster": F.lit(None).cast("int"),
            "cluster_distance": F.lit(None).cast("double"),
        })
    point = {
        f"_point_{name}": F.expr(_scaled(text, mean, std))
        for (name, text), mean, std in zip(FEATURES.items(), model.means, model.stds, strict=True)
    }
    squares = {
        f"_square_{i}": F.expr(_squared_distance(list(point), center))
        for i, center in enumerate(model.centers)
    }
    measured = computed_once(df, point)
    names = list(squares)
    for start in range(0, len(names), CENTERS_PER_STEP):
        step = names[start : start + CENTERS_PER_STEP]
        measured = computed_once(measured, {name: squares[name] for name in step})
    every = f"array({', '.join(squares)})"
    return measured.withColumns({
        "cluster": F.expr(f"CAST(array_position({every}, array_min({every})) - 1 AS INT)"),
        "cluster_distance": F.expr(f"sqrt(array_min({every}))"),
    }).drop(*point, *squares)


def _scaled(text: str, mean: float, std: float) -> str:
    """Standardised value with known moments; NULL and NaN both give NULL."""
    value = f"nanvl(CAST({text} AS DOUBLE), NULL)"
    return f"({value} - {literal(mean)}) / {literal(std)}" if std > 0 else f"{value} * 0D"


def _squared_distance(point: list[str], center: list[float]) -> str:
    steps = [f"({name} - {literal(x)})" for name, x in zip(point, center, strict=True)]
    return " + ".join(f"{step} * {step}" for step in steps)


def flag_far_points(clustered: DataFrame) -> DataFrame:
    """Points further than mean + 2 std from their centre (1.5 mean if no spread)."""
    distance = F.col("cluster_distance")
    stats = {"mean": F.avg("cluster_distance"), "std": F.stddev("cluster_distance")}
    mean, std = F.col("_distances.mean"), F.col("_distances.std")
    limit = F.when(std > 0, mean + std * config.CLUSTER_STD_FACTOR).otherwise(
        mean * config.CLUSTER_FLAT_FACTOR
    )
    return (
        with_statistics(clustered, stats, clustered, "_distances")
        .withColumn("_limit", limit)
        .withColumns({
            "clustering_anomaly": over(distance, F.col("_limit")),
            "clustering_anomaly_score": F.when(F.col("_limit") > 0, distance / F.col("_limit"))
            .when(distance.isNotNull(), F.lit(0.0)),
        })
        .drop("_limit", "_distances")
    )


def cluster_anomalies(df: DataFrame, model: ClusterModel | None) -> DataFrame:
    """Cluster, distance, flag and score on every event.

    Without a model nothing is judged: all four are NULL.
    """
    if model is None:
        return assign_clusters(df, None).withColumns({
            "clustering_anomaly": F.lit(None).cast("boolean"),
            "clustering_anomaly_score": F.lit(None).cast("double"),
        })
    return flag_far_points(assign_clusters(df, model))


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size, mean magnitude and flagged events of each cluster; silver has one row per event."""
    return (
        clustered.filter(F.col("cluster").isNotNull())
        .groupBy("cluster")
        .agg(
            F.count("*").alias("count"),
            F.avg("magnitude").alias("avg_magnitude"),
            F.count_if("clustering_anomaly").alias("anomalies"),
        )
    )
