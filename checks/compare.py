"""Run registered queries against their SQL twins.

    python -m checks.compare [table folder] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hazardflow")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def canonical(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(lines, key=repr)


def difference(result: DataFrame, connection, name: str) -> str | None:
    """None if rows, columns and values agree, else what differs."""
    ours = canonical(result.columns, result.collect())
    if name not in ORACLES:
        return None if ours else "no rows"
    cursor = connection.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    theirs = canonical(columns, cursor.fetchall())
    if sorted(result.columns) != sorted(columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        extra = [r for r in ours if r not in set(theirs)][:2]
        lost = [r for r in theirs if r not in set(ours)][:2]
        return f"rows {len(ours)} != {len(theirs)}: only here {extra}, only there {lost}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, connection, bad = session(), connect(sf_dir), 0
    for name in names:
        begin = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), connection, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        status, seconds = "ok  " if problem is None else "FAIL", time.time() - begin
        print(f"{status} {name} {kind} {seconds:.1f}s", problem or "", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
