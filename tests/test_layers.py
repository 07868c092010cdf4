"""Tables of layers: what many batches leave behind, and how much of it a lookup reads."""

import random
import re

from pyspark.sql import functions as F, types as T

from hazardflow.sources import layers
from hazardflow.sources.layers import Layers, newest

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.IntegerType())])


def index(path, key=("id",)):
    return Layers(str(path), SCHEMA, list(key), newest(list(key)))


def test_many_batches_leave_few_files(spark, tmp_path, monkeypatch):
    """Ten keys a batch over a table of 20,000: one row for each key, bounded files, lookups of a few buckets."""
    monkeypatch.setattr(layers, "BUCKET_BYTES", 512)
    rnd = random.Random(3)
    table = index(tmp_path / "index")
    table.add(spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(0).alias("day")).coalesce(1))
    known = {f"k{i}": 0 for i in range(20_000)}
    for number in range(1, 71):
        rows = {f"k{rnd.randrange(20_100)}": number for _ in range(10)}
        known |= rows
        table.compact(spark)
        table.add(spark.createDataFrame(list(rows.items()), SCHEMA), number)
    used, old = table.entries(spark)
    base, recent = used[0], [e for e in used if not e.buckets]
    assert 256 <= base.buckets <= layers.MOST_BUCKETS and len(recent) <= layers.MOST_LAYERS + 1
    assert len([e for e in used + old if not e.buckets]) <= 3 * layers.MOST_LAYERS
    assert len(list((tmp_path / "index").rglob("*.parquet"))) <= 2 * base.buckets + 3 * layers.MOST_LAYERS
    assert {r.id: r.day for r in table.table(spark).collect()} == known
    asked = [f"k{n}" for n in range(0, 20_000, 2_000)]
    keys = spark.createDataFrame([(k,) for k in asked], "id string")
    found = table.lookup(keys)
    last = {}
    for r in found.collect():
        last[r.id] = max(r.day, last.get(r.id, 0))
    assert last == {k: known[k] for k in asked}
    filters = re.findall(r"PartitionFilters: \[([^\]]*)", found._jdf.queryExecution().executedPlan().toString())
    assert any("_bucket" in f for f in filters)
    wanted = [r[0] for r in keys.select(table._bucket(base.buckets)).collect()]
    read = spark.read.parquet(base.path).filter(F.col(layers.BUCKET).isin(wanted)).count() + spark.read.parquet(*[e.path for e in recent]).count()
    assert read < 0.05 * len(known)


def test_unfinished_and_replaced_entries_do_not_count(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "MOST_LAYERS", 2)
    table = index(tmp_path / "index")
    for number in range(4):
        table.add(spark.createDataFrame([("a", number), (f"b{number}", number)], SCHEMA), number)
    before = table.table(spark)
    table.compact(spark)
    used, old = table.entries(spark)
    assert len(used) == 1 and used[0].buckets and len(old) == 4
    assert sorted(before.collect()) == sorted(table.table(spark).collect())  # a reader from before can finish
    # a compaction that broke off: its folder has no _SUCCESS
    (tmp_path / "index" / "base-000000000009-4").mkdir()
    (tmp_path / "index" / "recent-000000000004-000000000009").mkdir()
    assert table.entries(spark)[0] == used and table.next_number(spark) == 4
    table.add(spark.createDataFrame([("a", 99)], SCHEMA), 2)  # is in the base already
    assert dict(map(tuple, table.table(spark).collect()))["a"] == 3
    for number in range(4, 8):
        table.add(spark.createDataFrame([("a", number)], SCHEMA), number)
    table.compact(spark)
    assert not [e for e in table.entries(spark)[1] if e in old]
    assert dict(map(tuple, table.table(spark).collect())) == {"a": 7, **{f"b{n}": n for n in range(4)}}


def test_empty(spark, tmp_path):
    table = index(tmp_path / "index")
    assert table.table(spark).collect() == [] and table.next_number(spark) == 0
    table.compact(spark)
    table.add(spark.createDataFrame([], SCHEMA))
    assert table.lookup(spark.createDataFrame([("a",)], "id string")).collect() == []
