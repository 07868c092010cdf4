"""Tables that small batches add to: a base, and recent layers on top of it that are compacted as they pile up.

Each batch writes one layer under its number. Folder names say what they hold: ``recent-<first>-<last>``
the batches from first to last, ``base-<last>-<buckets>`` all batches up to last, parted by a hash of the
key into a number of buckets that follows the table's size. Of folders that hold the same batches the widest
finished one counts, so a compaction appears at once, by its ``_SUCCESS`` file, and may be repeated after
a crash. What it replaced is deleted by the compaction after it, so that readers can finish.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hazardflow.workspace import delete_path, filesystem

#: Layers on top of the base, at most.
MOST_LAYERS = 16
#: The base is written anew once the layers hold this share of its bytes; before that only layers are merged.
#: A lookup reads all layers, so it reads about this share of the table and a few buckets.
BASE_SHARE = 0.03
#: Bytes of a bucket of the base, and the most buckets it gets.
BUCKET_BYTES, MOST_BUCKETS = 1 << 20, 4096
LAYER, BUCKET = "_layer", "_bucket"


@dataclasses.dataclass(frozen=True)
class Entry:
    path: str
    first: int
    last: int
    buckets: int  # 0 for a layer


@dataclasses.dataclass(frozen=True)
class Layers:
    """``merge`` reduces rows of any layers to what they amount to, the same whatever it reduced before; it
    keeps the column ``_layer``, the number of the batch a row came with."""

    root: str
    schema: T.StructType
    key: list[str]
    merge: Callable[[DataFrame], DataFrame]

    def entries(self, spark: SparkSession) -> tuple[list[Entry], list[Entry]]:
        """(entries that make up the table, the base first; entries that they replace)."""
        fs, root = filesystem(spark, self.root)
        found = []
        for status in fs.listStatus(root) if fs.exists(root) else ():
            name = status.getPath().getName()
            match = re.fullmatch(r"(?:recent-(\d+)-(\d+)|base-(\d+)-(\d+))", name)
            path = f"{self.root}/{name}"
            if match and fs.exists(filesystem(spark, f"{path}/_SUCCESS")[1]):
                first, last, base, buckets = match.groups()
                found.append(Entry(path, 0, int(base), int(buckets)) if base else Entry(path, int(first), int(last), 0))
        used, old, covered = [], [], -1
        for entry in sorted(found, key=lambda e: (e.first, -e.last, not e.buckets)):
            (used if entry.last > covered else old).append(entry)
            covered = max(covered, entry.last)
        return used, old

    def next_number(self, spark: SparkSession) -> int:
        used, _ = self.entries(spark)
        return used[-1].last + 1 if used else 0

    def add(self, rows: DataFrame, number: int | None = None) -> None:
        """Adds a batch's rows. A batch whose number is there already is not added again."""
        spark = rows.sparkSession
        used, _ = self.entries(spark)
        if number is None:
            number = used[-1].last + 1 if used else 0
        if any(e.first <= number <= e.last for e in used):
            return
        rows = rows.select(*self.schema.names, F.lit(number).cast("bigint").alias(LAYER))
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{self.root}/recent-{number:012d}-{number:012d}")

    def _read(self, spark: SparkSession, entries: list[Entry]) -> DataFrame:
        kept = T.StructType([*self.schema.fields, T.StructField(LAYER, T.LongType())])
        recent = [e.path for e in entries if not e.buckets]
        rows = spark.read.schema(kept).parquet(*recent) if recent else spark.createDataFrame([], kept)
        for base in (e for e in entries if e.buckets):
            parted = T.StructType([*kept.fields, T.StructField(BUCKET, T.IntegerType())])
            whole = spark.read.schema(parted).parquet(base.path).select(*kept.names)
            rows = whole.unionByName(rows) if recent else whole
        return rows

    def table(self, spark: SparkSession) -> DataFrame:
        """The table's rows, each key's once."""
        return self.merge(self._read(spark, self.entries(spark)[0])).select(*self.schema.names)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys in all layers, not merged. Of the base only the buckets of the keys are read:
        their numbers, ``MOST_BUCKETS`` at most, become a partition filter."""
        spark = keys.sparkSession
        used, _ = self.entries(spark)
        found = self._read(spark, [e for e in used if not e.buckets])
        for base in (e for e in used if e.buckets):
            schema = T.StructType([*self.schema.fields, T.StructField(LAYER, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
            wanted = [r[0] for r in keys.select(self._bucket(base.buckets)).distinct().collect()]
            found = spark.read.schema(schema).parquet(base.path).filter(F.col(BUCKET).isin(wanted)).drop(BUCKET).unionByName(found)
        return found.join(keys.select(*self.key).distinct(), self.key, "left_semi").select(*self.schema.names)

    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int").alias(BUCKET)

    def compact(self, spark: SparkSession) -> None:
        """Merges the layers where they are too many: among themselves, or into the base once that is worth it."""
        used, old = self.entries(spark)
        recent = [e for e in used if not e.buckets]
        if len(recent) <= MOST_LAYERS:
            return
        size = lambda entries: sum(_bytes(spark, e.path) for e in entries)
        last, total = recent[-1].last, size(used)
        if total == 0 or size(recent) >= BASE_SHARE * (total - size(recent)):
            buckets = 1
            while buckets < MOST_BUCKETS and buckets * BUCKET_BYTES < total:
                buckets *= 2
            merged = self.merge(self._read(spark, used)).select(*self.schema.names, LAYER, self._bucket(buckets))
            writer = merged.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
            writer.parquet(f"{self.root}/base-{last:012d}-{buckets}")
        else:
            merged = self.merge(self._read(spark, recent)).select(*self.schema.names, LAYER)
            merged.hint("rebalance").write.mode("overwrite").parquet(f"{self.root}/recent-{recent[0].first:012d}-{last:012d}")
        for entry in old:
            delete_path(spark, entry.path)


def _bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = filesystem(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def newest(key: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge rule: each key's row from its newest batch; of several in one batch the greatest."""

    def merge(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in key]
        ordered = [LAYER, *(c for c in values if c != LAYER)]
        best = rows.groupBy(*key).agg(F.max(F.struct(*ordered)).alias("_best"))
        return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in values])

    return merge
