"""Tables in the folder all executors share, and batches of rows for Arrow functions."""

from __future__ import annotations

import ctypes
import os
import pathlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

#: Text of one numpy pass. Working arrays are a few dozen times as large.
CHUNK_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder in the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    return (found or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages").rstrip("/")


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write the rows to the shared folder and read them back.

    Cuts the lineage: later jobs, also after a lost executor, start from the files.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package if their path does not have it: Spark sends a zip of its code."""
    package = pathlib.Path(__file__).resolve().parent.parent
    root, context = str(package.parent), spark.sparkContext
    on_path = root in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] or "site-packages" in root
    if on_path or getattr(context, "_hazardflow_shipped", False):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", root, package.name)
    context.addPyFile(archive)
    context._hazardflow_shipped = True


def released(function: Callable) -> Callable:
    """``function`` on a partition's batches; at its end the worker, which Spark keeps for later tasks and other
    stages, gives the memory it no longer needs back to the system."""

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
        if trim is not None:
            trim(0)

    return run


def map_arrow(df: DataFrame, function: Callable, schema: pa.Schema) -> DataFrame:
    """``function`` takes the iterator of record batches of a partition and yields lists of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            arrays = [
                column if isinstance(column, (pa.Array, pa.ChunkedArray)) else pa.array(column, field.type)
                for column, field in zip(columns, schema)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    ship_package(df.sparkSession)
    return df.mapInArrow(released(run), from_arrow_schema(schema))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        if not len(lengths):
            continue
        part = np.cumsum(lengths.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lengths)]
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the offsets of the rows; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def least_rows(df: DataFrame, most: int, *order) -> DataFrame:
    """The first ``most`` rows by ``order``: each task passes on that many, and one task, not the driver, keeps them."""
    return df.sort(*order).limit(most).coalesce(1)


def unused(name: str, columns: list[str]) -> str:
    """``name``, or that after underscores, so that no column has it."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc_fold(column, folds: int):
    """crc32 of the id as text, modulo ``folds``; 0 for a null id."""
    return F.coalesce(F.crc32(column.cast("string")) % folds, F.lit(0))
