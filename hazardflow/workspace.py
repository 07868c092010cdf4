"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """All timestamps are UTC; every job starts from this session setting."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees: ``spark.checkpoint.dir``, or a folder in the warehouse where
    that is unset. Never a temporary folder of one machine."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages")
        return context.getCheckpointDir()
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back as a table.

    For jobs that read their input several times: each pass then scans only the
    columns it needs, and a lost executor re-reads files.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: iterative readers restart from files, not the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system and path object, for exists and delete on any store."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = filesystem(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = filesystem(spark, path)
    fs.delete(hadoop_path, True)
