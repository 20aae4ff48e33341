"""Tables written once to the shared folder, and what a folder holds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir (a temporary one only where that is unset)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet to a new shared folder and read back."""
    path = shared_folder(df.sparkSession, "table")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of stored tables that nothing reads any more; other tables are left alone."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            remove(df.sparkSession, path)


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder; whether there was one."""
    fs, where = _at(spark, path)
    return fs.exists(where) and fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file of exactly this name, replaced if there."""
    fs, where = _at(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
