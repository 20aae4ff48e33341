"""Tables that cut lineage: written once to the folder the cluster shares, read back by later jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; a temporary one of this process only where that is unset (local tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    key = spark.sparkContext.applicationId
    if key not in _own:
        _own[key] = "file://" + tempfile.mkdtemp(prefix="spark-")
    return _own[key]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet under the shared folder and return a DataFrame that reads it.

    Survives lost executors (the files are outside them) and fixes row identities
    that a recomputation could otherwise change.  The shuffle files of the write are
    removed when it ends, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def quoted(name: str) -> str:
    """A column's name for F.col, whatever its characters."""
    return "`" + name.replace("`", "``") + "`"


def all_columns(df: DataFrame) -> list[Column]:
    return [F.col(quoted(c)) for c in df.columns]


def with_row_keys(df: DataFrame) -> tuple[DataFrame, str]:
    """(rows, key): df with one more column, of a name that df does not have, that names each row; written, so that later jobs see the same names."""
    key = "__row"
    while key in map(str.lower, df.columns):
        key += "_"
    return materialize(df.select("*", F.monotonically_increasing_id().alias(key)), "rows"), key


def drop(*tables: DataFrame) -> None:
    """Delete the files of materialised tables that nothing reads any more; others are left alone."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def broadcast_if_small(df: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """df (materialised) with a broadcast hint if its rows take at most most_bytes; else unchanged, to be shuffled.

    A row counts as 16 bytes and the sizes of its columns (strings and arrays: 64 bytes are assumed).
    """
    width = 16 + sum(_WIDTHS.get(t, 64) for _, t in df.dtypes)
    return F.broadcast(df) if df.count() * width <= most_bytes else df


_WIDTHS = {"bigint": 8, "int": 4, "double": 8, "float": 4, "boolean": 1, "tinyint": 1, "smallint": 2}
