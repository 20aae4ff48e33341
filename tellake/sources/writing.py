"""Writing series and training windows, and the inventory of what was written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import paths
from ..operators import segments
from ..operators.ledger import with_place
from .frames import list_files
from .loading import scan_files


def write_series(frames: DataFrame, path: str, key: str = "replay_id", index: str = "frame", per_series: bool = False) -> None:
    """Frames as Parquet below path, sorted within series; a rerun replaces what an earlier run left, whole or in part.

    Series are clustered, several a file, so files do not grow in number with them; a reader of one skips the
    other files and row groups.  per_series gives every series a file of its own below series=<key>.
    """
    ordered = frames.repartition(key).sortWithinPartitions(key, index)
    if per_series:
        ordered.withColumn("series", F.col(key)).write.mode("overwrite").partitionBy("series").parquet(path)
    else:
        ordered.write.mode("overwrite").parquet(path)


def inventory(spark: SparkSession, path: str, key: str = "replay_id", kind: str = "string") -> DataFrame:
    """Rows (key, output_path, rows, bytes) of what is below path: the file of each series, its rows, and its share of the file's bytes by rows.

    Only the key column and the listing are read.  A file of one series is that series' whole; the shares of a
    file add up to its size.  A series in several files has the sum of its shares and the first path.
    """
    held = scan_files(spark, path, f"`{key}` {kind}").groupBy(key, "path").agg(F.count("*").alias("rows"))
    sizes = list_files(spark, path, "*.parquet").select(paths.plain(F.col("path")).alias("path"), "length")
    whole = held.groupBy("path").agg(F.sum("rows").alias("whole"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("path").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = held.withColumn("before", before).join(whole, "path").join(sizes, "path")

    def cut(n):
        return F.floor(F.col("length") * n / F.col("whole"))

    share = each.select(key, "path", "rows", (cut(F.col("before") + F.col("rows")) - cut(F.col("before"))).alias("bytes"))
    return share.groupBy(key).agg(F.min("path").alias("output_path"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))


def ledger_rows(written: DataFrame, features: int, fps: float | None = None, fmt: str = "parquet") -> DataFrame:
    """An inventory as success rows of the parsed ledger (key, output_path, output_format, fps, frame_count, feature_count, file_size_bytes)."""
    return written.withColumnsRenamed({"rows": "frame_count", "bytes": "file_size_bytes"}).withColumns({"output_format": F.lit(fmt), "fps": F.lit(fps).cast("double"), "feature_count": F.lit(features).cast("long")})


def shuffled_windows(frames: DataFrame, cuts: DataFrame, series: str, chain: Callable[[DataFrame], DataFrame], features: list[str], size: int = 128, stride: int = 64, seed: int = 42, rows_per_file: int = 4096, index: str = "frame") -> DataFrame:
    """Rows (place, shard, series, w_start, matrix): every window once, in seeded order, dealt to shards of even size.

    chain is applied to the whole series first (it must keep series and index); matrix holds the features as
    float32 rows in frame order.  The order is that of md5(seed|series|w_start); shards are as many as
    rows_per_file asks for and differ by one row at most.  No task orders all windows.
    """
    ready = chain(frames)
    inside = segments.window_frames(ready, cuts, series, size, stride, index)
    windows = segments.window_matrix(inside, series, features)
    name = F.concat_ws("|", F.lit(str(seed)), F.col(series).cast("string"), F.col("w_start").cast("string"))
    placed = with_place(windows.withColumn("__order", F.concat(F.md5(name), F.lit("|"), name)), "__order").drop("__order")
    total = placed.count()
    shards = max(1, -(-total // rows_per_file))
    return placed.select("place", F.floor(F.col("place") * shards / max(1, total)).cast("long").alias("shard"), series, "w_start", "matrix")


def save_shards(windows: DataFrame, path: str) -> None:
    """Write shuffled_windows, one file a shard, rows in order; a rerun replaces all.

    Tasks are as many as shuffle partitions, each writes its shards one after the other: what tasks report to
    the driver does not grow with the shards.
    """
    tasks = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    windows.withColumn("part", F.col("shard")).repartition(tasks, "part").sortWithinPartitions("part", "place").write.mode("overwrite").partitionBy("part").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of the shards below path with their file's path and bytes.  The folders are listed once, however often the rows are read."""
    df = spark.read.schema(schema).options(recursiveFileLookup=True, pathGlobFilter="*.parquet").parquet(path)
    return df.select("*", paths.plain(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("bytes"))


def manifest_of(rows: DataFrame) -> DataFrame:
    """The manifest (shard, path, rows, first_place, last_place, bytes) of read_shards: it states what is there."""
    held = rows.groupBy("shard", "path").agg(F.count("*").alias("rows"), F.min("place").alias("first_place"), F.max("place").alias("last_place"), F.max("bytes").alias("bytes"))
    return held.select("shard", "path", "rows", "first_place", "last_place", "bytes")


def write_shards(windows: DataFrame, path: str) -> DataFrame:
    """save_shards, and the manifest, read back from the files."""
    save_shards(windows, path)
    return manifest_of(read_shards(windows.sparkSession, path, "shard long, place long"))
