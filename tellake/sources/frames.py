"""Reading and writing frame tables, side tables and file listings with Spark's own sources."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators.storage import entries, stored


def file_stem(path: str = "_metadata.file_name"):
    return F.regexp_replace(F.col(path), r"\.[^.]*$", "")


def scan_directory(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below path, with replay_id = file stem."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option("mergeSchema", True).parquet(path)
    return df.withColumn("replay_id", file_stem())


def list_files(spark: SparkSession, path: str, glob: str = "*.replay") -> DataFrame:
    """Rows (path, stem, length) of files below path; contents are not read, and a missing folder has no files."""
    try:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    except AnalysisException:
        return spark.createDataFrame([], "path string, stem string, length long")
    return df.select("path", F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1).alias("stem"), "length")


def file_sizes(wanted: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """wanted with size; 0 where the file is absent."""
    return wanted.join(listing.select(F.col("stem").alias(key), F.col("length").alias("size")), key, "left").fillna(0, ["size"])


#: values of decoded files that a task gathers before it hands them on; one file is never parted
HELD_VALUES = 1 << 18
KINDS = (pa.string(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.int64())
DECODED = "path string, ok boolean, error string, metadata string, num_frames long, num_features long, frame long, values array<double>"


def decode(files: DataFrame, decoder: Callable[[bytes], tuple[dict | None, object]]) -> DataFrame:
    """Files (path, content) through a caller's decoder, each once: a summary row a file, then its frames, as DECODED.

    decoder(content) gives (metadata, array).  A summary row has frame NULL, metadata as JSON and the counts of
    frames and features.  Failures are summary rows with ok false, never exceptions: a NULL content is a missing
    file (counts -1), an exception of the decoder (-1), no array (0), an array that is not two-dimensional,
    rows of different lengths, or no frames or features (counts as far as they are known).
    """

    def checked(array) -> tuple[str | None, int, int, object]:
        """(error, frames, features, the array or its rows)"""
        if array is None:
            return "Parsing returned None", 0, 0, None
        shape = getattr(array, "shape", None)
        if shape is None:
            array = list(array)
            widths = set(map(len, array)) if set(map(type, array)) <= {list, tuple} else None
            if widths is None or not set(map(type, chain.from_iterable(array))) <= {float, int}:
                deep = [hasattr(r, "__len__") and not isinstance(r, (str, bytes)) for r in array]
                if not all(deep) or any(hasattr(v, "__len__") for r in array for v in r):
                    return f"Expected 2D array, got {3 if deep and all(deep) else 1}D", len(array), 0, None
                widths = {len(r) for r in array}
            if len(widths) > 1:
                return "Rows of different lengths", len(array), 0, None
            shape = (len(array), min(widths, default=0))
        if len(shape) != 2:
            return f"Expected 2D array, got {len(shape)}D", shape[0] if shape else 0, 0, None
        return ("Array has zero frames or features" if 0 in shape else None), shape[0], shape[1], array

    def one(path: str, content: bytes | None) -> tuple[list, object]:
        if content is None:
            return [path, False, f"File not found: {path}", None, -1, -1], None
        try:
            metadata, array = decoder(content)
            error, n, width, array = checked(array)
            told = None if metadata is None else json.dumps(metadata)
        except Exception as e:  # the decoder is the caller's; its errors are data here
            return [path, False, f"Parsing failed: {e}", None, -1, -1], None
        return [path, error is None, error, told, n, width], array if error is None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: list[list] = []
        sizes: list[int] = []
        flat: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            """The held files: of each its summary, then its frames."""
            n = np.array(sizes)
            first = np.r_[0, np.cumsum(n[:-1] + 1)]
            of = np.repeat(np.arange(len(n)), n + 1)
            place = np.arange(len(of)) - first[of] - 1
            frame = place >= 0
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*files), KINDS)]
            of_file, summary = pa.array(of), pa.array(of, mask=frame)
            lengths = np.where(frame, np.array([f[5] for f in files])[of], 0)
            values = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32), mask=np.r_[~frame, False]), pa.array(np.concatenate(flat)))
            out = [columns[0].take(of_file), columns[1].take(of_file), *(c.take(summary) for c in columns[2:]), pa.array(place, mask=~frame), values]
            return pa.record_batch(out, names=[c.split()[0] for c in DECODED.split(", ")])

        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                summary, array = one(path.as_py(), content.as_py())
                files.append(summary)
                if array is None:
                    sizes.append(0)
                else:
                    numeric = getattr(getattr(array, "dtype", None), "kind", "O") in "iufb"
                    flat.append(np.asarray(array, np.float64).ravel() if numeric else np.fromiter(map(float, chain.from_iterable(array)), np.float64))
                    sizes.append(summary[4])
                held += 1 + (0 if array is None else summary[4] * summary[5])
                if held >= HELD_VALUES:
                    flat.append(np.zeros(0))
                    yield flush()
                    files, sizes, flat, held = [], [], [], 0
        if files:
            flat.append(np.zeros(0))
            yield flush()

    return files.select("path", "content").mapInArrow(run, DECODED)


def ingest(spark: SparkSession, wanted: DataFrame, root: str, decoder: Callable[[bytes], tuple[dict | None, object]], key: str = "replay_id", stored_at: str = "storage_key") -> tuple[DataFrame, DataFrame]:
    """(frames, outcomes) of raw files below root: each file is read and decoded once, and both come from one stored table.

    frames: rows (key, frame, values); outcomes: rows (key, path, ok, error, metadata, num_frames, num_features), one
    a row of wanted, files that are not found included.  Files are found by the rules for raw files.
    """
    listing = list_files(spark, root)
    located = paths.locate_raw(wanted.filter(F.col(key).isNotNull()), listing, key, stored_at, plain_root(root))
    try:
        binary = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.replay").load(root).select(paths.plain(F.col("path")).alias("path"), "content")
    except AnalysisException:
        binary = spark.createDataFrame([], "path string, content binary")
    asked = located.select(F.col(key).alias("__key"), "path")
    both = stored(decode(binary.join(asked.select("path").filter("path is not null").distinct(), "path", "left_semi"), decoder))
    told = asked.join(both.filter("frame is null"), "path", "left")
    lost = F.col("ok").isNull()
    outcomes = told.select(
        F.col("__key").alias(key), "path", (~lost & F.coalesce("ok", F.lit(False))).alias("ok"), F.when(lost, F.concat(F.lit("File not found: "), F.col("__key").cast("string"))).otherwise(F.col("error")).alias("error"),
        "metadata", F.coalesce("num_frames", F.lit(-1)).alias("num_frames"), F.coalesce("num_features", F.lit(-1)).alias("num_features"))
    frames = both.filter("frame is not null").select("path", "frame", "values").join(asked, "path")
    return frames.select(F.col("__key").alias(key), "frame", "values"), outcomes


def plain_root(root: str) -> str:
    """root spelt as plain() spells paths."""
    return "/" + root.split(":", 1)[1].lstrip("/") if root.startswith("file:") else root


def write_frames(frames: DataFrame, path: str, files: int, key: str = "replay_id", index: str = "frame") -> None:
    """Clustered by key and sorted, so that a reader of one series skips other files and row groups."""
    frames.repartition(files, key).sortWithinPartitions(key, index).write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_sidecar(metadata: DataFrame, path: str, key: str = "replay_id") -> None:
    """One indented JSON record a series, each a file below path/key=<value>; a rerun replaces all.

    Rows of a key share a file, one record after the other; NULL fields are left out.
    """
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in metadata.columns]), {"pretty": "true"})
    metadata.select(F.col(f"`{key}`").alias(key), record.alias("value")).repartition(key).write.mode("overwrite").partitionBy(key).text(path)


def read_sidecar(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON side files below path, one record a file, indented or not; broken records are dropped."""
    return spark.read.schema(schema).options(multiLine=True, recursiveFileLookup=True).json(path).dropna("all")


def write_snapshot(table: DataFrame, path: str, stamp: str) -> None:
    """A dated copy; earlier copies stay."""
    table.withColumn("ts", F.lit(stamp)).write.mode("append").partitionBy("ts").parquet(path)


def snapshot_stamps(spark: SparkSession, path: str) -> list[str]:
    """Stamps of the copies below path, oldest first; from the folder's names alone."""
    return sorted(name[3:] for name in entries(spark, path) if name.startswith("ts="))


def read_latest_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The copy whose stamp comes last, without reading the others; None where there is no copy."""
    stamps = snapshot_stamps(spark, path)
    return spark.read.parquet(f"{path}/ts={stamps[-1]}") if stamps else None
