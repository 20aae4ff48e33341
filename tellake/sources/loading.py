"""Loading catalogued series although some of their files are missing or broken."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import ledger, sampling
from ..operators.storage import stored
from .frames import list_files, plain_root


def scan_files(spark: SparkSession, root: str, schema: str, glob: str = "*.parquet") -> DataFrame:
    """Rows of all files below root with their path; what cannot be read of a file is passed over, no folder gives no rows.

    The schema is told, so no file is opened for it.  Columns that a file lacks are NULL.
    """
    reader = spark.read.schema(schema).options(recursiveFileLookup=True, pathGlobFilter=glob, ignoreCorruptFiles=True, ignoreMissingFiles=True)
    try:
        df = reader.parquet(root)
    except AnalysisException:
        return spark.createDataFrame([], schema).withColumn("path", F.lit(None).cast("string"))
    return df.select("*", paths.plain(F.col("_metadata.file_path")).alias("path"))


def read_report(located: DataFrame, key: str, root: str, schema: str, required: str, verify: bool = True) -> DataFrame:
    """located (key, path) with rows, bytes and error (NULL for a series that can be read whole); stored.

    Three looks at the files: the listing says which are there, footers alone say how many rows each
    promises, and one scan of the schema's columns says how many it delivers.  Without verify that scan is of the
    required column alone: pages of others that are damaged are then not found.
    """
    spark = located.sparkSession
    listing = list_files(spark, root, "*.parquet").select(paths.plain(F.col("path")).alias("path"), F.col("length").alias("bytes"))
    promised = scan_files(spark, root, schema).groupBy("path").agg(F.count("*").alias("promised"))
    data = scan_files(spark, root, schema)
    touched = sum((F.count(F.col(f"`{c}`")) for c in data.columns if c != "path" and (verify or c == required)), F.lit(0))  # decodes every column
    delivered = data.groupBy("path").agg(F.count("*").alias("rows"), F.count(F.col(f"`{required}`")).alias("filled"), touched.alias("touched"))
    out = located.join(listing, "path", "left").join(promised, "path", "left").join(delivered, "path", "left")
    got = F.when(F.col("touched") >= 0, F.col("rows")).otherwise(0)  # touched keeps its columns in the scan
    error = (
        F.when(F.col("bytes").isNull(), "file not found")
        .when(F.col("promised").isNull(), "unreadable, or without rows")
        .when(got < F.col("promised"), F.concat(F.lit("damaged: "), got, F.lit(" of "), F.col("promised"), F.lit(" rows can be read")))
        .when(F.col("filled") == 0, F.lit(f"no values of {required}"))
    )
    return stored(out.select(key, "path", F.when(error.isNull(), got).alias("rows"), "bytes", error.alias("error")))


@dataclass
class Loaded:
    """frames: rows of the whole series with their key; report: a row (key, path, rows, bytes, error) for every series asked for."""

    frames: DataFrame
    report: DataFrame
    key: str

    @property
    def errors(self) -> DataFrame:
        """Rows (key, path, error) of the series that could not be loaded."""
        return self.report.filter("error is not null").select(self.key, "path", "error")

    def __iter__(self) -> Iterator[tuple]:
        """(key, frames) of each loaded series by order of key; keys come a partition at a time, frames are read when used."""
        for row in self.report.filter("error is null").select(self.key).orderBy(self.key).toLocalIterator():
            yield row[0], self.frames.filter(F.col(self.key) == F.lit(row[0]))

    def batches(self, size: int = 100) -> Iterator[DataFrame]:
        """Frames of consecutive groups of `size` loaded series by key; the last may be short."""
        placed = ledger.batch_ids(self.report.filter("error is null").select(self.key), self.key, size)
        last = placed.agg(F.max("batch_id")).first()[0]
        for k in range(0 if last is None else last + 1):
            yield self.frames.join(placed.filter(F.col("batch_id") == k).select(self.key), self.key, "left_semi")


def load_series(spark: SparkSession, catalogue: DataFrame, root: str, schema: str, key: str = "replay_id", output: str = "output_path", required: str = "frame", cache_dir: str | None = None, verify: bool = True) -> Loaded:
    """All series of a catalogue whose files are below root: good ones as frames, the others as errors.

    Paths are found by the loading rules (paths.locate_parsed with data_dir = root).  A series is loaded whole or not at
    all: a file that breaks off is an error, and none of its rows are returned.  A key that schema has too
    is replaced by the catalogue's.  Repeated keys are taken once; a NULL key gives no row.  verify reads the
    schema's columns once more than the frames are read; without it only the required column.
    """
    listing = list_files(spark, root, "*.parquet")
    wanted = catalogue.filter(F.col(key).isNotNull())
    located = paths.locate_parsed(wanted, listing, key, output, plain_root(root), cache_dir).select(key, "path")
    report = read_report(located, key, root, schema, required, verify)
    good = report.filter("error is null").select(F.col(key).alias("__key"), "path")
    data = scan_files(spark, root, schema)
    frames = data.join(good, "path").withColumn(key, F.col("__key")).drop("__key", "path")
    return Loaded(frames, report, key)


def load_one(spark: SparkSession, catalogue: DataFrame, value, root: str, schema: str, key: str = "replay_id", output: str = "output_path", required: str = "frame") -> DataFrame | None:
    """Frames of one series; None if it is not in the catalogue or its file is missing or cannot be read whole."""
    got = load_series(spark, ledger.lookup(catalogue, key, value), root, schema, key, output, required)
    return None if got.report.filter("error is null").isEmpty() else got.frames


def load_sample(spark: SparkSession, catalogue: DataFrame, root: str, schema: str, n: int = 50, seed: int = 42, key: str = "replay_id", output: str = "output_path", required: str = "frame") -> Loaded:
    """A seeded sample of n series (all, if fewer); those that cannot be loaded are errors, not replaced by others."""
    ids = sampling.sample_ids(catalogue.select(key).distinct(), key, n, seed)
    return load_series(spark, ledger.keep_ids(catalogue, ids, key), root, schema, key, output, required)


def read_sidecars(spark: SparkSession, root: str, extension: str = paths.SIDECAR) -> DataFrame:
    """Rows (stem, text) of the JSON side files below root, indented or not; no folder gives no rows."""
    try:
        df = spark.read.options(recursiveFileLookup=True, pathGlobFilter=f"*{extension}").text(root, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "stem string, text string")
    name = F.col("_metadata.file_name")
    return df.select(F.substr(name, F.lit(1), F.length(name) - len(extension)).alias("stem"), F.col("value").alias("text"))


def json_map(text: Column) -> Column:
    """Top-level keys of a JSON object with their values as text; anything else is an empty map."""
    return F.coalesce(F.from_json(text, "map<string,string>"), F.create_map().cast("map<string,string>"))


def overlaid(below: Column, above: Column) -> Column:
    """Both maps as one; of equal keys the entry above wins, NULL values included."""
    return F.map_concat(F.map_filter(below, lambda k, _: ~F.array_contains(F.map_keys(above), k)), above)


def series_metadata(catalogue: DataFrame, columns: list[str], key: str = "replay_id", stored_json: str = "metadata", sidecars: DataFrame | None = None) -> DataFrame:
    """Rows (key, metadata map): catalogue columns, overlaid by the stored JSON, overlaid by the side file (stem = key).

    Text that is no JSON object counts as none.  Values are text, nested ones JSON.
    """
    base = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(f"`{c}`").cast("string") for c in columns]))
    out = catalogue.select(key, overlaid(base, json_map(F.col(stored_json))).alias("metadata"))
    if sidecars is None:
        return out
    side = sidecars.select(F.col("stem").alias("__stem"), json_map(F.col("text")).alias("__side"))
    joined = out.join(side, F.col(key).cast("string") == F.col("__stem"), "left")
    return joined.select(key, F.when(F.col("__side").isNull(), F.col("metadata")).otherwise(overlaid(F.col("metadata"), F.col("__side"))).alias("metadata"))
