"""Reset frames, continuous segments and fixed windows over frames of many series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ledger import limited


def frame_index(df: DataFrame, series: str, *order: str) -> DataFrame:
    """df with frame = 0-based place in its series by the order columns."""
    return df.withColumn("frame", (F.row_number().over(Window.partitionBy(series).orderBy(*order)) - 1).cast("long"))


def is_reset(x: str, y: str, vx: str, vy: str) -> Column:
    """All four exactly zero (-0.0 too); NULL or NaN anywhere: not a reset frame."""
    zero = [F.col(f"`{c}`") == 0.0 for c in (x, y, vx, vy)]
    return F.coalesce(zero[0] & zero[1] & zero[2] & zero[3], F.lit(False))


def contiguous_runs(df: DataFrame, series: str, index: str = "frame") -> DataFrame:
    """Rows (series, run_start, run_end): maximal runs of consecutive index values, both ends inclusive."""
    place = F.row_number().over(Window.partitionBy(series).orderBy(index))
    runs = df.select(series, index).withColumn("island", F.col(index) - place)
    return runs.groupBy(series, "island").agg(F.min(index).alias("run_start"), F.max(index).alias("run_end")).drop("island")


def segment_boundaries(df: DataFrame, series: str, reset: Column, min_frames: int = 10, index: str = "frame") -> DataFrame:
    """Rows (series, seg_start, seg_end): runs of non-reset frames, end exclusive, at least min_frames (>= 1) long.

    Frames of a series are 0..n-1.  One shuffle by series serves window and aggregate.
    """
    if min_frames < 1:
        raise ValueError("min_frames must be at least 1")
    runs = contiguous_runs(df.filter(~reset), series, index)
    out = runs.select(series, F.col("run_start").alias("seg_start"), (F.col("run_end") + 1).alias("seg_end"))
    return out.filter(F.col("seg_end") - F.col("seg_start") >= min_frames)


def boundaries_json(segments: DataFrame, series: str) -> DataFrame:
    """Rows (series, boundaries): JSON text [[start,end],...] in order."""
    pairs = F.sort_array(F.collect_list(F.array("seg_start", "seg_end")))
    return segments.groupBy(series).agg(F.to_json(pairs).alias("boundaries"))


def parse_boundaries(df: DataFrame, column: str = "boundaries") -> DataFrame:
    """Back to rows with seg_start and seg_end; NULL, broken or empty lists give no row."""
    pairs = F.from_json(column, "array<array<bigint>>")
    return df.withColumn("pair", F.explode(pairs)).withColumns({"seg_start": F.col("pair")[0], "seg_end": F.col("pair")[1]}).drop("pair", column)


def _check(size: int, stride: int) -> None:
    if size < 1 or stride < 1:
        raise ValueError("window size and stride must be at least 1")


def window_index(segments: DataFrame, size: int | None = 128, stride: int = 64) -> DataFrame:
    """Segments with w_start and w_end for every window inside; size None: the segments themselves.

    Starts are seg_start + k * stride while the window fits; a shorter rest is dropped.
    """
    if size is None:
        return segments.withColumns({"w_start": F.col("seg_start"), "w_end": F.col("seg_end")})
    _check(size, stride)
    fits = segments.filter(F.col("seg_end") - F.col("seg_start") >= size)
    last = F.floor((F.col("seg_end") - F.col("seg_start") - size) / stride)
    out = fits.withColumn("w_start", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), last), lambda k: F.col("seg_start") + k * stride)))
    return out.withColumn("w_end", F.col("w_start") + size)


def window_frames(frames: DataFrame, segments: DataFrame, series: str, size: int, stride: int, index: str = "frame") -> DataFrame:
    """Frames with (w_start, pos) for each window that holds them; also right for stride > size.

    No interval join: segments that hold a window are cut by blocks of `size` frames, and frames meet them by series and
    block.  Such segments are at least a block long and apart, so two at most touch a block and a frame
    meets two at most, however many segments its series has.  The numbers of its windows follow from arithmetic.
    """
    _check(size, stride)
    long = segments.filter(F.col("seg_end") - F.col("seg_start") >= size).select(F.col(series).alias("__s"), "seg_start", "seg_end")
    first, last = F.floor(F.col("seg_start") / size), F.floor((F.col("seg_end") - 1) / size)
    blocks = long.withColumn("__block", F.explode(F.sequence(first, last)))
    own = frames.withColumn("__at", F.floor(F.col(index) / size)).join(blocks, (F.col(series) == F.col("__s")) & (F.col("__at") == F.col("__block"))).drop("__s", "__at", "__block")
    own = own.filter((F.col(index) >= F.col("seg_start")) & (F.col(index) < F.col("seg_end")))
    off = F.col(index) - F.col("seg_start")
    low = F.greatest(F.lit(0).cast("long"), F.ceil((off - size + 1) / stride))
    high = F.least(F.floor((F.col("seg_end") - F.col("seg_start") - size) / stride), F.floor(off / stride))
    out = own.withColumns({"__lo": low, "__hi": high}).filter("__lo <= __hi").withColumn("__k", F.explode(F.sequence("__lo", "__hi")))
    return out.withColumn("w_start", F.col("seg_start") + F.col("__k") * stride).withColumn("pos", F.col(index) - F.col("w_start")).drop("__lo", "__hi", "__k")


def window_matrix(in_windows: DataFrame, series: str, features: list[str]) -> DataFrame:
    """Rows (series, w_start, matrix): float32 rows of the features in frame order; bounded by the window size."""
    row = F.struct("pos", F.array(*[F.col(f"`{c}`").cast("float") for c in features]).alias("values"))
    out = in_windows.groupBy(series, "w_start").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return out.select(series, "w_start", F.col("rows.values").alias("matrix"))


def missing_boundaries(catalogue: DataFrame, segments: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Catalogue rows without a stored segment list; with a limit the first of them by key (None or 0: all)."""
    return limited(catalogue.join(segments.select(key).distinct(), key, "left_anti"), key, limit)


def stored_windows(catalogue: DataFrame, ids: DataFrame, key: str, size: int | None = 128, stride: int = 64, column: str = "segment_boundaries") -> tuple[DataFrame, DataFrame]:
    """(windows, skipped) of the wanted ids from the boundaries stored with the catalogue; no frames are read.

    windows: rows (key, seg_start, seg_end, w_start, w_end).  skipped: one row (skipped), the number of wanted series
    whose boundaries are NULL or empty text; `[]` is a series without segments and is not counted.  Ids that
    are not in the catalogue are ignored, repeated ones taken once.
    """
    wanted = catalogue.join(ids.select(key).distinct(), key, "left_semi").select(key, F.col(column).alias("boundaries"))
    lacking = F.coalesce(F.col("boundaries"), F.lit("")) == ""
    return window_index(parse_boundaries(wanted.filter(~lacking)), size, stride), wanted.agg(F.count_if(lacking).alias("skipped"))


def backfill_boundaries(catalogue: DataFrame, frames: DataFrame, key: str, reset: Column, min_frames: int = 10, column: str = "segment_boundaries", index: str = "frame") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(boundaries, failures, summary) for the parsed catalogue rows without stored boundaries.

    boundaries: rows (key, boundaries JSON), `[]` for a series without a long enough segment; failures: rows (key, error) of
    those that have no frames; summary: one row (total, successful, failed).  frames needs only key, index and
    what reset looks at; series that are not asked for are not segmented.
    """
    asked = catalogue.filter(F.col(column).isNull()).select(key).distinct()
    mine = frames.join(asked, key, "left_semi")
    there = mine.select(key).distinct()
    found = there.join(boundaries_json(segment_boundaries(mine, key, reset, min_frames, index), key), key, "left").select(key, F.coalesce("boundaries", F.lit("[]")).alias("boundaries"))
    state = asked.join(there.withColumn("__there", F.lit(True)), key, "left")
    failures = state.filter("__there is null").select(key, F.lit("no frames found").alias("error"))
    ok = F.count_if(F.col("__there"))
    return found, failures, state.agg(F.count("*").alias("total"), ok.alias("successful"), (F.count("*") - ok).alias("failed"))
