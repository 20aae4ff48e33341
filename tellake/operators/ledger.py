"""File-state ledgers: pending work, upserts, statistics, group states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pending(raw: DataFrame, parsed: DataFrame, raw_key: str, parsed_key: str) -> DataFrame:
    """Raw rows without a successful parse (parsed holds successes only); a failed parse is pending again."""
    return raw.join(parsed.select(F.col(parsed_key).alias("__k")).distinct(), F.col(raw_key) == F.col("__k"), "left_anti")


def limited(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The first n rows by key; None or 0: all rows."""
    return df.orderBy(key).limit(n) if n else df


def keep_ids(df: DataFrame, ids: DataFrame, key: str, id_key: str | None = None) -> DataFrame:
    """Rows of df whose key is among ids (column id_key, else key); unknown and repeated ids change nothing."""
    return df.join(ids.select(F.col(id_key or key).alias(key)), key, "left_semi")


def in_given_order(df: DataFrame, ids: DataFrame, key: str, place: str) -> DataFrame:
    """Rows of df whose key is among ids (key, place) with that place, for reading them in the given order; unknown ids give no row."""
    return df.join(ids.groupBy(key).agg(F.min(place).alias(place)), key)


def first_seen(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row a key of new (any of repeated ones) with is_new: whether table lacks the key."""
    known = table.select(F.col(key).alias("__k")).distinct().withColumn("__known", F.lit(True))
    return new.dropDuplicates([key]).join(known, F.col(key) == F.col("__k"), "left").withColumn("is_new", F.col("__known").isNull()).drop("__k", "__known")


def insert_if_absent(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """table and those rows of new whose key it lacks (one a key, the others ignored); first_seen tells which they are."""
    return table.unionByName(first_seen(table, new, key).filter("is_new").drop("is_new"))


def upsert(table: DataFrame, new: DataFrame, key: str, overwrite: list[str]) -> DataFrame:
    """Insert new keys; for known ones replace the overwrite columns, NULLs included, and keep the rest."""
    n = new.select(key, *overwrite).withColumns({f"__{c}": F.col(c) for c in overwrite}).drop(*overwrite).withColumn("__new", F.lit(True))
    both = table.join(n, key, "full_outer")
    cols = [F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in overwrite else F.col(c) for c in table.columns]
    return both.select(*cols)


def fold_events(events: DataFrame, key: str, seq: str, kind: str, fields: list[str]) -> DataFrame:
    """Latest state per key from success and failure events: status and error of the last event,
    fields of the last success as one struct (NULLs kept).  Aggregates map-side, so a hot key is one row a task."""
    good = F.col(kind) == "parsed"
    last = events.groupBy(key).agg(
        F.max_by(F.struct(kind, "error"), seq).alias("last"),
        F.max_by(F.when(good, F.struct(*fields)), F.when(good, F.col(seq))).alias("ok"),
    )
    return last.select(key, F.col(f"last.{kind}").alias("status"), F.when(F.col(f"last.{kind}") != "parsed", F.col("last.error")).alias("error"), *[F.col(f"ok.{f}").alias(f) for f in fields])


def fold_ledger(events: DataFrame, key: str, seq: str, kind: str, success: list[str], error: str = "error_message", first: str = "raw_replay_id", boundary: str = "segment_boundaries") -> DataFrame:
    """The parsed-files table that a log of updates gives: rows (key, first, success columns, parse_status, error, boundary).

    kind is `parsed`, `failed` or `boundary`; seq orders the events of a key and does not repeat in it.
    Each column has its own rule of carrying:
    - parse_status and error are of the last parsed or failed event (parsed clears the error);
    - the success columns are of the last parsed event together, NULLs included;
    - first is of the event that inserted the row, the first parsed or failed one, and is never updated;
    - boundary is of the last boundary event, if the row was there by then: an update inserts nothing.
    Other kinds and keys with boundary events alone give no row.  One aggregation, combined map-side.
    """
    k = F.col(kind)
    inserts, good, cut = k.isin("parsed", "failed"), k == "parsed", k == "boundary"

    def last(of: Column, *columns: str) -> Column:
        return F.max(F.when(of, F.struct(F.col(seq).alias("at"), *[F.col(c).alias(c) for c in columns])))

    folded = events.groupBy(key).agg(
        F.min(F.when(inserts, F.struct(F.col(seq).alias("at"), F.col(first).alias("first")))).alias("born"), last(inserts, kind, error).alias("state"), last(good, *success).alias("ok"), last(cut, boundary).alias("cut"))
    state = F.col(f"state.{kind}")
    return folded.filter("born is not null").select(
        key, F.col("born.first").alias(first), *[F.col(f"ok.{c}").alias(c) for c in success], state.alias("parse_status"), F.when(state == "failed", F.col(f"state.{error}")).alias(error),
        F.when(F.col("cut.at") > F.col("born.at"), F.col(f"cut.{boundary}")).alias(boundary))


def replace_matched(table: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Update columns of rows whose key is in updates; insert nothing."""
    n = updates.select(key, *[F.col(c).alias(f"__{c}") for c in columns]).withColumn("__hit", F.lit(True))
    joined = table.join(n, key, "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns])


def with_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add missing columns as typed NULLs; existing ones stay."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def megabytes(b: Column, power: int = 2) -> Column:
    return F.round(F.coalesce(b, F.lit(0)) / float(1024**power), 2)


def group_state(done: Column, failed: Column, skipped: Column | None = None) -> Column:
    """complete without failures; partial if anything was done (or skipped); else failed."""
    some = done > 0 if skipped is None else (done > 0) | (skipped > 0)
    return F.when(failed == 0, "complete").when(some, "partial").otherwise("failed")


def skip_decision(known: Column, stored: Column, size: Column) -> Column:
    """Known as downloaded: skip; stored but unknown: mark; else fetch."""
    return F.struct(F.when(known, "skip").when(stored, "mark").otherwise("fetch").alias("action"), F.when(~known & stored, size).alias("size"))


def catalogue(parsed: DataFrame, status: str = "status", path: str = "output_path") -> DataFrame:
    """Parsed rows that have an output path."""
    return parsed.filter((F.col(status) == "parsed") & (F.col(path) != ""))


def lookup(table: DataFrame, key: str, value) -> DataFrame:
    """The catalogue row of one key, or none; no file is read."""
    return table.filter(F.col(key) == F.lit(value))


def with_status(table: DataFrame, columns: list[str], status: str, *wanted) -> DataFrame:
    """columns of the rows in one of the wanted states."""
    return table.filter(F.col(status).isin(*wanted)).select(*columns)


def failed_with_source(failed: DataFrame, raw: DataFrame, key: str, raw_key: str, columns: list[str]) -> DataFrame:
    """Keys of failed rows with columns of their raw row; NULL where that is absent."""
    r = raw.select(F.col(raw_key).alias("__k"), *columns)
    return failed.join(r, F.col(key) == F.col("__k"), "left").select(key, *columns)


def inherit(parsed: DataFrame, raw: DataFrame, key: str, raw_key: str, columns: list[str], flag: Column, flag_name: str = "is_rlcs") -> DataFrame:
    """parsed with columns of its raw row (NULL where that is absent) and a flag of it (false there)."""
    r = raw.select(F.col(raw_key).alias("__k"), *columns, flag.alias("__flag"))
    return parsed.join(r, F.col(key) == F.col("__k"), "left").select(*parsed.columns, *columns, F.coalesce("__flag", F.lit(False)).alias(flag_name))


def record_failures(table: DataFrame, failures: DataFrame, key: str) -> DataFrame:
    """Insert keys of failures (key, error) as failed, or set only status and error of known ones."""
    return upsert(table, failures.withColumn("status", F.lit("failed")), key, ["status", "error"])


def start_groups(groups: DataFrame, started: DataFrame, key: str, counts: list[str], completed: str = "completed_at") -> DataFrame:
    """Insert started groups, or reset known ones: pending, counts 0, not completed; other columns stay."""
    zero = groups.schema
    fresh = started.select(key).distinct().withColumns({"status": F.lit("pending"), **{c: F.lit(0).cast(zero[c].dataType) for c in counts}, completed: F.lit(None).cast(zero[completed].dataType)})
    return upsert(groups, fresh, key, ["status", *counts, completed])


def mark_downloaded(raw: DataFrame, done: DataFrame, key: str, columns: list[str], status: str = "download_status") -> DataFrame:
    """Known rows in done become downloaded, in flag and status, and take its columns; an error text stays.  Nothing is inserted."""
    return replace_matched(raw, done.withColumns({"is_downloaded": F.lit(True).cast(raw.schema["is_downloaded"].dataType), status: F.lit("downloaded")}), key, ["is_downloaded", status, *columns])


def mark_failed(raw: DataFrame, failures: DataFrame, key: str, status: str = "download_status", error: str = "error_message") -> DataFrame:
    """Known rows in failures (key, error) become failed and take its error text; is_downloaded stays.  Nothing is inserted."""
    return replace_matched(raw, failures.withColumn(status, F.lit("failed")), key, [status, error])


def unfilled(raw: DataFrame, key: str, missing: str = "duration", order: str = "downloaded_at") -> DataFrame:
    """Rows (key, order) that a backfill has to fetch: downloaded and without `missing`, in order of `order` (NULL first, then by key)."""
    return raw.filter(F.col("is_downloaded").cast("boolean") & F.col(missing).isNull()).select(key, order).orderBy(F.asc_nulls_first(order), key)


#: fixed values: columns of a raw row that a backfill takes from the fetched record
FETCHED = ("duration", "overtime", "overtime_seconds", "map_code", "map_name", "match_type", "team_size", "season", "season_type", "blue_goals", "orange_goals", "min_rank_division", "max_rank_division", "uploader_name", "uploader_steam_id")


def backfill(raw: DataFrame, fetched: DataFrame, key: str, columns: tuple[str, ...] = FETCHED) -> DataFrame:
    """raw with the columns of fetched (flat records) where a chosen row was fetched, NULLs included; other rows stay."""
    chosen = keep_ids(fetched, unfilled(raw, key, columns[0]), key)
    return replace_matched(raw, chosen, key, list(columns))


def frame_summary(table: DataFrame, count: str) -> DataFrame:
    """One row over non-null counts: n, mean, population std, low, high, exact median, total."""
    return table.agg(F.count(count).alias("n"), F.avg(count).alias("mean"), F.stddev_pop(count).alias("std"), F.min(count).alias("low"), F.max(count).alias("high"), F.median(count).alias("median"), F.sum(count).alias("total"))


def sizes(total: Column) -> list[Column]:
    """Bytes (0 for NULL), MB and GB."""
    return [F.coalesce(total, F.lit(0)).alias("bytes"), megabytes(total).alias("mb"), megabytes(total, 3).alias("gb")]


def download_statistics(raw: DataFrame, downloaded: Column, failed: Column, size: str) -> DataFrame:
    """One row (total, downloaded, failed, pending, bytes, mb, gb)."""
    done, bad = F.count_if(downloaded), F.count_if(failed)
    return raw.agg(F.count("*").alias("total"), done.alias("downloaded"), bad.alias("failed"), (F.count("*") - done - bad).alias("pending"), *sizes(F.sum(size)))


def parse_statistics(parsed: DataFrame, ok: Column, frames: str, size: str) -> DataFrame:
    """One row (entries, parsed, failed_parses, total_frames of parsed ones, parsed_bytes, parsed_mb, parsed_gb)."""
    total = F.sum(size)
    return parsed.agg(F.count("*").alias("entries"), F.count_if(ok).alias("parsed"), F.count_if(~ok).alias("failed_parses"), F.sum(F.when(ok, F.col(frames))).alias("total_frames"), *[c.alias(f"parsed_{n}") for c, n in zip(sizes(total), ("bytes", "mb", "gb"))])


def full_statistics(downloads: DataFrame, parses: DataFrame) -> DataFrame:
    """Both statistics, of one row each, as one row."""
    return downloads.crossJoin(parses)


def batch_result(outcomes: DataFrame, batch: list[str] | None = None) -> DataFrame:
    """One row a batch (batch columns, total, successful, skipped, failed, frames, bytes) of outcomes (outcome, frames, bytes).

    outcome is parsed, skipped or failed; frames and bytes are those of parsed rows.  Without batch columns
    all rows are one batch.  Paths and errors are tables of their own: batch_outputs and batch_errors.
    """

    def of(kind: str) -> Column:
        return F.col("outcome") == kind

    def total(c: str) -> Column:
        return F.coalesce(F.sum(F.when(of("parsed"), F.col(c))), F.lit(0)).alias(c)

    return outcomes.groupBy(*(batch or [])).agg(F.count("*").alias("total"), F.count_if(of("parsed")).alias("successful"), F.count_if(of("skipped")).alias("skipped"), F.count_if(of("failed")).alias("failed"), total("frames"), total("bytes"))


def batch_outputs(outcomes: DataFrame, batch: list[str] | None = None) -> DataFrame:
    """Rows (batch columns, output_path), one a parsed row."""
    return outcomes.filter("outcome = 'parsed'").select(*(batch or []), "output_path")


def batch_errors(outcomes: DataFrame, key: str, batch: list[str] | None = None) -> DataFrame:
    """Rows (batch columns, key, error), one a failed row."""
    return outcomes.filter("outcome = 'failed'").select(*(batch or []), key, "error")


def to_visit(members: DataFrame, groups: DataFrame, key: str, status: str = "status", force: bool = False, ids: DataFrame | None = None, id_key: str | None = None) -> DataFrame:
    """Members of groups that are not complete; all groups if forced or if only certain ids are asked for."""
    if ids is not None:
        return members.join(ids.select(F.col(id_key)).distinct(), id_key, "left_semi")
    return members if force else members.join(groups.filter(F.col(status) == "complete").select(key), key, "left_anti")


def metadata_merge(ledger: DataFrame, stored: DataFrame, sidecar: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fields by precedence sidecar, stored, ledger; a NULL counts as missing."""
    out = ledger.select(key, *fields)
    for i, other in enumerate((stored, sidecar)):
        out = out.join(other.select(key, *[F.col(f).alias(f"__{i}{f}") for f in fields]), key, "left")
    return out.select(key, *[F.coalesce(f"__1{f}", f"__0{f}", f).alias(f) for f in fields])


def latest_snapshot(snapshots: DataFrame, stamp: str) -> DataFrame:
    """Rows of the snapshot with the largest stamp, for a table of snapshots.

    The stamp is found first, so that the rows are read with it as a filter: of a table partitioned by the stamp
    only that partition, of another only row groups that may hold it.  Snapshots written as folders are
    found from their names alone by sources.frames.read_latest_snapshot.
    """
    top = snapshots.agg(F.max(stamp)).first()[0]
    return snapshots.filter(F.lit(False) if top is None else F.col(stamp) == F.lit(top))


def batch_ids(ids: DataFrame, key: str, size: int = 100) -> DataFrame:
    """ids with batch_id: consecutive groups of `size` by key order.

    Places come from per-bucket counts, so no single task orders all ids.
    """
    return with_place(ids, key).withColumn("batch_id", F.floor(F.col("place") / size)).drop("place")


def with_place(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """df with place = 0-based rank by key (distinct keys): sorted ranges (as many as shuffle partitions), counted, then offset."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = df.repartitionByRange(buckets, key).withColumn("__part", F.spark_partition_id())
    from .storage import stored

    ranged = stored(ranged)
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    inner = F.row_number().over(Window.partitionBy("__part").orderBy(key)) - 1
    return ranged.withColumn("place", inner).join(F.broadcast(before), "__part").withColumn("place", (F.col("place") + F.col("__before")).cast("long")).drop("__part", "__before")
