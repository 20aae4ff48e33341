"""Resumable processing: what is pending is worked on, and results count once the ledger says so.

A batch has two sinks, frames and ledger, each a folder of its number.  The ledger is written last and a batch
is committed when its ledger folder is complete.  A run that dies before that is repeated under the same
number and replaces what it left; readers of committed frames never see it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger
from ..operators.ledger import pending
from ..operators.storage import entries, exists, release, stored
from ..sources.writing import inventory, write_series

Work = Callable[[DataFrame], tuple[DataFrame, DataFrame]]
Boundaries = Callable[[DataFrame], DataFrame]
SUCCESS = ["output_path", "frame_count", "file_size_bytes"]


def process_pending(raw: DataFrame, parsed: DataFrame, raw_key: str, parsed_key: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results of work for raw rows not yet parsed; rerunning after appending them yields nothing."""
    return work(pending(raw, parsed, raw_key, parsed_key))


def drain(spark: SparkSession, source: str, schema, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> None:
    """Process files that arrived since the last call and append results to sink; safe to repeat.

    A replayed batch overwrites its own folder, so results are not doubled.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def retry(failed: Callable[[], DataFrame], work: Callable[[DataFrame], None], attempts: int = 3) -> int:
    """Run work on the failed rows until none are left, at most `attempts` times; returns the rounds used."""
    for k in range(attempts):
        rows = failed()
        if rows.isEmpty():
            return k
        work(rows)
    return attempts


class Store:
    """The two sinks below a root folder, frames/batch=<label> and ledger/batch=<label>.

    A label is <place in the ledger>-<lane>-<number in the lane>: a lane numbers its own batches, so that runs and
    streams can share a store, and the places put all committed batches in one order.
    key names the series and kind is its type; frames has the frames' schema (a DDL string with the key).
    """

    def __init__(self, spark: SparkSession, root: str, key: str, kind: str, frames: str):
        self.spark, self.root, self.key, self.kind, self.schema = spark, root.rstrip("/"), key, kind, frames
        self.event = f"`{key}` {kind}, seq long, event string, raw_replay_id {kind}, error_message string, output_path string, frame_count long, file_size_bytes long, segment_boundaries string"

    def committed(self) -> list[tuple[int, str, int]]:
        """(place, lane, number) of the batches whose ledger is complete, in order."""
        names = [n[6:] for n in entries(self.spark, f"{self.root}/ledger") if n.startswith("batch=") and exists(self.spark, f"{self.root}/ledger/{n}/_SUCCESS")]
        return sorted((int(place), lane, int(number)) for place, lane, number in (n.split("-") for n in names))

    def numbers(self, lane: str) -> list[int]:
        """Numbers of a lane's committed batches."""
        return [n for _, own, n in self.committed() if own == lane]

    def _read(self, sink: str, schema: str) -> DataFrame:
        done = ["-".join(map(str, b)) for b in self.committed()]
        if not done:
            return self.spark.createDataFrame([], f"{schema}, batch string")
        df = self.spark.read.schema(f"{schema}, batch string").option("basePath", f"{self.root}/{sink}").parquet(f"{self.root}/{sink}")
        return df.filter(F.col("batch").isin(done))

    def events(self) -> DataFrame:
        """The ledger's events of all committed batches; seq is twice the batch's place, and one more for boundaries."""
        return self._read("ledger", self.event)

    def state(self) -> DataFrame:
        """The ledger as a table, one row a series: (key, raw_replay_id, output_path, frame_count, file_size_bytes, parse_status, error_message, segment_boundaries)."""
        return ledger.fold_ledger(self.events(), self.key, "seq", "event", SUCCESS)

    def frames(self) -> DataFrame:
        """Frames of each parsed series from the batch that parsed it last; of other batches none."""
        last = self.events().filter("event = 'parsed'").groupBy(self.key).agg(F.max_by("batch", "seq").alias("batch"))
        good = self.state().filter("parse_status = 'parsed'").select(self.key)
        return self._read("frames", self.schema).join(last.join(good, self.key), [self.key, "batch"], "left_semi").drop("batch")

    def commit(self, lane: str, number: int, frames: DataFrame, outcomes: DataFrame, index: str = "frame", between: Callable[[], None] | None = None, boundaries: Boundaries | None = None) -> None:
        """Write a lane's batch: frames, then, from what the files hold, the ledger.  Nothing is done if the batch is committed.

        outcomes: rows (key, error), error NULL for success.  Only successes' frames are written; a success whose
        frames are not in the files is recorded as failed.  boundaries gives rows (key, boundaries) of the written
        frames, to be recorded with them.  between runs between the two sinks, for tests.
        """
        done = self.committed()
        if any(b[1:] == (lane, number) for b in done):
            return
        place = max((b[0] for b in done), default=-1) + 1
        at = f"batch={place}-{lane}-{number}"
        told = stored(outcomes.select(self.key, F.col("error").cast("string").alias("error")).dropDuplicates([self.key]))
        fine = frames.join(told.filter("error is null").select(self.key), self.key, "left_semi")
        write_series(fine, f"{self.root}/frames/{at}", self.key, index)
        if between:
            between()
        held = inventory(self.spark, f"{self.root}/frames/{at}", self.key, self.kind)
        rows = told.join(held, self.key, "left").withColumn("error", F.when(F.col("error").isNull() & F.col("rows").isNull(), "no frames were written").otherwise(F.col("error")))
        good = F.col("error").isNull()
        events = rows.select(
            self.key, F.lit(2 * place).cast("long").alias("seq"), F.when(good, "parsed").otherwise("failed").alias("event"), F.col(self.key).alias("raw_replay_id"), F.col("error").alias("error_message"),
            *[F.when(good, F.col(a)).alias(b) for a, b in (("output_path", "output_path"), ("rows", "frame_count"), ("bytes", "file_size_bytes"))], F.lit(None).cast("string").alias("segment_boundaries"))
        if boundaries:
            cuts = boundaries(self.spark.read.schema(self.schema).parquet(f"{self.root}/frames/{at}")).select(self.key, F.lit(2 * place + 1).cast("long").alias("seq"), F.lit("boundary").alias("event"), F.col("boundaries").alias("segment_boundaries"))
            events = events.unionByName(cuts, allowMissingColumns=True)
        events.write.mode("overwrite").parquet(f"{self.root}/ledger/{at}")
        release(told)

    def result(self, lane: str, number: int) -> DataFrame:
        """Totals of a committed batch, as ledger.batch_result."""
        e = self.events().filter(F.col("batch").endswith(f"-{lane}-{number}") & (F.col("event") != "boundary"))
        return ledger.batch_result(e.select(F.col("event").alias("outcome"), F.col("frame_count").alias("frames"), F.col("file_size_bytes").alias("bytes")))


def _run(store: Store, rows: DataFrame, work: Work, index: str, between: Callable[[], None] | None = None, lane: str = "run", number: int | None = None, boundaries: Boundaries | None = None) -> int:
    number = max(store.numbers(lane), default=-1) + 1 if number is None else number
    left = stored(rows)
    frames, outcomes = work(left)
    store.commit(lane, number, frames, outcomes, index, between, boundaries)
    release(left)
    return number


def run_pending(store: Store, raw: DataFrame, work: Work, limit: int | None = None, index: str = "frame", between: Callable[[], None] | None = None, boundaries: Boundaries | None = None) -> int:
    """Work on the raw rows (column key) that are not parsed, failed ones again, and commit; returns the run's number.

    work(raw rows) gives (frames, outcomes (key, error)); boundaries(frames) gives rows (key, boundaries) to record
    in the same batch.  A run that died is repeated under its number.
    """
    left = ledger.limited(pending(raw, store.state().filter("parse_status = 'parsed'"), store.key, store.key), store.key, limit)
    return _run(store, left, work, index, between, boundaries=boundaries)


def retry_failed(store: Store, raw: DataFrame, work: Work, attempts: int = 3, index: str = "frame") -> int:
    """Work on the series whose last parse failed until none is left, at most `attempts` times; returns the rounds used."""

    def failed() -> DataFrame:
        bad = store.state().filter("parse_status = 'failed'").select(store.key)
        return raw.join(bad, store.key, "left_semi")

    return retry(failed, lambda rows: _run(store, rows, work, index), attempts)


def drain_to_store(store: Store, source: str, schema: str, work: Work, checkpoint: str, index: str = "frame", between: Callable[[], None] | None = None, lane: str = "stream") -> None:
    """Work on raw rows of files that arrived since the last call, and stop; the stream's batches are the lane's.

    A restarted batch has its old number: if its ledger is complete nothing is done, else both sinks are written
    anew.  Series that an earlier batch parsed are passed over.  One lane a checkpoint.
    """
    stream = store.spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        if number not in store.numbers(lane):
            left = pending(batch, store.state().filter("parse_status = 'parsed'"), store.key, store.key)
            _run(store, left, work, index, between, lane, number)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
