"""The fold of a log of updates against the updates one by one, and the ledger's odd cases."""

import random

import pytest
from pyspark.sql import functions as F

from tellake.operators import ledger, segments

EVENT = "id string, seq long, event string, raw_replay_id string, error_message string, output_path string, frame_count long, segment_boundaries string"
TABLE = "id string, download_status string, is_downloaded boolean, error_message string, size long"


def step_by_step(events):
    table = {}
    for e in sorted(events, key=lambda e: e[1]):
        key, _, kind, raw, error, path, frames, cut = e
        row = table.get(key)
        if kind == "boundary":
            if row:
                row["cut"] = cut
        elif kind == "failed":
            row = table.setdefault(key, {"raw": raw, "path": None, "frames": None, "cut": None})
            row.update(status="failed", error=error)
        elif kind == "parsed":
            row = table.setdefault(key, {"raw": raw, "cut": None})
            row.update(path=path, frames=frames, status="parsed", error=None)
    return sorted(((k, r["raw"], r["path"], r["frames"], r["status"], r["error"], r["cut"]) for k, r in table.items()))


@pytest.mark.parametrize("seed", range(3))
def test_fold_equals_updates_one_by_one(spark, seed):
    rng = random.Random(seed)
    events = []
    for seq in range(600):
        kind = rng.choice(["parsed", "failed", "boundary", "other"])
        events.append((f"k{rng.randrange(60)}", seq, kind, f"raw{seq}", rng.choice([None, f"e{seq}"]), rng.choice([None, f"p{seq}"]), rng.choice([None, seq]), rng.choice([None, f"[[0,{seq}]]"])))
    df = spark.createDataFrame(rng.sample(events, len(events)), EVENT).repartition(3)
    got = ledger.fold_ledger(df, "id", "seq", "event", ["output_path", "frame_count"])
    assert got.columns == ["id", "raw_replay_id", "output_path", "frame_count", "parse_status", "error_message", "segment_boundaries"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(step_by_step(events), key=str)
    assert ledger.fold_ledger(df.limit(0), "id", "seq", "event", ["output_path"]).count() == 0
    plan = ledger.fold_ledger(df, "id", "seq", "event", ["output_path"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_marks_set_the_status(spark):
    raw = spark.createDataFrame([("a", "pending", False, "old", None), ("b", "downloaded", True, None, 9), ("c", "pending", False, None, None)], TABLE)
    done = spark.createDataFrame([("a", 4), ("z", 4)], "id string, size long")
    bad = spark.createDataFrame([("b", "broken"), ("q", "gone")], "id string, error_message string")
    assert sorted(map(tuple, ledger.mark_downloaded(raw, done, "id", ["size"]).collect())) == [("a", "downloaded", True, "old", 4), ("b", "downloaded", True, None, 9), ("c", "pending", False, None, None)]
    assert sorted(map(tuple, ledger.mark_failed(raw, bad, "id").collect())) == [("a", "pending", False, "old", None), ("b", "failed", True, "broken", 9), ("c", "pending", False, None, None)]
    stats = ledger.download_statistics(ledger.mark_failed(raw, bad, "id"), F.col("is_downloaded"), F.col("download_status") == "failed", "size").first()
    assert (stats.total, stats.downloaded, stats.failed, stats.pending) == (3, 1, 1, 1)


def test_first_seen_and_subsets(spark):
    table = spark.createDataFrame([("a", 1), ("a", 1)], "id string, n int")
    new = spark.createDataFrame([("a", 9), ("b", 2), ("b", 2)], "id string, n int")
    assert sorted((r.id, r.is_new) for r in ledger.first_seen(table, new, "id").collect()) == [("a", False), ("b", True)]
    assert sorted(map(tuple, ledger.insert_if_absent(table, new, "id").collect())) == [("a", 1), ("a", 1), ("b", 2)]
    ids = spark.createDataFrame([("b", 0), ("a", 1), ("z", 2), ("b", 3)], "id string, place int")
    rows = table.unionByName(new.filter("id = 'b'"))
    assert sorted(map(tuple, ledger.keep_ids(rows, ids.filter("id <> 'a'"), "id").collect())) == [("b", 2), ("b", 2)]
    assert [r.id for r in ledger.in_given_order(rows, ids, "id", "place").orderBy("place").collect()] == ["b", "b", "a", "a"]


def test_backfill_chooses_rows(spark):
    raw = spark.createDataFrame([("a", True, "2024-02", None, 1), ("b", True, "2024-01", None, 2), ("c", False, "2024-01", None, 3), ("d", True, "2023-01", 5, 4), ("e", True, None, None, 5)], "id string, is_downloaded boolean, downloaded_at string, duration long, season long")
    assert [r.id for r in ledger.unfilled(raw, "id").collect()] == ["e", "b", "a"]
    fetched = spark.createDataFrame([(k, 7, None) for k in "abcd"], "id string, duration long, season long")
    got = sorted(map(tuple, ledger.backfill(raw, fetched, "id", ("duration", "season")).collect()))
    assert got == [("a", True, "2024-02", 7, None), ("b", True, "2024-01", 7, None), ("c", False, "2024-01", None, 3), ("d", True, "2023-01", 5, 4), ("e", True, None, None, 5)]
    assert len(ledger.FETCHED) == 15


def test_batch_tables(spark):
    rows = [(1, "x", "parsed", 5, 50, "p/x", None), (1, "y", "skipped", 7, 70, "p/y", None), (1, "z", "failed", 9, 90, None, "bad"), (2, "w", "failed", None, None, None, None)]
    df = spark.createDataFrame(rows, "b int, id string, outcome string, frames long, bytes long, output_path string, error string")
    assert sorted(map(tuple, ledger.batch_result(df, ["b"]).collect())) == [(1, 3, 1, 1, 1, 5, 50), (2, 1, 0, 0, 1, 0, 0)]
    assert [tuple(r) for r in ledger.batch_outputs(df, ["b"]).collect()] == [(1, "p/x")]
    assert sorted(map(tuple, ledger.batch_errors(df, "id", ["b"]).collect())) == [(1, "z", "bad"), (2, "w", None)]
    assert tuple(ledger.batch_result(df.limit(0)).first()) == (0, 0, 0, 0, 0, 0)


def test_stored_windows_count_what_is_missing(spark):
    table = spark.createDataFrame([("a", "[[0,10],[20,24]]"), ("b", None), ("c", ""), ("d", "[]"), ("e", "[[0,100]]"), ("f", "[[0, 4]]")], "id string, segment_boundaries string")
    ids = spark.createDataFrame([(k,) for k in "abcdfzza"], "id string")
    windows, skipped = segments.stored_windows(table, ids, "id", 4, 3)
    assert sorted((r.id, r.w_start, r.w_end) for r in windows.collect()) == [("a", 0, 4), ("a", 3, 7), ("a", 6, 10), ("a", 20, 24), ("f", 0, 4)] and skipped.first()[0] == 2
    whole, _ = segments.stored_windows(table, ids, "id", None)
    assert sorted((r.id, r.w_start, r.w_end) for r in whole.collect()) == [("a", 0, 10), ("a", 20, 24), ("f", 0, 4)]


def test_backfill_counts_failures(spark):
    table = spark.createDataFrame([("a", None), ("b", "[]"), ("c", None), ("d", None)], "id string, segment_boundaries string")
    frames = spark.createDataFrame([(s, k, k == 3) for s in "ab" for k in range(12)] + [("d", k, True) for k in range(5)], "id string, frame long, r boolean")
    found, failures, summary = segments.backfill_boundaries(table, frames, "id", F.col("r"), 3)
    assert sorted(map(tuple, found.collect())) == [("a", "[[0,3],[4,12]]"), ("d", "[]")]
    assert [tuple(r) for r in failures.collect()] == [("c", "no frames found")] and tuple(summary.first()) == (3, 2, 1)
