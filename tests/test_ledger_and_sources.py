"""Ledger transitions and statistics, headers and players, and the sources and sinks."""

import json

from pyspark.sql import functions as F

from tellake.functions import metadata, paths
from tellake.operators import features, ledger
from tellake.sources import frames
from tellake.streaming import incremental


def rows(df, *by):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_transitions(spark):
    parsed = spark.createDataFrame([("a", "parsed", None, 5), ("b", "parsed", None, 7)], "id string, status string, error string, frames long")
    bad = spark.createDataFrame([("b", "broken"), ("c", "gone")], "id string, error string")
    assert rows(ledger.record_failures(parsed, bad, "id")) == [("a", "parsed", None, 5), ("b", "failed", "broken", 7), ("c", "failed", "gone", None)]
    groups = spark.createDataFrame([("g", "A", "complete", 3, 1, "2024"), ("h", "B", "partial", 1, 1, None)], "id string, name string, status string, done long, failed long, completed_at string")
    begun = spark.createDataFrame([("g",), ("k",)], "id string")
    assert rows(ledger.start_groups(groups, begun, "id", ["done", "failed"])) == [("g", "A", "pending", 0, 0, None), ("h", "B", "partial", 1, 1, None), ("k", None, "pending", 0, 0, None)]


def test_lookup_and_visits(spark):
    table = spark.createDataFrame([("a", "parsed", "x"), ("b", "parsed", ""), ("c", "failed", "y")], "id string, status string, output_path string")
    assert rows(ledger.catalogue(table).select("id")) == [("a",)] and ledger.lookup(table, "id", "q").isEmpty()
    assert rows(ledger.with_status(table, ["id"], "status", "failed")) == [("c",)]
    members = spark.createDataFrame([("g", 1), ("g", 2), ("h", 3)], "grp string, id long")
    groups = spark.createDataFrame([("g", "complete"), ("h", "partial")], "grp string, status string")
    assert rows(ledger.to_visit(members, groups, "grp")) == [("h", 3)] and ledger.to_visit(members, groups, "grp", force=True).count() == 3
    assert rows(ledger.to_visit(members, groups, "grp", ids=spark.createDataFrame([(1,), (9,)], "id long"), id_key="id")) in ([("g", 1)], [(1, "g")])


def test_statistics_of_nothing(spark):
    none = spark.createDataFrame([], "id string, outcome string, frames long, bytes long, output_path string, error string, path string, length long")
    assert tuple(ledger.batch_result(none).first()) == (0, 0, 0, 0, 0, 0)
    assert tuple(paths.storage_statistics(none, "x").first()) == (0, 0, 0.0, 0.0)
    d = ledger.download_statistics(none, F.col("outcome") == "d", F.col("outcome") == "f", "bytes").first()
    assert tuple(d) == (0, 0, 0, 0, 0, 0.0, 0.0) and ledger.frame_summary(none, "frames").first().n == 0


def test_header_and_players(spark):
    pair = "struct<key:string,value:string>"
    df = spark.createDataFrame([(1, [("Id", "x"), ("Goals", "[3]"), ("Id", "y")]), (2, [])], f"id int, pairs array<{pair}>")
    one, two = sorted(metadata.header_fields(df, ["id"], "pairs").collect())
    assert len(one) == 13 and (one.ballchasing_id, one.goals, one.highlights, one.date) == ("y", "[3]", "[]", None) and (two.ballchasing_id, two.goals) == (None, "[]")
    player = "struct<name:string,remote_id:map<string,string>,stats:map<string,int>>"
    teams = spark.createDataFrame([(1, [("A", {"Steam": "77", "Epic": "x"}, {"s": 1}), (None, {"Epic": "5"}, None)], None), (2, None, [("B", None, {})])], f"id int, zero array<{player}>, one array<{player}>")
    got = [tuple(r) for r in metadata.player_mapping(teams, ["id"], "zero", "one").orderBy("id", "slot").collect()]
    assert got == [(1, 0, 0, "A", "77", {"s": 1}), (1, 1, 0, None, None, {}), (2, 0, 1, "B", None, {})]
    n = teams.select("id", features.player_count("zero", "one").alias("n")).orderBy("id").collect()
    assert [r.n for r in n] == [2, 1]


def test_mirror_keys(spark):
    df = spark.createDataFrame([("a", "replays/raw/x/a.replay"), ("b", None)], "id string, raw string")
    assert rows(df.select(paths.mirror_key(F.col("raw"), F.col("id"), paths.SIDECAR))) == [("replays/parsed/b.metadata.json",), ("replays/parsed/x/a.metadata.json",)]


def test_sources_and_sinks(spark, tmp_path):
    base = f"file://{tmp_path}"
    for name, text in (("a.replay", "12"), ("sub/b.replay", "bad"), ("c.txt", "x")):
        f = tmp_path / "raw" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(text)
    listing = frames.list_files(spark, f"{base}/raw")
    assert rows(listing.select("stem", "length")) == [("a", 2), ("b", 3)]
    wanted = spark.createDataFrame([("a",), ("q",)], "stem string")
    assert rows(frames.file_sizes(wanted, listing, "stem")) == [("a", 2), ("q", 0)]
    assert frames.list_files(spark, f"{base}/none").count() == 0 and tuple(paths.storage_statistics(frames.list_files(spark, f"{base}/none")).first()) == (0, 0, 0.0, 0.0)
    table = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0)], "replay_id string, frame int")
    frames.write_frames(table, f"{base}/frames", 2)
    assert rows(spark.read.parquet(f"{base}/frames")) == rows(table)
    side = tmp_path / "side"
    side.mkdir()
    (side / "a.json").write_text(json.dumps({"id": "a", "n": 1}, indent=2))
    (side / "b.json").write_text("{ broken")
    assert rows(frames.read_sidecar(spark, f"{base}/side", "id string, n long")) == [("a", 1)]
    records = spark.createDataFrame([("a", 1, [("k", 2)]), ("b", 2, None)], "replay_id string, n long, goals array<struct<who:string,at:int>>")
    frames.write_sidecar(records, f"{base}/records")
    frames.write_sidecar(records, f"{base}/records")
    written = sorted((tmp_path / "records").rglob("part-*"))
    assert len(written) == 2 and json.loads(written[0].read_text()) == {"replay_id": "a", "n": 1, "goals": [{"who": "k", "at": 2}]} and "\n  " in written[0].read_text()
    assert rows(frames.read_sidecar(spark, f"{base}/records", "replay_id string, n long")) == [("a", 1), ("b", 2)]
    assert frames.read_latest_snapshot(spark, f"{base}/snap") is None and frames.snapshot_stamps(spark, f"{base}/snap") == []
    for stamp in ("20240101_000000", "20250101_000000"):
        frames.write_snapshot(table.limit(1 + (stamp > "2025")), f"{base}/snap", stamp)
    assert ledger.latest_snapshot(spark.read.parquet(f"{base}/snap"), "ts").count() == 2
    assert ledger.latest_snapshot(spark.read.parquet(f"{base}/snap").limit(0), "ts").count() == 0
    latest = frames.read_latest_snapshot(spark, f"{base}/snap")
    assert latest.count() == 2 and latest.columns == ["replay_id", "frame"] and all("ts=20250101_000000" in f for f in latest.inputFiles())


def test_retry(spark):
    left = [3]
    assert incremental.retry(lambda: spark.range(left[0]), lambda df: left.__setitem__(0, left[0] - 2 if left[0] > 1 else 0), attempts=5) == 2
    assert incremental.retry(lambda: spark.range(1), lambda df: None, attempts=2) == 2
