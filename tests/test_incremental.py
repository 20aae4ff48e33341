"""The store of incremental runs: killed between its sinks, restarted, retried; against one clean run."""

import pytest
from pyspark.sql import functions as F

from tellake.sources import loading, writing
from tellake.streaming import incremental

FRAMES = "id long, frame long, v double"


def work(bad):
    def run(raw):
        frames = raw.withColumn("frame", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select("id", "frame", (F.col("id") * 1.0).alias("v"))
        return frames, raw.select("id", F.when(F.col("id").isin(bad), "broken").alias("error"))

    return run


def raw_rows(spark, ids):
    return spark.createDataFrame([(i, 3 + i % 4) for i in ids], "id long, n long")


def seen(store):
    state = sorted((r.id, r.parse_status, r.error_message, r.frame_count) for r in store.state().collect())
    frames = sorted((r.id, r.frame, r.v) for r in store.frames().collect())
    return state, frames


def want(good, bad):
    state = sorted([(i, "parsed", None, 3 + i % 4) for i in good] + [(i, "failed", "broken", None) for i in bad])
    return state, sorted((i, k, float(i)) for i in good for k in range(3 + i % 4))


class Killed(Exception):
    pass


def kill():
    raise Killed


def test_pending_runs_and_retries(spark, tmp_path):
    store = incremental.Store(spark, f"file://{tmp_path}/s", "id", "long", FRAMES)
    assert store.committed() == [] and store.state().count() == 0 and store.frames().count() == 0
    raw = raw_rows(spark, range(10))
    with pytest.raises(Killed):
        incremental.run_pending(store, raw, work([2, 5]), between=kill)
    assert seen(store) == ([], [])
    assert incremental.run_pending(store, raw, work([2, 5])) == 0
    assert seen(store) == want([0, 1, 3, 4, 6, 7, 8, 9], [2, 5])
    assert tuple(store.result("run", 0).first())[:5] == (10, 8, 0, 2, sum(3 + i % 4 for i in (0, 1, 3, 4, 6, 7, 8, 9)))
    assert incremental.run_pending(store, raw_rows(spark, range(14)), work([5, 12]), limit=4) == 1  # 2, 5, 10, 11
    assert seen(store) == want([0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11], [5])
    assert incremental.retry_failed(store, raw, work([])) == 1
    assert seen(store) == want(range(12), []) and incremental.retry_failed(store, raw, work([])) == 0
    before = seen(store)
    assert incremental.run_pending(store, raw, work([])) == 3 and seen(store) == before
    assert incremental.retry_failed(store, raw_rows(spark, []), work([])) == 0


def test_retry_gives_up(spark, tmp_path):
    store = incremental.Store(spark, f"file://{tmp_path}/s", "id", "long", FRAMES)
    raw = raw_rows(spark, range(4))
    incremental.run_pending(store, raw, work([1]))
    assert incremental.retry_failed(store, raw, work([1]), attempts=2) == 2
    assert seen(store) == want([0, 2, 3], [1]) and store.events().filter("id = 1").count() == 3


def test_a_success_without_frames_is_a_failure(spark, tmp_path):
    store = incremental.Store(spark, f"file://{tmp_path}/s", "id", "long", FRAMES)
    incremental.run_pending(store, raw_rows(spark, [1, 2]), lambda raw: (work([])(raw)[0].filter("id = 1"), raw.select("id", F.lit(None).cast("string").alias("error"))))
    assert [(r.id, r.parse_status, r.error_message) for r in store.state().orderBy("id").collect()] == [(1, "parsed", None), (2, "failed", "no frames were written")]


def test_stream_killed_between_sinks(spark, tmp_path):
    source, check = f"file://{tmp_path}/src", f"file://{tmp_path}/check"
    store = incremental.Store(spark, f"file://{tmp_path}/s", "id", "long", FRAMES)
    clean = incremental.Store(spark, f"file://{tmp_path}/clean", "id", "long", FRAMES)
    raw_rows(spark, range(6)).write.parquet(source)
    with pytest.raises(Exception):
        incremental.drain_to_store(store, source, "id long, n long", work([3]), check, between=kill)
    assert seen(store) == ([], [])
    incremental.drain_to_store(store, source, "id long, n long", work([3]), check)
    raw_rows(spark, range(3, 9)).write.mode("append").parquet(source)
    for _ in range(2):
        incremental.drain_to_store(store, source, "id long, n long", work([]), check)
    incremental.run_pending(clean, raw_rows(spark, range(9)), work([]))
    assert seen(store) == seen(clean) == want(range(9), [])
    assert store.events().filter("id = 3").count() == 2 and store.events().filter("id = 4").count() == 1


def test_runs_and_streams_share_a_store(spark, tmp_path):
    """Each lane numbers its own batches: none is taken for another's, and the last parse of a series counts."""
    source = f"file://{tmp_path}/src"
    store = incremental.Store(spark, f"file://{tmp_path}/s", "id", "long", FRAMES)
    raw_rows(spark, range(4)).write.parquet(source)
    incremental.run_pending(store, raw_rows(spark, [0, 10]), work([0]))
    with pytest.raises(Exception):
        incremental.drain_to_store(store, source, "id long, n long", work([]), f"file://{tmp_path}/check", between=kill)
    incremental.run_pending(store, raw_rows(spark, [11]), work([]))
    incremental.drain_to_store(store, source, "id long, n long", work([]), f"file://{tmp_path}/check")
    assert seen(store) == want([0, 1, 2, 3, 10, 11], [])
    assert store.committed() == [(0, "run", 0), (1, "run", 1), (2, "stream", 0)]


def test_inventory_and_rerun(spark, tmp_path):
    frames, _ = work([])(raw_rows(spark, range(20)))
    for per_series in (False, True):
        at = tmp_path / str(per_series)
        for _ in range(2):
            writing.write_series(frames, f"file://{at}", "id", per_series=per_series)
        got = {r.id: r for r in writing.inventory(spark, f"file://{at}", "id", "long").collect()}
        files = list(at.rglob("*.parquet"))
        assert {k: r.rows for k, r in got.items()} == {i: 3 + i % 4 for i in range(20)}
        assert sum(r.bytes for r in got.values()) == sum(f.stat().st_size for f in files)
        if per_series:
            assert len(files) == 20 and all(any(str(f) == r.output_path and f.stat().st_size == r.bytes for f in files) for r in got.values())
    rows = writing.ledger_rows(writing.inventory(spark, f"file://{at}", "id", "long"), 3, 30.0)
    assert rows.columns == ["id", "output_path", "frame_count", "file_size_bytes", "output_format", "fps", "feature_count"]
    loaded = loading.load_series(spark, rows, f"file://{at}", FRAMES, key="id")
    assert loaded.frames.count() == frames.count() and loaded.errors.isEmpty()
    assert writing.inventory(spark, "file:///no/such/folder", "id", "long").count() == 0


def test_shards(spark, tmp_path):
    import hashlib

    from tellake.plans.steps import Chain, Normalize

    frames = spark.range(5).selectExpr("id AS s", "explode(sequence(0L, 40L + id)) AS frame").selectExpr("s", "frame", "frame * 2.0D AS `Ball - position x`")
    cuts = spark.createDataFrame([(s, a, b) for s in range(5) for a, b in ((0, 11), (12, 40 + s))], "s long, seg_start long, seg_end long")
    windows = writing.shuffled_windows(frames, cuts, "s", Chain([Normalize()]), ["Ball - position x"], size=4, stride=3, seed=9, rows_per_file=10)
    manifest = sorted(writing.write_shards(windows, f"file://{tmp_path}/w").collect())
    manifest = sorted(writing.write_shards(windows, f"file://{tmp_path}/w").collect())
    expected = sorted(((s, w) for s in range(5) for a, b in ((0, 11), (12, 40 + s)) for w in range(a, b - 3, 3)), key=lambda k: hashlib.md5(f"9|{k[0]}|{k[1]}".encode()).hexdigest())
    assert [m.rows for m in manifest] and max(m.rows for m in manifest) <= 10 and max(m.rows for m in manifest) - min(m.rows for m in manifest) <= 1
    read = [r for m in manifest for r in spark.read.parquet(m.path).collect()]
    assert [(r.s, r.w_start) for r in read] == expected and [r.place for r in read] == list(range(len(expected)))
    assert all(r.matrix == [[pytest.approx((r.w_start + k) * 2 / 4096)] for k in range(4)] for r in read)
    assert all((m.first_place, m.last_place) == (r[0].place, r[-1].place) for m in manifest for r in [[x for x in read if x.shard == m.shard]])
    none = writing.shuffled_windows(frames.limit(0), cuts, "s", Chain([]), ["Ball - position x"], 4, 3)
    assert writing.write_shards(none, f"file://{tmp_path}/none").count() == 0


def test_shards_are_written_by_few_tasks(spark, tmp_path):
    windows = spark.range(300).selectExpr("(id * 7) % 300 AS place").selectExpr("place", "place DIV 5 AS shard", "array(place) AS matrix")
    spark.sparkContext.setJobGroup("shards", "shards")
    manifest = sorted(writing.write_shards(windows, f"file://{tmp_path}/w").collect())
    spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("shards") for s in tracker.getJobInfo(j).stageIds]
    # 60 shards: only their listing, once, has as many tasks
    assert sum(s.numTasks >= 60 for s in stages if s) == 1
    assert [(m.shard, m.rows, m.first_place, m.last_place) for m in manifest] == [(k, 5, 5 * k, 5 * k + 4) for k in range(60)] and min(m.bytes for m in manifest) > 0
    assert [[r.place for r in spark.read.parquet(m.path).collect()] for m in manifest[::20]] == [list(range(m.first_place, m.last_place + 1)) for m in manifest[::20]]


def test_boundaries_are_recorded_with_their_frames(spark, tmp_path):
    from tellake.operators import segments

    def cut(frames):
        return segments.boundaries_json(segments.segment_boundaries(frames, "id", F.col("frame") == 2, 1), "id")

    store = incremental.Store(spark, f"file://{tmp_path}/s", "id", "long", FRAMES)
    incremental.run_pending(store, raw_rows(spark, [1, 2]), work([2]), boundaries=cut)
    incremental.run_pending(store, raw_rows(spark, [1, 2, 3]), work([]), boundaries=cut)
    got = {r.id: (r.parse_status, r.segment_boundaries) for r in store.state().collect()}
    assert got == {1: ("parsed", "[[0,2],[3,4]]"), 2: ("parsed", "[[0,2],[3,5]]"), 3: ("parsed", "[[0,2],[3,6]]")}
    assert tuple(store.result("run", 1).first())[:4] == (2, 2, 0, 0) and seen(store)[1] == want([1, 2, 3], [])[1]
