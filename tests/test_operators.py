"""Golden micro-fixtures."""

import pytest
from pyspark.sql import functions as F

from tellake.functions import paths
from tellake.operators import features, ledger, sampling, segments
from tellake.plans import registry
from tellake.plans.steps import Normalize, Select


def boundaries(spark, n, reset, least=10):
    df = spark.createDataFrame([(1, i, i in reset) for i in range(n)], "s int, frame long, r boolean")
    return sorted((r.seg_start, r.seg_end) for r in segments.segment_boundaries(df, "s", F.col("r"), least).collect())


@pytest.mark.parametrize(("n", "reset", "want"), [
    (100, (), [(0, 100)]), (9, (), []), (100, range(5), [(5, 100)]), (100, [*range(40, 45), *range(50, 53)], [(0, 40), (53, 100)]), (50, range(30, 50), [(0, 30)]), (50, range(50), []),
])
def test_segments(spark, n, reset, want):
    assert boundaries(spark, n, set(reset)) == want


@pytest.mark.parametrize(("seg", "size", "stride", "want"), [((10, 450), 128, 64, [10, 74, 138, 202, 266]), ((0, 127), 128, 64, []), ((0, 128), 128, 64, [0]), ((0, 10), 3, 5, [0, 5])])
def test_windows(spark, seg, size, stride, want):
    s = spark.createDataFrame([(1, *seg)], "s int, seg_start long, seg_end long")
    assert sorted(r.w_start for r in segments.window_index(s, size, stride).collect()) == want
    f = spark.range(seg[1]).select(F.lit(1).alias("s"), F.col("id").alias("frame"))
    got = sorted((r.w_start, r.frame) for r in segments.window_frames(f, s, "s", size, stride).collect())
    assert got == sorted((w, w + k) for w in want for k in range(size))


def test_window_arguments(spark):
    with pytest.raises(ValueError):
        segments.window_index(spark.createDataFrame([], "s int, seg_start long, seg_end long"), 0, 1)


def test_reset_predicate(spark):
    rows = [(0.0, 0.0, 0.0, 0.0), (-0.0, 0.0, 0.0, -0.0), (float("nan"), 0.0, 0.0, 0.0), (None, 0.0, 0.0, 0.0), (1.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "x double, y double, vx double, vy double")
    assert [r[0] for r in df.select(segments.is_reset("x", "y", "vx", "vy")).collect()] == [True, True, False, False, False]


def test_registry():
    for preset, raw, kept in (("standard", 166, 124), ("minimal", 103, 82), ("all", 319, 161)):
        names = registry.preset_columns(preset, 6)
        assert (len(names), len(registry.kept_positions(names))) == (raw, kept)
    assert [len(registry.select_columns(p)) for p in ("physics", "minimal", "full")] == [97, 48, 125]
    kept = {n for _, n in registry.kept_positions(registry.preset_columns("all", 1))}
    assert "Ball - rotation w" in kept and "Ball - rotation x" not in kept
    assert [registry.divisor(c) for c in ("Ball - linear velocity x", "p3_linear velocity x", "p0_boost level", "Ball - quaternion w", "p0_i position x")] == [6000, 2300, 255, None, 4096]


def test_steps(spark):
    df = spark.createDataFrame([(2048.0, None)], "`Ball - position x` double, other double")
    out = Normalize()(df)
    assert out.first()[0] == 0.5 and Normalize().inverse(out).first()[0] == 2048
    with pytest.raises(KeyError):
        Select.preset("physics")(df)
    with pytest.raises(ValueError):
        Normalize({"x": 0})


def test_quality(spark):
    df = spark.createDataFrame([(99, 5), (100, 5), (100000, 8), (100001, 5), (500, 1), (500, 2), (500, 9), (50, 1)], "n int, p int")
    got = [r[0] for r in df.select(features.verdict(F.col("n"), F.col("p"))).collect()]
    assert got == ["too few frames", "ok", "ok", "too many frames", "too few players", "ok", "too many players", "too few frames"]


def test_forward(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (0.1, 0.2, 0.3, 0.9), (0.0, 0.0, 0.0, 0.0)], "x double, y double, z double, w double")
    got = [r[0] for r in df.select(features.forward(*map(F.col, "xyzw"))).collect()]
    assert tuple(got[0]) == (0, 1, 0) and got[2] is None
    assert [round(v, 6) for v in got[1]] == [-0.526316, 0.789474, 0.315789]


def test_paths(spark):
    df = spark.createDataFrame([("RLCS 2024: Worlds",), ("Team/Name<Bad>",), (". a.b ..",)], "s string")
    assert [r[0] for r in df.select(paths.sanitize(F.col("s"))).collect()] == ["RLCS 2024_ Worlds", "Team_Name_Bad_", "a.b"]
    sizes = spark.createDataFrame([(1023,), (5000000,), (1500000000,)], "n long")
    assert [r[0] for r in sizes.select(paths.format_bytes(F.col("n"))).collect()] == ["1023 B", "4.77 MB", "1.40 GB"]


def test_sizes_halves_go_to_the_even_digit(spark):
    whole = 5 << 30
    numbers = [1024 + 128, 1024 + 384, 3 * 2**20 + 2**17, 3 * 2**20 + 7 * 2**17, whole + 2**27, whole + 3 * 2**27, 2**20 - 1, 7501799482976779177, None]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in numbers], "n long").select(paths.format_bytes(F.col("n"))).collect()]
    assert got[:-1] == ["1.12 KB", "1.38 KB", "3.12 MB", "3.88 MB", "5.12 GB", "5.38 GB", "1024.00 KB", "6986595208.73 GB"]
    assert got[-1] is None


def test_states(spark):
    df = spark.createDataFrame([(3, 0, 0), (2, 1, 0), (0, 2, 0), (0, 0, 0), (0, 1, 1)], "ok int, bad int, skip int")
    got = df.select(ledger.group_state(F.col("ok"), F.col("bad")), ledger.group_state(F.col("ok"), F.col("bad"), F.col("skip"))).collect()
    assert [r[0] for r in got[:4]] == ["complete", "partial", "failed", "complete"] and got[4][1] == "partial"


def test_upsert_keeps_nulls(spark):
    table = spark.createDataFrame([(1, "old", "b1"), (2, "old", "b2")], "k int, m string, b string")
    new = spark.createDataFrame([(1, None), (3, "new")], "k int, m string")
    assert sorted(map(tuple, ledger.upsert(table, new, "k", ["m"]).collect())) == [(1, None, "b1"), (2, "old", "b2"), (3, "new", None)]


def test_split(spark):
    ids = spark.range(1500)
    got = sampling.split_ids(ids, "id").collect()
    sizes = {s: sum(r.split == s for r in got) for s in ("train", "val", "test")}
    assert sizes == {"train": 1050, "val": 225, "test": 225}
    again = sampling.split_ids(ids.repartition(7).orderBy(F.desc("id")), "id").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_stream_drains_once(spark, tmp_path):
    from tellake.streaming.incremental import drain

    src, sink, check = (str(tmp_path / n) for n in ("src", "sink", "check"))
    spark.range(10).write.parquet(src)
    for _ in range(2):
        drain(spark, src, "id long", lambda df: df.withColumn("x", F.col("id") * 2), sink, check)
    assert spark.read.parquet(sink).count() == 10
