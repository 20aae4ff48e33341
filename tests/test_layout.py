"""Long layout of frames of mixed player counts, and 32-bit casts."""

import math

import pytest
from pyspark.sql import functions as F

from tellake.operators import features
from tellake.plans import registry


@pytest.mark.parametrize("preset", ["standard", "minimal", "all"])
def test_every_value_as_in_the_wide_layout(spark, preset):
    rows = []
    for n in (1, 2, 4, 6, 8):
        names = registry.preset_columns(preset, n)
        rows.append((f"r{n}", 0, n, [float(n * 1000 + k) for k in range(len(names))]))
    df = spark.createDataFrame(rows, "replay_id string, frame int, players int, values array<double>")
    long = {(r.replay_id, r.entity): r for r in features.entity_frames(df, ["replay_id", "frame"], "players", preset=preset).collect()}
    assert len(long) == sum(n + 1 for n in (1, 2, 4, 6, 8))
    for rid, _, n, values in rows:
        wide = {name: values[at] for at, name in registry.kept_positions(registry.preset_columns(preset, n))}
        got = {}
        for entity in ["ball", *(f"p{i}" for i in range(n))]:
            r = long[rid, entity].asDict()
            prefix = registry.BALL if entity == "ball" else f"{entity}_"
            got.update({prefix + c: v for c, v in r.items() if v is not None and prefix + c in wide})
            got.update({c: v for c, v in r.items() if c in wide})
        assert got == wide


def test_odd_counts_and_poses(spark):
    n = len(registry.preset_columns("standard", 2))
    nan = float("nan")
    whole = [float(k) for k in range(n)]
    holed = list(whole)
    at = {name: k for k, name in registry.kept_positions(registry.preset_columns("standard", 2))}
    holed[at["Ball - position y"]] = nan
    holed[at["p1_quaternion w"]] = nan
    df = spark.createDataFrame([("a", 2, holed), ("b", 0, whole), ("c", None, whole), ("d", 2, whole[:30]), ("e", 2, None)], "id string, players int, values array<double>")
    long = features.entity_frames(df, ["id"], "players")
    got = {(r.id, r.entity): r for r in features.entity_poses(long, ["id"]).collect()}
    assert {k for k in got if k[0] in "bc"} == {("b", "ball"), ("c", "ball")}
    assert got["a", "ball"].position is None and tuple(got["b", "ball"].position) == tuple(whole[at[f"Ball - position {x}"]] for x in "xyz")
    assert got["a", "p0"].forward is not None and got["a", "p1"].forward is None and got["a", "ball"].forward is None
    assert tuple(got["a", "p1"].position) == tuple(holed[at[f"p1_position {x}"]] for x in "xyz")
    x, y, z, w = (holed[at[f"p0_quaternion {a}"]] for a in "xyzw")
    norm = x * x + y * y + z * z + w * w
    assert math.isclose(got["a", "p0"].forward.x, 2 * (x * y - z * w) / norm)
    assert got["d", "p1"].position is None and got["e", "p0"].position is None


def test_float32(spark):
    df = spark.createDataFrame([("a", 0.1, 3)], "id string, `x y` double, n int")
    assert features.float32(df).dtypes == [("id", "string"), ("x y", "float"), ("n", "float")]
    assert features.float32(df, ["x y"]).dtypes == [("id", "string"), ("x y", "float"), ("n", "int")]


def test_expected_count():
    for preset in registry.PARSE_PRESETS:
        for n in (0, 1, 6):
            assert registry.expected_count(*registry.PARSE_PRESETS[preset], n) == len(registry.preset_columns(preset, n))
    with pytest.raises(KeyError):
        registry.expected_count(["NoSuchGroup"], [], 1)


def test_window_frames_meet_few_segments(spark):
    """A series of many segments: the join gives two rows a frame at most, before the filter."""
    from tellake.operators import segments

    cuts = spark.range(2000).select(F.lit(1).alias("s"), (F.col("id") * 6).alias("seg_start"), (F.col("id") * 6 + 5).alias("seg_end"))
    frames = spark.range(12000).select(F.lit(1).alias("s"), F.col("id").alias("frame"))
    out = segments.window_frames(frames, cuts, "s", 4, 1)
    assert out.count() == 2000 * 2 * 4 and "Nested" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.filter("frame < w_start or frame >= w_start + 4 or w_start < seg_start or w_start + 4 > seg_end").isEmpty()
