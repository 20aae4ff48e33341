"""Path rules of loading, parsing and backfill on one listing, and trees of any depth."""

import pytest
from pyspark.sql import functions as F

from tellake.functions import paths

LISTED = ["/cache/a.parquet", "/abs/b.parquet", "/data/x/c.parquet", "/data/d.parquet", "/data/e.parquet", "/raw/k/f.replay", "/raw/g.replay", "/raw/deep/er/h.replay", "/raw/deep/aa/h.replay", "/raw/h2.replay"]


@pytest.fixture
def listing(spark):
    return spark.createDataFrame([(("file:" if k % 2 else "") + p,) for k, p in enumerate(LISTED)], "path string")


def found(df):
    return {r.id: (r.path, r.rule) for r in df.collect()}


def test_loading_rules(spark, listing):
    wanted = spark.createDataFrame([("a", "/abs/b.parquet"), ("b", "/abs/b.parquet"), ("c", "x/c.parquet"), ("d", "gone/d.parquet"), ("e", "/gone/e.parquet"), ("z", "z.parquet"), ("n", None)], "id string, output string")
    got = found(paths.locate_parsed(wanted, listing, "id", "output", data_dir="/data/", cache_dir="/cache"))
    assert got == {"a": ("/cache/a.parquet", "0"), "b": ("/abs/b.parquet", "1"), "c": ("/data/x/c.parquet", "2"), "d": ("/data/d.parquet", "3"), "e": (None, None), "z": (None, None), "n": (None, None)}
    stored = found(paths.locate_parsed(wanted, listing, "id", "output", bucket="b"))
    assert stored["a"] == ("/abs/b.parquet", "0") and stored["c"] == ("s3://b/x/c.parquet", "otherwise") and stored["e"] == ("s3://b//gone/e.parquet", "otherwise") and stored["n"] == (None, None)


def test_raw_rules(spark, listing):
    wanted = spark.createDataFrame([("f", "k/f.replay"), ("g", "k/g.replay"), ("h", None), ("h", None), ("h2", ""), ("q", "k/q.replay")], "id string, stored string")
    got = found(paths.locate_raw(wanted, listing, "id", "stored", "/raw"))
    assert got == {"f": ("/raw/k/f.replay", "0"), "g": ("/raw/g.replay", "1"), "h": ("/raw/deep/aa/h.replay", "anywhere"), "h2": ("/raw/h2.replay", "1"), "q": (None, None)}


def test_backfill_rules(spark, listing):
    wanted = spark.createDataFrame([("b", "/abs/b.parquet"), ("c", "x/c.parquet"), ("q", "gone/d.parquet"), ("e", "/gone/other.parquet"), ("z", "z/z.parquet")], "id string, output string")
    got = found(paths.locate_for_backfill(wanted, listing, "id", "output", "/data"))
    assert got == {"b": ("/abs/b.parquet", "0"), "c": ("/data/x/c.parquet", "1"), "q": ("/data/d.parquet", "2"), "e": ("/data/e.parquet", "3"), "z": (None, None)}
    assert found(paths.locate_for_backfill(wanted, listing, "id", "output", None, "b"))["z"] == ("s3://b/z/z.parquet", "otherwise")
    assert found(paths.locate_for_backfill(wanted, listing.limit(0), "id", "output", "/data"))["b"] == (None, None)


def test_resolve_drops_misses(spark, listing):
    wanted = spark.createDataFrame([("d",), ("z",)], "id string")
    got = paths.resolve(wanted, listing, "id", [F.concat(F.lit("/data/"), "id", F.lit(".parquet"))]).collect()
    assert [tuple(r) for r in got] == [("d", "/data/d.parquet")]


def test_tree_paths_reach_every_depth(spark):
    groups = spark.createDataFrame([(k, k - 1 if k else None, f"g{k}") for k in range(22)], "id long, parent_id long, name string")
    leaves = spark.createDataFrame([(k, k) for k in range(22)], "leaf_id long, group_id long")
    got = {r.leaf_id: r.path for r in paths.tree_paths(groups, leaves).collect()}
    assert got == {k: [f"g{j}" for j in range(k + 1)] for k in range(22)}
