"""Loading with missing, broken, cut off and foreign files; metadata in layers; ingest through a decoder."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tellake.sources import frames, loading

SCHEMA = "frame long, v double"


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    at = tmp_path_factory.mktemp("series")
    table = pa.table({"frame": pa.array(range(100), pa.int64()), "v": pa.array([float(k) for k in range(100)])})
    for name in ("good", "sub/nested", "late"):
        (at / name).parent.mkdir(exist_ok=True)
        pq.write_table(table, at / f"{name}.parquet", row_group_size=50)
    (at / "broken.parquet").write_bytes(b"this is no parquet")
    cut = bytearray((at / "good.parquet").read_bytes())
    first = pq.read_metadata(at / "good.parquet").row_group(1).column(1).data_page_offset
    cut[first : first + 40] = bytes(x ^ 255 for x in cut[first : first + 40])
    (at / "damaged.parquet").write_bytes(bytes(cut))
    pq.write_table(pa.table({"z": pa.array([1.0] * 5)}), at / "foreign.parquet")
    pq.write_table(pa.table({"frame": pa.array(["a"] * 5), "v": pa.array([1.0] * 5)}), at / "typed.parquet")
    return at


@pytest.fixture(scope="module")
def catalogue(spark, root):
    rows = [("good", "good.parquet"), ("nested", "x/nested.parquet"), ("late", f"{root}/late.parquet"), ("deep", "sub/nested.parquet"), ("broken", "broken.parquet"), ("damaged", "damaged.parquet"),
            ("foreign", "foreign.parquet"), ("typed", "typed.parquet"), ("missing", "missing.parquet"), ("unknown", None), (None, "good.parquet"), ("good", "good.parquet")]
    return spark.createDataFrame(rows, "replay_id string, output_path string").selectExpr("*", "1 AS path", "'x' AS rows")


def test_good_series_and_errors(spark, root, catalogue):
    got = loading.load_series(spark, catalogue, f"file://{root}", SCHEMA)
    counts = {r[0]: (r.n, r.s) for r in got.frames.groupBy("replay_id").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()}
    assert counts == {k: (100, 4950.0) for k in ("good", "late", "deep")} and sorted(got.frames.columns) == ["frame", "replay_id", "v"]
    errors = {r.replay_id: r.error for r in got.errors.collect()}
    assert errors == {"nested": "file not found", "broken": "unreadable, or without rows", "damaged": "damaged: 50 of 100 rows can be read", "foreign": "no values of frame", "typed": "damaged: 0 of 5 rows can be read", "missing": "file not found", "unknown": "file not found"}
    sizes = {r.replay_id: (r.rows, r.bytes) for r in got.report.collect()}
    assert sizes["good"] == (100, (root / "good.parquet").stat().st_size) and len(sizes) == 10


def test_one_sample_and_iteration(spark, root, catalogue):
    at = f"file://{root}"
    assert loading.load_one(spark, catalogue, "good", at, SCHEMA).count() == 100
    assert all(loading.load_one(spark, catalogue, k, at, SCHEMA) is None for k in ("broken", "damaged", "missing", "unknown", "nobody"))
    assert loading.load_one(spark, catalogue, "good", "file:///no/such/folder", SCHEMA) is None
    sample = loading.load_sample(spark, catalogue.filter("replay_id is not null"), at, SCHEMA, n=100)
    assert [(k, f.count()) for k, f in sample] == [("deep", 100), ("good", 100), ("late", 100)]
    few = loading.load_sample(spark, catalogue.filter("replay_id is not null"), at, SCHEMA, n=4, seed=7)
    again = loading.load_sample(spark, catalogue.filter("replay_id is not null").orderBy(F.desc("replay_id")), at, SCHEMA, n=4, seed=7)
    assert few.report.count() == 4 and sorted(r[0] for r in few.report.collect()) == sorted(r[0] for r in again.report.collect())
    assert [sorted(r[0] for r in b.select("replay_id").distinct().collect()) for b in sample.batches(2)] == [["deep", "good"], ["late"]]
    nothing = loading.load_series(spark, catalogue.limit(0), at, SCHEMA)
    assert nothing.frames.count() == 0 and nothing.errors.count() == 0 and list(nothing) == [] and list(nothing.batches()) == []


def test_metadata_in_layers(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.metadata.json").write_text(json.dumps({"map": "side", "n": {"k": 1}}, indent=2))
    (tmp_path / "d" / "b.metadata.json").write_text("[1, 2")
    rows = [("a", 5, '{"map": "stored", "fps": 30, "only": null}'), ("b", None, '{"map": "stored"}'), ("c", 7, "not json"), ("d", 8, None), ("e", 9, "[1]")]
    table = spark.createDataFrame(rows, "replay_id string, frame_count long, metadata string")
    side = loading.read_sidecars(spark, f"file://{tmp_path}")
    got = {r[0]: r[1] for r in loading.series_metadata(table, ["replay_id", "frame_count"], sidecars=side).collect()}
    assert got["a"] == {"replay_id": "a", "frame_count": "5", "map": "side", "fps": "30", "only": None, "n": '{"k":1}'}
    assert got["b"] == {"replay_id": "b", "frame_count": None, "map": "stored"}
    assert got["c"] == {"replay_id": "c", "frame_count": "7"} and got["d"] == {"replay_id": "d", "frame_count": "8"} and got["e"] == {"replay_id": "e", "frame_count": "9"}
    assert loading.read_sidecars(spark, "file:///no/such/folder").count() == 0


def test_ingest_states_every_failure(spark, tmp_path):
    def decoder(content):
        import numpy as np

        text = content.decode()
        if text == "boom":
            raise RuntimeError("bad magic")
        shapes = {"none": None, "flat": np.zeros(3), "cube": np.zeros((2, 2, 2)), "no rows": np.zeros((0, 4)), "no columns": np.zeros((3, 0)), "ragged": [[1.0], [1.0, 2.0]], "lists": [[1, 2], [3, 4], [5, 6]]}
        return {"kind": text}, shapes.get(text, np.arange(6.0).reshape(3, 2))

    kinds = ["fine", "lists", "boom", "none", "flat", "cube", "no rows", "no columns", "ragged"]
    (tmp_path / "deep").mkdir()
    for k, text in enumerate(kinds):
        (tmp_path / ("deep" if k % 2 else ".") / f"r{k}.replay").write_text(text)
    wanted = spark.createDataFrame([(f"r{k}", None) for k in range(len(kinds))] + [("gone", "gone.replay"), (None, "x")], "replay_id string, storage_key string")
    series, outcomes = frames.ingest(spark, wanted, f"file://{tmp_path}", decoder)
    got = {r.replay_id: (r.ok, r.error, r.num_frames, r.num_features) for r in outcomes.collect()}
    assert got == {
        "r0": (True, None, 3, 2), "r1": (True, None, 3, 2), "r2": (False, "Parsing failed: bad magic", -1, -1), "r3": (False, "Parsing returned None", 0, 0), "r4": (False, "Expected 2D array, got 1D", 3, 0),
        "r5": (False, "Expected 2D array, got 3D", 2, 0), "r6": (False, "Array has zero frames or features", 0, 4), "r7": (False, "Array has zero frames or features", 3, 0), "r8": (False, "Rows of different lengths", 2, 0),
        "gone": (False, "File not found: gone", -1, -1),
    }
    assert sorted((r.replay_id, r.frame, r["values"]) for r in series.collect()) == sorted([("r0", k, [2.0 * k, 2.0 * k + 1]) for k in range(3)] + [("r1", k, [2.0 * k + 1, 2.0 * k + 2]) for k in range(3)])
    assert json.loads(outcomes.filter("replay_id = 'r6'").first().metadata) == {"kind": "no rows"}
    none, lost = frames.ingest(spark, wanted, "file:///no/such/folder", decoder)
    assert none.count() == 0 and {r.error for r in lost.collect()} == {f"File not found: r{k}" for k in range(9)} | {"File not found: gone"}


def test_decoded_rows_of_any_iterable(spark):
    import numpy as np

    from tellake.sources import frames

    def decoder(content):
        shape = content.decode()
        rows = {"list": [[1, 2.5], [float("nan"), True]], "lazy": ([float(i), -1.0] for i in range(3)), "array": np.arange(6, dtype=np.int16).reshape(2, 3), "flat": [1.0], "deep": [[[1.0]]], "uneven": [[1.0], [1.0, 2.0]], "none": [], "text": ["ab"]}
        return {"of": shape}, rows[shape]

    names = ["list", "lazy", "array", "flat", "deep", "uneven", "none", "text"]
    files = spark.createDataFrame([(n, bytearray(n.encode())) for n in names] + [("gone", None)], "path string, content binary").repartition(3)
    got = frames.decode(files, decoder).collect()
    assert {r.path: (r.ok, r.error, r.num_frames, r.num_features) for r in got if r.frame is None} == {
        "list": (True, None, 2, 2), "lazy": (True, None, 3, 2), "array": (True, None, 2, 3), "flat": (False, "Expected 2D array, got 1D", 1, 0), "deep": (False, "Expected 2D array, got 3D", 1, 0),
        "uneven": (False, "Rows of different lengths", 2, 0), "none": (False, "Array has zero frames or features", 0, 0), "text": (False, "Expected 2D array, got 1D", 1, 0), "gone": (False, "File not found: gone", -1, -1)}
    held = {(r.path, r.frame): str(r["values"]) for r in got if r.frame is not None}
    assert held == {("list", 0): "[1.0, 2.5]", ("list", 1): "[nan, 1.0]", **{("lazy", i): f"[{i}.0, -1.0]" for i in range(3)}, ("array", 0): "[0.0, 1.0, 2.0]", ("array", 1): "[3.0, 4.0, 5.0]"}
    assert all(r["values"] is None and r.metadata == f'{{"of": "{r.path}"}}' for r in got if r.frame is None and r.path != "gone")
