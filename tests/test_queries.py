"""Every query with an oracle gives the oracle's rows; plans have no Python and no cartesian product."""

import math

import duckdb
import pytest

from tellake import queries as q

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return con


def plain(v):
    return ("nan" if math.isnan(v) else repr(round(v, 9) + 0.0)) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_oracle(spark, db, name):
    df = q.queries()[name](spark, D)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = db.execute(q.oracle_sql()[name])
    names = [x[0] for x in rel.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["segment_boundaries", "window_index", "window_frames", "normalize", "pending_anti", "event_fold", "ledger_fold", "entity_layout", "locate_parsed", "locate_raw", "stored_windows", "mark_failed", "first_seen", "player_mapping", "json_flatten_all", "batch_report"])
def test_plan(spark, name):
    plan = q.queries()[name](spark, D)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_segment_scan_is_pruned(spark):
    plan = q.queries()["segment_boundaries"](spark, D)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan.split("ReadSchema")[1][:200]
