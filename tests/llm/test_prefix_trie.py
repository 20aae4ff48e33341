"""The trie of conversations against a plain dictionary of prefixes, for any number of tasks."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tellake.llm import prefix_trie, queries

D = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - (c - 20 * int(c / 20)), [])[:h] + turns[h:]
    return out


def brute(sequences):
    nodes = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for key in nodes:
        if key:
            kids[key[:-1]] = kids.get(key[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for key, members in nodes.items():
        add = (len(members) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            leaves[key[:d]] += key not in kids
            saved[key[:d]] += add
    out = []
    for key, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(sequences[c]) == len(key))))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else -1, len(members), kids.get(key, 0), leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


@pytest.fixture
def many_tasks(monkeypatch):
    """Tasks of a few turns each, so that borders run through everything."""
    monkeypatch.setattr(prefix_trie, "TASK_TURNS", 40)
    monkeypatch.setattr(prefix_trie, "LEAST_TURNS", 4)


def test_query_against_a_dictionary(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{D}/conversations.parquet").collect()]
    assert got(queries.op11_prefix_trie(spark, D)) == brute(rebuilt(rows))


def odd_rows(seed):
    rng = random.Random(seed)
    rows = [(None, 0, "user", "no id"), (20, None, None, None), (20, 0, "user", "hi"), (20, 0, "user", "hi"), (-3, 5, "user", "hi"), (-40, 1, None, "x y"), (7, 1, "user", "alone"), (41, 0, "", ""), (42, 0, None, "")]
    for c in range(100, 220):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", "a longer turn of words", None, "é  è"]) if t else "hello"))
    for c in range(300, 360):  # copies, and one long common beginning
        rows += [(c, t, "user", f"turn {t}") for t in range(12 if c % 3 else 12 + c % 7)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows_in_many_tasks(spark, many_tasks, seed):
    rows = odd_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "'x' AS own", "2 AS n_convs", "3 AS `a.b`")
    assert got(prefix_trie.prefix_trie(df)) == brute(rebuilt(rows))


def test_one_task_and_empty(spark):
    rows = odd_rows(3)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie.prefix_trie(df.coalesce(1))) == brute(rebuilt(rows))
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0
    assert prefix_trie.prefix_trie(df.filter("conv_id is null")).count() == 0


def test_long_conversation(spark):
    rows = [(1, t, "user", f"word {t % 7}") for t in range(5000)] + [(2, t, "user", f"word {t % 7}") for t in range(4000)] + [(3, 0, "user", "word 0 " * 200000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {(r.depth, r.n_convs): r for r in prefix_trie.prefix_trie(df).collect()}
    assert len(out) == len(brute_depths(rows)) and out[0, 3].n_children >= 1


def brute_depths(rows):
    s = rebuilt(rows)
    return {(d, sum(tuple(t[:d]) == tuple(s[c][:d]) for t in s.values() if len(t) >= d)) for c in s for d in ((0, len(s[c])) if len(s[c]) < 3 else range(len(s[c]) + 1))}


@pytest.mark.parametrize("seed", range(4))
def test_handles_and_exits(seed):
    """Every node is found under its two-fattest handle alone, and exits are the deepest prefixes."""
    rng = random.Random(seed)
    strings = [[rng.randrange(2) for _ in range(rng.randrange(0, 40))] for _ in range(80)]
    strings += [s[: len(s) // 2] + [9] * rng.randrange(9) for s in strings]
    strings = [list(t) for t in dict.fromkeys(map(tuple, strings))]

    def hashes(s):
        return [0] + [int.from_bytes(hashlib.md5(str(s[:d]).encode()).digest()) for d in range(1, len(s) + 1)]

    trie, extents = prefix_trie.ZFastTrie(), set()
    for at in range(0, len(strings), 16):
        ends = trie.insert([(at + k, hashes(s)) for k, s in enumerate(strings[at : at + 16])])
        assert [trie.depth[e] for e in ends] == [len(s) for s in strings[at : at + 16]]
    for v in range(1, len(trie.up)):
        a, b = trie.depth[trie.up[v]], trie.depth[v]
        f = max(range(a + 1, b + 1), key=lambda x: x & -x)
        assert prefix_trie.two_fattest(a, b) == f and trie.handles[trie.prefixes[v][f]] == v
        assert trie.string[v] >= 0 or len(trie.kids[v]) > 1
        extents.add(trie.prefixes[v][b])
    assert len(trie.handles) == len(trie.up) - 1
    for s in strings + [[rng.randrange(2) for _ in range(30)] for _ in range(100)]:
        h = hashes(s)
        assert trie.depth[trie.exit(h)] == max(d for d in range(len(h)) if not d or h[d] in extents)


def test_prefix_hashes():
    import numpy as np

    values = np.array([5, 6, 7, 5, 6], np.int64)
    h = prefix_trie.prefix_hashes(values, np.array([3, 0, 2]), 9)
    assert len(h) == 8 and h[0] == h[4] == h[5] == 0 and (h[1:3] == h[6:8]).all() and len(set(h[:4].tolist())) == 4


def test_no_python_before_the_sequences(spark):
    turns = prefix_trie.turns_of(spark.read.parquet(f"{D}/conversations.parquet"), "conv_id", "turn", "role", "text")
    plan = prefix_trie.with_shared_starts(turns)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert prefix_trie.with_shared_starts(turns).agg(F.count("*")).first()[0] == turns.count()
