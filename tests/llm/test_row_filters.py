"""The pipeline's filters on rows with null and repeated ids."""

import re
from collections import Counter

from pyspark.sql import functions as F

from tellake.llm import decontaminate, jaccard_join

LEAK = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
CLEAN = "some quite different words that no item of the benchmark has at all"
COPY = "one two three four five six seven eight nine ten eleven twelve"
SCHEMA = "doc_id long, text string"


def shingles(s, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (s or "").lower())
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def test_contaminated_rows_go_and_clean_rows_stay(spark):
    rows = [(1, CLEAN), (1, f"see {LEAK}"), (None, LEAK), (None, CLEAN), (2, None), (3, f"{CLEAN} {LEAK}"), (3, CLEAN)]
    bench = spark.createDataFrame([(1, LEAK)], "item_id long, text string")
    got = decontaminate.without_contaminated(spark.createDataFrame(rows, SCHEMA), bench).collect()
    assert Counter(map(tuple, got)) == Counter(r for r in rows if LEAK not in (r[1] or ""))


def test_one_row_of_each_group(spark):
    rows = [(5, COPY), (5, COPY), (None, COPY), (7, COPY), (None, CLEAN), (None, CLEAN), (8, LEAK), (8, COPY + " more"), (9, None), (9, None), (None, ""), (6, LEAK + " nu")]
    sets = [shingles(s) for _, s in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    best = {}
    for k, (i, _) in enumerate(rows):
        best[root[k]] = min(best.get(root[k], (True, 0, 0)), (i is None, i or 0, k)) if root[k] in best else (i is None, i or 0, k)
    want = Counter(rows[k] for _, _, k in best.values())
    got = jaccard_join.one_per_component(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert Counter(map(tuple, got)) == want and len(got) == 6


CLASHING = ("__row", "__ROW_", "a.b", "doc", "block", "component_id", "n_hit", "row", "spot", "tick`s")


def clashing(df):
    for k, name in enumerate(CLASHING):
        df = df.withColumn(name, F.lit(k) if k % 2 else F.col("doc_id"))
    return df


def test_columns_of_any_name_come_back_as_they_were(spark):
    rows = [(5, COPY), (6, COPY), (7, LEAK), (None, CLEAN), (8, None)]
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    bench = spark.createDataFrame([(1, LEAK)], "item_id long, text string")
    want = {r.doc_id: tuple(r) for r in df.collect()}
    for got, ids in ((decontaminate.without_contaminated(df, bench), {5, 6, None, 8}), (jaccard_join.one_per_component(df), {5, 7, None, 8})):
        assert got.columns == df.columns
        assert {r.doc_id: tuple(r) for r in got.collect()} == {i: want[i] for i in ids}
    assert decontaminate.without_contaminated(df.limit(0), bench).count() == 0 and jaccard_join.one_per_component(df.limit(0)).columns == df.columns
