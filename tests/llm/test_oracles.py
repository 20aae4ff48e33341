"""The registered SQL against the queries, on whole tables."""

import duckdb
import pandas as pd
import pytest

from tellake.llm import queries

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, D).toPandas()
    want, got = (x.astype({c: 'float64' for c, t in x.dtypes.items() if str(t) == 'Int64'}) for x in (want, got))  # integers with NULLs
    columns = sorted(want.columns)
    assert columns == sorted(got.columns) and [str(t) for t in want[columns].dtypes] == [str(t) for t in got[columns].dtypes]
    a, b = (x[columns].sort_values("doc_id" if "doc_id" in columns else columns).reset_index(drop=True) for x in (want, got))
    pd.testing.assert_frame_equal(a, b, check_exact=True)
