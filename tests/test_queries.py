"""Every registered query of the observatory's operators against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from skyledger.plans import queries as plans

SF = os.environ.get("SKYLEDGER_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, name):
    df = plans.QUERIES[name](spark, SF)
    got = sorted(repr([r[c] for c in sorted(df.columns)]).replace(", tzinfo=datetime.timezone.utc", "") for r in df.collect())
    assert got
    if name in plans.ORACLE_SQL:
        con = duckdb.connect()
        for t in os.listdir(SF):
            con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
        res = con.execute(plans.ORACLE_SQL[name])
        names = [d[0] for d in res.description]
        assert sorted(names) == sorted(df.columns)
        at = [names.index(c) for c in sorted(names)]
        assert got == sorted(repr([r[i] for i in at]) for r in res.fetchall())
