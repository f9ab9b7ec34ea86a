"""Every registered query against its DuckDB oracle at sf0.001 (rows,
column names, order-insensitive values)."""

import pytest

from driftcast.plans.registry import registry
from tests.conftest import SF_SMALL
from tests.helpers import rows_of

REG = registry()


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, duck, name):
    fn, sql = REG[name]
    df = fn(spark, SF_SMALL)
    tbl = df.toArrow()
    srows = [tuple(r[c] for c in tbl.column_names) for r in tbl.to_pylist()]
    if sql is None:
        assert srows is not None
        return
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall())
