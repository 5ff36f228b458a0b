"""Every catalogue query runs on sf0.001; SQL-expressible ones equal their
DuckDB oracle (row count, columns, values)."""

import duckdb
import pytest

from kestrel.plans.registry import load_all
from kestrel.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"
REG = load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


def _canon(pdf):
    import math
    import pandas as pd
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or v is pd.NA:
            return None
        if isinstance(v, (list, tuple)) or (hasattr(v, "tolist") and getattr(v, "ndim", 0) > 0):
            return tuple(norm(x) for x in list(v))
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    return cols, sorted((tuple(norm(v) for v in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(REG))
def test_query(spark, con, name):
    q = REG[name]
    sp = q.fn(spark, SF).toPandas()
    if not q.sql:
        assert len(sp) > 0
        return
    dk = con.sql(q.sql).df()
    c1, r1 = _canon(sp)
    c2, r2 = _canon(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
