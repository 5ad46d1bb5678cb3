"""Every registered query outside the training-data operators against its oracle, at the smallest scale."""

import glob
import math
import os

import duckdb
import pytest

from quiremill.plans import catalog

SF = "/root/testdata/sf0.001"


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    got = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in got.description]
    want = sorted(tuple(norm(dict(zip(names, r, strict=True))[c]) for c in sorted(names)) for r in got.fetchall())
    df = catalog.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(norm(r[c]) for c in sorted(names)) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
