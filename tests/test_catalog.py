"""Every core query against its SQL twin on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

from skriftverk.plans import catalog


def normal(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, list):
        return tuple(map(normal, v))
    return v


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for f in os.listdir(small):
        c.sql(f"create view {f[:-8]} as select * from '{small}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_as_sql(spark, small, con, name):
    df = catalog.queries()[name](spark, small)
    r = con.sql(catalog.oracle_sql()[name])
    names = r.columns
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    a = sorted((tuple(normal(x[c]) for c in order) for x in df.collect()), key=repr)
    b = sorted((tuple(normal(dict(zip(names, x))[c]) for c in order) for x in r.fetchall()), key=repr)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql()) - {"experiment_table"}))
def test_runs(spark, small, name):
    assert catalog.queries()[name](spark, small).count() >= 0


def test_core_does_not_need_llm():
    code = "import sys; sys.modules['skriftverk.llm'] = None; import skriftverk.plans.catalog, skriftverk.streaming.dedup, skriftverk.sources.warc"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__)))).returncode == 0
