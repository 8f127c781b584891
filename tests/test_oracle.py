"""Every core query with SQL gives the rows of its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from corpusmill.plans import registry


def rows(df):
    out = []
    df = df[sorted(df.columns)]
    for r in df.itertuples(index=False):
        out.append(tuple(None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(map(repr, (tuple(x.item() if hasattr(x, "item") else x for x in r) for r in out)))


@pytest.fixture(scope="module")
def con(tiny):
    c = duckdb.connect()
    for name in os.listdir(tiny):
        c.execute(f"create view {name.split('.')[0]} as select * from '{tiny}/{name}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows(spark, tiny, con, name):
    got = registry.QUERIES[name](spark, tiny).toPandas()
    want = con.execute(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, tiny, name):
    assert registry.QUERIES[name](spark, tiny).collect()


def test_evaluation_overlap_is_there(spark, tiny):
    folder = tiny.replace("sf0.001", "sf0.01")
    assert registry.QUERIES["decontam"](spark, folder).count() > 0
    assert sum(r.contaminated for r in registry.QUERIES["corpus_report"](spark, folder).collect()) > 0
