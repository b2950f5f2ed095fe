"""Queries of the corpus operators against their SQL."""

import pytest

from edgeworks.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, sf_dir, duck, name):
    df = queries.QUERIES[name](spark, sf_dir)
    found = duck.execute(queries.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(tuple(r[names.index(c)] for c in df.columns) for r in found.fetchall())
    assert sorted(tuple(r) for r in df.collect()) == want and want
