"""Every registered query against its DuckDB statement (as the driver checks it)."""

import pytest

import __spark_entry__ as E
from check_oracle import canon, duck
from conftest import SF_SMALL
from slotflow.plans.registry import ORACLE, QUERIES



def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) > 5
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_lines, s_hash = canon(df.columns, [tuple(r) for r in df.collect()])
    d_cols, d_rows = duck(SF_SMALL, ORACLE[name])
    o_cols, o_lines, o_hash = canon(d_cols, d_rows)
    assert s_cols == o_cols
    assert len(s_lines) == len(o_lines)
    assert s_hash == o_hash, [(a, b) for a, b in zip(s_lines, o_lines) if a != b][:3]
