"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    # what SQL cannot express is tested next to its operator: subwords in test_merges.py by hand and against the library
    assert all(name.startswith("op") or name in ("pipeline", "tokenize_merges") for name in set(QUERIES) - set(ORACLE))


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "epoch", "step", "micro_batch", "rank", "input_ids", "attention_mask", "labels",
    ]
    assert result.count() > 0
