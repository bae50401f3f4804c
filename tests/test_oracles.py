"""Every registered query against its SQL, as multisets of whole rows."""

import datetime
from collections import Counter

import pytest

import __spark_entry__ as contract

#: Queries of the llm subpackage have tests of their own.
LLM = ("op", "pipeline")
ORACLES = contract.oracle_sql()


def normal(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return repr(value)
    return value


def as_counter(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert all(q in ORACLES for q in contract.queries() if not q.startswith(LLM))
    assert set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = contract.queries()[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(result.columns)
    want = as_counter(names, expected.fetchall())
    got = as_counter(result.columns, [tuple(r) for r in result.collect()])
    missing, extra = want - got, got - want
    assert not missing and not extra, (
        f"{sum(missing.values())} missing, e.g. {list(missing)[:3]}; "
        f"{sum(extra.values())} extra, e.g. {list(extra)[:3]}"
    )
    assert want


def test_entry(spark):
    assert contract.entry(spark).count() == 10
