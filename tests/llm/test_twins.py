"""Registered queries of the operators against their SQL twins."""

import pytest
from compare import connect, differences

from gustline.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, folder, connection):
    names = [d[0] for d in connection.execute(f"DESCRIBE {ORACLES[name]}").fetchall()]
    assert differences(QUERIES[name](spark, folder).select(*names), ORACLES[name], connection) == []


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
