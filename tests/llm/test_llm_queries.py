"""The registered queries: names, and those that SQL can express against their SQL on whole tables."""

import re

import __spark_entry__ as entry_points
import pytest
from parity import compare, connect

from velomet.llm.queries import ORACLE_SQL, QUERIES


def test_names():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= entry_points.queries().keys()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_against_sql(spark, name, size):
    base = f"/root/testdata/{size}"
    assert compare(QUERIES[name](spark, base), connect(base), ORACLE_SQL[name]) == []
