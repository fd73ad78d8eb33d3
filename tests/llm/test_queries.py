"""The registered queries with SQL twins, on the small table."""

from __future__ import annotations

import pytest

from oracle_check import compare
from tracewise.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    status, detail = compare(spark, "/root/testdata/sf0.001", [name], verbose=False)[name]
    assert status == "OK", detail


def test_every_operator_has_a_query():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in names if q.startswith("op") and q[2].isdigit()}
    assert set(queries.ORACLES) <= set(queries.QUERIES)
