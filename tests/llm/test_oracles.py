"""Queries of the corpus operators that SQL can express agree with it."""

import harness
import pytest

from unitflow.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_agrees_with_its_oracle(spark, name, sf):
    at = f"/root/testdata/{sf}"
    names, got, want = harness.compare(spark, harness.connect(at), queries.queries()[name], queries.oracle_sql()[name], at)
    assert names
    assert got == want
