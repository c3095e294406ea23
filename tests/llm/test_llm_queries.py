"""The registered queries against their SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check_oracle import connect, differs  # noqa: E402

from clicksieve.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, data, name):
    result = QUERIES[name](spark, data("0.001")).toPandas()
    assert differs(result, connect(data("0.001")).execute(ORACLE[name]).df()) is None
    assert len(result)


def test_all_operators_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
