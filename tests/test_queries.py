"""Each registered query against its SQL, whole results."""

import pytest

from __spark_entry__ import entry
from check_oracle import connect, differs
from clicksieve.plans.catalogue import QUERIES
from clicksieve.plans.oracle import ORACLE


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 124
    assert df.columns[:5] == ["user_id", "event_id", "invited", "time_stamp", "interested"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, data, name):
    folder = data("0.001")
    result = QUERIES[name](spark, folder).toPandas()
    assert differs(result, connect(folder).execute(ORACLE[name]).df()) is None
    assert len(result)
