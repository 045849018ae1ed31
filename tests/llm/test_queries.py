import os

import pytest

from siltworks import llm

from .. import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.DATA), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    oracle.check(spark, oracle.connect(), llm.queries()[name], llm.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(llm.queries()) - set(llm.oracle_sql())))
def test_query_runs(spark, name):
    rows = llm.queries()[name](spark, oracle.DATA)
    assert rows.count() > 0 or name == "op8_secret_scan"  # these tables hold no secret
