"""Every registered text query that has SQL, against it, on the smallest tables."""

import oracle_compare
import pytest
from cases import SF

from orderloom.llm.oracles import ORACLES
from orderloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert oracle_compare.compare(spark, oracle_compare.connect(SF), SF, name, QUERIES[name], ORACLES[name]) == ""
