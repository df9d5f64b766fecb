import pytest
from compare import connect, differences

from anchorline.llm.queries import ORACLES, QUERIES
from conftest import SMALL


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_its_oracle(spark, name):
    found = differences(spark, connect(SMALL), name, QUERIES[name], ORACLES[name], SMALL)
    assert not found["only_spark"] and not found["only_oracle"]
    assert found["rows"] == found["oracle_rows"]
    assert set(found["types"]) <= {"score"}  # one double, named differently by the engines
