"""The training-data queries against their SQL on the smallest tables."""

import pytest

from postboard.llm import queries
from tests.compare import FOLDER, connect, of_duck, of_spark


@pytest.fixture(scope="module")
def duck():
    if not FOLDER.exists():
        pytest.skip("no tables")
    return connect()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, duck, name):
    assert of_spark(queries.QUERIES[name](spark, str(FOLDER))) == of_duck(duck, queries.SQL[name])
