import pytest

from marquee.llm import queries as llm
from tests.oracle import compare, duck


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    r = compare(spark, name, llm.queries()[name], llm.oracle_sql()[name], folder, duck(folder))
    assert r["exact"], r
