import os
from pathlib import Path

import pytest

from folioforge.llm import queries as q

FOLDER = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")


@pytest.mark.parametrize("name,columns", [("p5_found", ["page_id", "line_no"]), ("p6_found", ["doc_id", "item_id"]), ("p7_shares", None), ("p8_found", ["doc_id"])])
def test_columns_and_rows(spark, name, columns):
    df = q.queries()[name](spark, str(FOLDER))
    assert columns is None or df.columns == columns
    assert df.count() >= 0


def test_first_query_of_the_mix_is_the_mix():
    assert next(n for n in q.queries() if n.startswith("p7_")) == "p7_mix"
