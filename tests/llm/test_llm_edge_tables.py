import os
from pathlib import Path

import pytest

from edge_tables import write
from folioforge.llm import queries as q

FOLDER = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")


@pytest.mark.parametrize("kind", ["empty", "nulls", "clashing"])
def test_queries_on_odd_tables(spark, tmp_path, kind):
    folder = write(spark, FOLDER, tmp_path, kind)
    for name in ("p5_found", "p5_main", "p6_found", "p7_mix", "p8_found"):
        rows = q.queries()[name](spark, folder).collect()
        if kind == "empty":
            assert rows == []
        elif kind == "clashing":
            assert sorted(map(str, rows)) == sorted(map(str, q.queries()[name](spark, str(FOLDER)).collect()))
