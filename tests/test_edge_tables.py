import os
from pathlib import Path

import pytest

from edge_tables import write
from folioforge.plans import registry

FOLDER = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")
FOUND = ["p1_found", "p2_found", "p3_found", "p4_found"]


@pytest.mark.parametrize("kind", ["empty", "nulls", "clashing"])
def test_found_queries_on_odd_tables(spark, tmp_path, kind):
    folder = write(spark, FOLDER, tmp_path, kind)
    for name in FOUND:
        rows = registry.queries()[name](spark, folder).collect()
        if kind == "empty":
            assert rows == []
        elif kind == "clashing":
            assert sorted(map(str, rows)) == sorted(map(str, registry.queries()[name](spark, str(FOLDER)).collect()))
        else:
            assert len(rows) > 0
