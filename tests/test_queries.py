import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from folioforge.plans import registry

FOLDER = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")


def plain(v):
    return round(float(v), 4) if isinstance(v, float) or hasattr(v, "quantize") else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    df = registry.queries()[name](spark, str(FOLDER))
    cols = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in cols] for r in df.collect()), key=repr)
    rel = db.execute(registry.oracle_sql()[name])
    there = [d[0] for d in rel.description]
    assert sorted(there) == cols
    want = sorted(([plain(r[there.index(c)]) for c in cols] for r in rel.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name,columns", [("p1_found", ["tab", "row_id", "field", "utc_ms"]), ("p2_found", ["snap_no", "lang", "slug", "change"]), ("p3_found", ["id", "lang", "slug"]), ("p4_found", ["tab", "ref_id", "period", "reason"])])
def test_found_queries(spark, name, columns):
    df = registry.queries()[name](spark, str(FOLDER))
    assert df.columns == columns and df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["snap_no", "lang", "slug", "change"] and set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_know_the_llm_package():
    root = Path(entry.__file__).parent
    for p in (root / "folioforge").rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "folioforge.llm" not in p.read_text()
