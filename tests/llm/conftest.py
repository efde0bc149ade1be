import pytest

pytest.importorskip("folioforge.llm.queries")
