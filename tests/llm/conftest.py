import pytest

pytest.importorskip("tidetable.llm")
