import pytest

pytest.importorskip("quillmesh.llm")
