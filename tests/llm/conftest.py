from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture
def docs(spark):
    from llm_rows import frame

    return lambda rows: frame(spark, rows)
