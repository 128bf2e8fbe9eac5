"""The entry without the corpus part, or without a library that only the corpus part needs."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
BLOCK = "import sys; sys.modules[{name!r}] = None; import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"


@pytest.mark.parametrize("name", ["lapsewise.llm", "corpus_pipeline", "xxhash"])
def test_other_queries_stay(name):
    from lapsewise.queries import QUERIES

    ran = subprocess.run([sys.executable, "-W", "ignore", "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True, check=True)
    assert ran.stdout.split() == [str(len(QUERIES)), "False"]
