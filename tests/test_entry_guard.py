"""The queries of the library are registered without the optional subpackage and what it needs."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys
sys.path.insert(0, {root!r})
for name in {missing!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("missing", [["tiktoken"], ["xxhash"], ["sieveline.llm"], ["corpus_pipeline"]])
def test_other_queries_survive_a_missing_module(missing):
    code = CODE.format(root=str(ROOT), missing=missing)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout
    assert out.split() == ["83", "83"]
