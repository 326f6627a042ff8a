"""The entry points where parts of the repository are missing."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]

RUN = """
import sys
sys.path.insert(0, {folder!r})
import __spark_entry__ as entry
queries, oracle = entry.queries(), entry.oracle_sql()
assert "bronze_to_silver" in queries and set(oracle) <= set(queries)
assert not [q for q in queries if q.startswith("op") and q[2].isdigit() or q == "pipeline"], sorted(queries)
"""


@pytest.mark.parametrize("gone", [("lodeworks/llm", "corpus_pipeline.py"), ("lodeworks/llm",)])
def test_entry_without_the_training_data_operators(tmp_path, gone):
    passed_over = shutil.ignore_patterns(".git", "__pycache__", "llm")
    shutil.copytree(ROOT / "lodeworks", tmp_path / "lodeworks", ignore=passed_over)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if "corpus_pipeline.py" not in gone and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    done = subprocess.run([sys.executable, "-c", RUN.format(folder=str(tmp_path))], capture_output=True, text=True, cwd=tmp_path)
    assert done.returncode == 0, done.stderr
