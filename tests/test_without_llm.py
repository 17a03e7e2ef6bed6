"""The library works where the training-data operators are absent, with and without the pipeline file."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
import __spark_entry__ as entry
names = entry.queries()
assert names and set(entry.oracle_sql()) <= set(names), names
assert "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
assert not [m for m in sys.modules if m.startswith("docflow.llm") or m == "corpus_pipeline"]
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_import(tmp_path, pipeline):
    away = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=away)
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=120, check=False)
    assert done.returncode == 0, done.stderr
