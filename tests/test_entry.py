"""The library stands without the text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_text_operators(tmp_path, pipeline):
    leave_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "repo", ignore=leave_out)
    lines = "import __spark_entry__ as e, check; print(sorted(set(e.queries()) ^ set(e.oracle_sql())))"
    done = subprocess.run(
        [sys.executable, "-c", lines], cwd=tmp_path / "repo", env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == "[]"
