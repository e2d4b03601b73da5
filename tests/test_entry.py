"""The driver's entry without the training-data part, as a whole folder and as an empty one."""

import pathlib
import shutil
import subprocess
import sys

import pytest

from shelfmark.plans.registry import QUERIES

ROOT = pathlib.Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("left", ["nothing", "pipeline", "empty folder"])
def test_entry_without_training_data_operators(tmp_path, left):
    skip = shutil.ignore_patterns("__pycache__", ".git", "llm", "tests", *[] if left == "pipeline" else ["corpus_pipeline.py"])
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=skip)
    if left == "empty folder":
        (copy / "shelfmark" / "llm" / "__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120, check=False)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[0]) == len(QUERIES)
