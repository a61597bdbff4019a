"""The entry stands without the optional operators, whatever of them is missing."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from reviewmill.plans.catalog import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [("reviewmill/llm",), ("reviewmill/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_imports_without(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm" if "reviewmill/llm" in gone else "none", *gone))
    program = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", program], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(QUERIES)), "True"], done.stderr
