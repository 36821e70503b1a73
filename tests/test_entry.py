"""The entry point stands without the optional corpus operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_corpus_operators(tmp_path, with_pipeline):
    shutil.copytree(ROOT / "stateloom", tmp_path / "stateloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py")[: 1 + with_pipeline]:
        shutil.copy(ROOT / name, tmp_path)
    told = "import __spark_entry__ as e; from stateloom.plans.register import QUERIES; assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
