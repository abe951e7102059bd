"""The driver contract with and without the optional operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAYS = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'series_stats' in q, any(n.startswith('op') for n in q), 'pipeline' in q)"


@pytest.mark.parametrize("gone", [["tristrata/llm"], ["tristrata/llm", "corpus_pipeline.py"]])
def test_imports_without_the_operators(tmp_path, gone):
    for part in ("__spark_entry__.py", "corpus_pipeline.py", "catalogue_queries", "tristrata"):
        source = ROOT / part
        if source.is_dir():
            shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns("__pycache__", *(g.split("/")[1] for g in gone if "/" in g)))
        elif source.exists() and part not in gone:
            shutil.copy(source, tmp_path / part)
    said = subprocess.run([sys.executable, "-c", SAYS], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) > 90 and said[1:] == ["True", "False", "False"]
