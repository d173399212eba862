"""The driver's contract, with and without the part for training data."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, sum(n.startswith('op') for n in q), set(e.oracle_sql()) <= set(q))"


@pytest.fixture
def copy(tmp_path):
    for name in ("campusgrid", "checks"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path / name)
    return tmp_path


def listed(folder):
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": ""})
    return out.stdout.split()


def test_without_the_package_or_with_an_empty_one(copy):
    shutil.rmtree(copy / "campusgrid" / "llm", ignore_errors=True)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    alone = listed(copy)
    assert int(alone[0]) > 120 and alone[1:] == ["False", "0", "True"]
    (copy / "campusgrid" / "llm").mkdir()
    assert listed(copy) == alone


@pytest.mark.skipif(not os.path.isdir(f"{ROOT}/campusgrid/llm"), reason="the part is left out")
def test_with_the_package(copy):
    assert listed(copy)[1:] == ["True", "13", "True"]
