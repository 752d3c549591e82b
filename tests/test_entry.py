"""The entry in copies of the repository that lack the document operators, the pipeline, or both."""

from __future__ import annotations

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from monthmill.given.oracle import ORACLE
from monthmill.given.queries import QUERIES

REPOSITORY = Path(__file__).resolve().parents[1]
ASK = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def names(folder: Path) -> tuple[set[str], set[str]]:
    done = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, check=True, timeout=120)
    queries, oracle = json.loads(done.stdout.splitlines()[-1])
    return set(queries), set(oracle)


@pytest.fixture
def copy(tmp_path):
    """The package and the entry, with caches of compiled modules left out."""
    shutil.copytree(REPOSITORY / "monthmill", tmp_path / "monthmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPOSITORY / "__spark_entry__.py", tmp_path)
    return tmp_path


def test_without_operators_and_pipeline(copy):
    assert names(copy) == (set(QUERIES), set(ORACLE))


def test_without_operators_beside_a_pipeline(copy):
    (copy / "corpus_pipeline.py").write_text("from monthmill.llm import packing\n")
    assert names(copy) == (set(QUERIES), set(ORACLE))


def test_without_operators_whose_empty_folder_is_left(copy):
    (copy / "monthmill" / "llm" / "__pycache__").mkdir(parents=True)
    (copy / "corpus_pipeline.py").write_text("from monthmill.llm import packing\n")
    assert names(copy) == (set(QUERIES), set(ORACLE))


def test_nothing_else_in_the_library_names_the_operators():
    for file in (REPOSITORY / "monthmill").rglob("*.py"):
        if "llm" not in file.parts:
            assert "monthmill.llm" not in file.read_text(), file
