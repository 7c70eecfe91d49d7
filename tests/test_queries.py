"""Every registered query against its SQL twin."""

import os
import shutil
import subprocess
import sys

import catalog
import pytest
from compare import differences
from conftest import SF_DIR

import __spark_entry__ as contract


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_imports_without_the_text_operators(tmp_path):
    root = os.path.dirname(os.path.abspath(contract.__file__))
    gone = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(root, tmp_path / "tree", ignore=gone)
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()) and len(e.queries()) > 70"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "tree", check=True, timeout=120)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, connection, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert differences(frame, connection, contract.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
