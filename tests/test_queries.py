"""Every registered query beside its SQL."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from ridelabel.catalog import queries as catalog
from tests.compare import compare, connect

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_each_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() == 624


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",), ("corpus_pipeline.py", "ridelabel/llm")])
def test_the_rest_lives_without_the_optional_package(tmp_path, left):
    """Neither a pipeline without its package nor an emptied folder stops the other queries."""
    root = Path(entry.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "ridelabel", tmp_path / "ridelabel", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in left:
        if name.endswith(".py"):
            (tmp_path / name).write_text("import ridelabel.llm.common\n")
        else:
            (tmp_path / name).mkdir()
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.queries()) == set(e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == NAMES


def test_a_broken_optional_module_is_not_taken_for_a_missing_one(tmp_path):
    root = Path(entry.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "ridelabel", tmp_path / "ridelabel", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "ridelabel" / "llm").mkdir()
    (tmp_path / "ridelabel" / "llm" / "__init__.py").write_text("")
    (tmp_path / "ridelabel" / "llm" / "queries.py").write_text("import ridelabel.llm.gone\n")
    done = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode and "ridelabel.llm.gone" in done.stderr
