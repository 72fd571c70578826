"""The driver's entry: with the training-data package and without it."""

import subprocess
import sys
from pathlib import Path

import pytest

from ledgerloom.checks import registry

ROOT = Path(__file__).resolve().parents[1]

ASK = """
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(name.startswith("op") for name in e.queries()))
"""


def ask(folder):
    return subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, check=False)


@pytest.fixture
def bare(tmp_path):
    """The library without its training-data package and pipeline, by links."""
    (tmp_path / "ledgerloom").mkdir()
    (tmp_path / "__spark_entry__.py").symlink_to(ROOT / "__spark_entry__.py")
    for part in (ROOT / "ledgerloom").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "ledgerloom" / part.name).symlink_to(part)
    return tmp_path


def test_the_rest_stands_without_the_package(bare):
    found = ask(bare)
    assert found.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.QUERIES)), "False"], found.stderr


def test_nothing_else_imports_the_package():
    for path in (ROOT / "ledgerloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "ledgerloom.llm" not in path.read_text()


def test_an_error_inside_the_package_is_not_hidden(bare):
    (bare / "ledgerloom" / "llm").mkdir()
    (bare / "ledgerloom" / "llm" / "__init__.py").write_text("")
    (bare / "ledgerloom" / "llm" / "queries.py").write_text("import no_such_module")
    (bare / "corpus_pipeline.py").write_text("")
    assert "no_such_module" in ask(bare).stderr
