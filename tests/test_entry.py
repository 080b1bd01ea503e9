"""The rest works without the training-data package."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

PROBE = """
import __spark_entry__ as entry
names = set(entry.queries())
assert set(entry.oracle_sql()) <= names
assert not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
print(len(names))
"""


def without_llm(target: Path, *more: str) -> Path:
    """A copy of the repository without the two folders, and without some more files."""
    gone = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", *more)
    return Path(shutil.copytree(ROOT, target / "copy", ignore=gone))


@pytest.mark.parametrize("more", [(), ("corpus_pipeline.py",)])
def test_the_rest_imports_without_the_package(tmp_path, more):
    copy = without_llm(tmp_path, *more)
    assert not (copy / "shopmill" / "llm").exists() and not (copy / "tests" / "llm").exists()
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 70


def test_other_import_errors_are_raised(tmp_path):
    copy = without_llm(tmp_path, "corpus_pipeline.py")
    (copy / "corpus_pipeline.py").write_text("import shopmill.no_such_module\n")
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert done.returncode and "no_such_module" in done.stderr
