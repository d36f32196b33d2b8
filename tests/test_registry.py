"""The registry with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


def _names(folder: Path) -> set[str]:
    done = subprocess.run(
        [sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr[-2000:]
    return set(done.stdout.split())


@pytest.fixture
def copy(tmp_path):
    kept = shutil.ignore_patterns(".git", "__pycache__")
    return Path(shutil.copytree(ROOT, tmp_path / "copy", ignore=kept))


@pytest.mark.parametrize("leave", [False, True], ids=["with pipeline file", "without it"])
def test_imports_without_the_subpackage(copy, leave):
    if (copy / "ratingloom" / "llm").exists():
        (copy / "ratingloom" / "llm").rename(copy.parent / "gone")
    if leave and (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").rename(copy.parent / "gone.py")
    names = _names(copy)
    assert "rating_count" in names
    assert not any(n.startswith("op") or n == "pipeline" for n in names)


def test_imports_without_the_pipeline_file(copy):
    if not (copy / "corpus_pipeline.py").exists():
        pytest.skip("already absent")
    (copy / "corpus_pipeline.py").rename(copy.parent / "gone.py")
    assert "pipeline" not in _names(copy)
