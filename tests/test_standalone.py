"""The library, its entry point and its queries without the optional training-data operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SHOW = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES), sorted(e.oracle_sql()) == sorted(e.ORACLES))"


def names(folder: Path, code: str = SHOW) -> list[str]:
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, env=environment, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_optional_folders(tmp_path, pipeline):
    for name in ("sheetloom", "workload"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "check.py", "bench.py", *(["corpus_pipeline.py"] if pipeline else [])):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    assert names(tmp_path) == ["True", "True"]
    assert names(tmp_path, "import check, bench, sheetloom; print('ok')") == ["ok"]


def test_without_an_optional_package():
    """Where a package that only the optional operators import is not installed, they are left out."""
    assert names(ROOT, f"import sys; sys.modules['xxhash'] = None; {SHOW}") == ["True", "True"]


def test_the_library_imports_nothing_optional():
    code = "import sys, sheetloom, workload.queries; print(any(m.startswith('sheetloom.llm') for m in sys.modules))"
    assert names(ROOT, code) == ["False"]


def test_test_modules_have_unique_names():
    """Two test modules of one name cannot be collected together."""
    found = [p.name for p in (ROOT / "tests").rglob("*.py")]
    assert len(found) == len(set(found))
