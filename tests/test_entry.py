"""The entry points with and without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q = set(e.queries()); assert set(e.oracle_sql()) <= q; print(len(q), 'pipeline' in q, any(x.startswith('op') for x in q))"


def imported(folder: Path) -> list[str]:
    return subprocess.run([sys.executable, "-c", COUNT], cwd=folder, check=True, capture_output=True, text=True, timeout=120).stdout.split()


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_entry_imports_without_the_training_data_operators(tmp_path, pipeline):
    left_out = [".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])]
    copy = shutil.copytree(REPO, tmp_path / "copy", ignore=shutil.ignore_patterns(*left_out))
    assert not (copy / "palaver/llm").exists() and (copy / "corpus_pipeline.py").exists() == pipeline
    n, *others = imported(copy)
    assert int(n) >= 50 and others == ["False", "False"]
