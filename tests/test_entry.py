"""The entry points import, with all queries that are left, when the text operators are taken out."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), sum(n[:2] == 'op' or n == 'pipeline' for n in e.queries()))"


def copied(to: Path, *gone: str) -> Path:
    kept = ["anamnesis", "workload", "__spark_entry__.py", "corpus_pipeline.py"]
    for name in kept:
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, to / name, ignore=shutil.ignore_patterns("__pycache__", *(["llm"] if "llm" in gone else [])))
        elif source.exists() and name not in gone:
            shutil.copy(source, to / name)
    return to


def run(folder: Path, code: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_import_without_the_text_operators(tmp_path, gone):
    done = run(copied(tmp_path, *gone), COUNT)
    assert done.returncode == 0, done.stderr
    whole, operators = map(int, done.stdout.split())
    assert whole > 150
    if "llm" in gone:
        assert operators == 0


def test_a_fault_inside_the_pipeline_is_an_error(tmp_path):
    folder = copied(tmp_path, "llm")
    (folder / "corpus_pipeline.py").write_text("import no_such_module\n")
    assert "no_such_module" in run(folder, COUNT).stderr
