"""The entry module without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
OPTIONAL = ("llm", "llm.py")


def copy(tmp_path):
    """The package and the entry module, without the optional subpackage."""
    shutil.copytree(ROOT / "claimflow", tmp_path / "claimflow", ignore=lambda folder, names: [n for n in names if n in OPTIONAL or n == "__pycache__"])
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    return tmp_path


def names(folder):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), set(e.oracle_sql()) <= set(e.queries()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(folder)})
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def test_the_rest_imports_alone(tmp_path):
    """Also where the pipeline's module was left behind."""
    folder = copy(tmp_path)
    queries, oracles, known, pipeline = names(folder)
    assert int(queries) > 130 and int(oracles) > 130 and known == "True" and pipeline == "False"
    if (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", folder)
        assert names(folder) == [queries, oracles, known, pipeline]


def test_nothing_else_imports_it():
    for file in (ROOT / "claimflow").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "claimflow.llm" not in file.read_text(), file
