"""The driver's entry points, with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as driver
from scanweave.plans.catalogue import all_queries

ROOT = Path(__file__).resolve().parents[1]


def test_registered_names():
    assert set(all_queries()) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_points_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    leave = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse")
    shutil.copytree(ROOT, copy, ignore=leave)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(all_queries())), str(len(all_queries())), "False"], done.stderr[-2000:]


def test_a_broken_subpackage_is_not_hidden(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse", "corpus_pipeline.py"))
    (copy / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True, timeout=120)
    assert "no_such_module_at_all" in done.stderr
