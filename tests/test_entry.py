"""The entry module without the training-data subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = "import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()) and 'revenue_by_store' in q; print(len(q))"


@pytest.mark.parametrize("left_out", [("llm", "corpus_pipeline.py"), ("llm",), ("corpus_pipeline.py",)])
def test_entry_works_without_the_subpackage(folder, left_out):
    copy = Path(folder) / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(*left_out, ".git", "__pycache__"))
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 50


def test_a_pipeline_elsewhere_on_the_path_is_not_taken(folder):
    copy = Path(folder) / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("corpus_pipeline.py", ".git", "__pycache__"))
    env = os.environ | {"PYTHONPATH": os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=120, env=env)
    assert done.returncode == 0, done.stderr


def test_a_folder_with_leftovers_counts_as_gone(folder):
    copy = Path(folder) / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    (copy / "tillweave" / "llm" / "queries.py").write_text("import a_wheel_that_is_not_there\n")
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_parallelism_is_only_what_was_asked_for(spark):
    import __spark_entry__ as entry
    from tillweave.plans import neardup, retail

    as_read = retail.inputs.table(spark, entry.ENTRY_DIR, "lineitem").rdd.getNumPartitions()
    for job, rows in ((retail.Retail, "raw"), (neardup.NearDup, "docs")):
        assert getattr(job(spark, entry.ENTRY_DIR), rows)().rdd.getNumPartitions() == as_read
        assert getattr(job(spark, entry.ENTRY_DIR, parallelism=3), rows)().rdd.getNumPartitions() == 3
    assert spark.conf.get(entry.PARALLELISM, None) is None
