"""The library without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

from cutweave.plans import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_queries_without_the_training_data_operators(tmp_path, pipeline):
    """Both folders are gone; the pipeline's file, which imports one of them, may still lie there."""
    shutil.copytree(os.path.join(ROOT, "cutweave"), tmp_path / "cutweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")) else [])]:
        shutil.copy(os.path.join(ROOT, name), tmp_path)
    say = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", say], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(catalog.QUERIES)), str(len(catalog.ORACLE))]


def test_other_import_errors_are_raised(tmp_path):
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(ROOT, "cutweave"), tmp_path / "cutweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "cutweave" / "llm").mkdir()
    (tmp_path / "cutweave" / "llm" / "__init__.py").write_text("")
    (tmp_path / "cutweave" / "llm" / "queries.py").write_text("import no_such_module_at_all\n")
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; e.queries()"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert run.returncode and "no_such_module_at_all" in run.stderr
