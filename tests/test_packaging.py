"""The driver contract from a foreign working directory in a default session: Python workers
must import the package although nothing but __spark_entry__.py is on their path."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entry_mod", "{ROOT}/__spark_entry__.py")
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
assert E.entry(spark).count() == 150
assert E.queries()["net_forward_mlp"](spark, "/root/testdata/sf0.001").count() == 5000
print("OK")
"""


def test_entry_and_arrow_query_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="tessera-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert "OK" in out.stdout, out.stderr[-3000:]


def test_entry_imports_without_the_corpus_folders(tmp_path):
    """The entry module of a copy without ``llm`` (with and without the pipeline file) keeps all other queries."""
    import shutil
    import subprocess

    skip = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", "spark-warehouse", "*.json")
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    code = "import __spark_entry__ as E; q = E.queries(); assert set(E.oracle_sql()) <= set(q); print(sorted(n for n in q if n.startswith('op') and n[2].isdigit()), 'pipeline' in q, len(q))"
    for last in (False, True):
        if last and (copy / "corpus_pipeline.py").exists():
            (copy / "corpus_pipeline.py").unlink()
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True).stdout
        assert out.startswith("[] False ") and int(out.split()[-1]) > 90
