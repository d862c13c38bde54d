import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_queries_and_sql_match(spark):
    import __spark_entry__

    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 60
    assert all(callable(f) for f in queries.values())


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_entry_without_the_optional_subpackage(tmp_path):
    """A leftover folder of compiled files must not take the other queries down."""
    shutil.copytree(ROOT / "millrace", tmp_path / "millrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "millrace/llm/__pycache__").mkdir(parents=True)
    (tmp_path / "millrace/llm/__pycache__/queries.cpython-313.pyc").write_bytes(b"stale")
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(k[0] == 'p' and k[1].isdigit() for k in q), set(e.oracle_sql()) <= set(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True).stdout.split()
    assert int(out[0]) > 60 and out[1:] == ["0", "True"]
