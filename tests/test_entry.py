import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_queries_are_read_without_a_session():
    code = ("import __spark_entry__ as e; q, sql = e.queries(), e.oracle_sql(); "
            "assert set(sql) <= set(q) and len(q) > 150; "
            "from pyspark.sql import SparkSession; assert not SparkSession.getActiveSession()")
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                         timeout=120)
    assert run.returncode == 0, run.stderr
