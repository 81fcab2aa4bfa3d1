"""The driver contract must import anywhere: no session, jar or data file at import."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROBE = """
import builtins, glob, zipfile
def refuse(*a, **k):
    raise AssertionError("file lookup at import")
glob.glob = refuse
zipfile.ZipFile = refuse
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert len(q) > 200 and set(o) <= set(q) and len(o) > 150
from pyspark import SparkContext
assert SparkContext._active_spark_context is None
print("imported", len(q), len(o))
"""


def test_entry_imports_without_files_or_session():
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "imported" in done.stdout
