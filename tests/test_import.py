"""The entry module imports anywhere, and the stop-word constant is Spark ML's list."""

import os
import subprocess
import sys

from conftest import ROOT
from pyspark.ml.feature import StopWordsRemover

from pricewright.functions.text import STOP_WORDS_ENGLISH

# The package folder of pyspark is replaced by a look-alike without its jars.
HIDDEN_JARS = """
import glob, os, zipfile
real = os.path.exists
def refuse(*a, **k):
    raise FileNotFoundError("no jar may be opened while importing")
zipfile.ZipFile = refuse
glob.glob = lambda *a, **k: []
import __spark_entry__ as e
assert len(e.queries()) > 100 and len(e.oracle_sql()) > 80
"""


def test_entry_imports_without_the_jar_folder():
    r = subprocess.run([sys.executable, "-c", HIDDEN_JARS], cwd=ROOT, capture_output=True, text=True, timeout=300,
                       env={**os.environ, "PYTHONPATH": ROOT})
    assert r.returncode == 0, r.stderr[-2000:]


def test_stop_words_are_spark_mls(spark):
    assert list(STOP_WORDS_ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")
