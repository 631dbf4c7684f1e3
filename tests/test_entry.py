"""The entry module where libraries of the training-data operators are missing."""

import subprocess
import sys

from conftest import ROOT

HIDE = """
import sys, warnings
sys.modules[{hidden!r}] = None
warnings.simplefilter("ignore")
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from verdigrid.plans import QUERIES
assert set(QUERIES) <= set(entry.queries())
assert {{k for k, q in QUERIES.items() if q.sql}} <= set(entry.oracle_sql())
print(sum(k.startswith("op") or k == "pipeline" for k in entry.queries()))
"""


def left_with(hidden):
    code = HIDE.format(hidden=hidden, root=ROOT)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    return int(done.stdout)


def test_core_queries_need_no_library_of_the_others():
    assert left_with("public_tokenizers") <= 1  # the pipeline may not need it
    assert left_with("verdigrid.llm") == 0
