"""The driver's entry: the catalogue stays whether or not the training-data operators can be imported."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
sys.path.insert(0, {root!r})
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {name!r}", name={name!r})
sys.meta_path.insert(0, Block())
import __spark_entry__ as entry
from kempt.plans.catalogue import QUERIES
assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
"""


def run(code):
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)


def test_absent_packages_leave_the_catalogue():
    for name in ("xxhash", "regex", "corpus_pipeline", "kempt.llm"):
        done = run(BLOCK.format(root=ROOT, name=name))
        assert done.returncode == 0, done.stderr


def test_a_missing_core_module_is_an_error():
    done = run(BLOCK.format(root=ROOT, name="kempt.functions.text"))
    assert done.returncode != 0 and "kempt.functions" in done.stderr
