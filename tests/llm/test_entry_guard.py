"""An error inside the subpackage is an error of the entry, not a shorter list of queries."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_a_broken_symbol_raises():
    code = f"import sys; sys.path.insert(0, {ROOT!r}); import kempt.llm.common as c; del c.held_out; import __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "held_out" in done.stderr


def test_all_operators_are_registered():
    code = (f"import sys; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e; q = e.queries(); "
            "assert [sum(k.startswith(f'op{n}_') for k in q) for n in range(1, 14)] == [1] * 13 and 'pipeline' in q")
    assert subprocess.run([sys.executable, "-c", code], timeout=120).returncode == 0
