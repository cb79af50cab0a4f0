"""The entry file works with and without the data-pipeline operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("absent", [(), ("alertloom.llm", "corpus_pipeline"), ("corpus_pipeline",)])
def test_entry_imports(absent):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
sys.modules.update(dict.fromkeys({absent!r}))
import __spark_entry__ as e
print(len(e.queries()), "pipeline" in e.queries(), set(e.oracle_sql()) <= set(e.queries()), "q_label" in e.queries())
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    n, pipeline, listed, own = said.stdout.split()
    present = not absent and os.path.isdir(os.path.join(ROOT, "alertloom", "llm"))
    assert (pipeline, listed, own) == (str(present), "True", "True") and int(n) > 70

