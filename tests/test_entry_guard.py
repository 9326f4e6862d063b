"""The entry without the optional package, or without a library that only it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
from funnelbook.registry import ORACLES, QUERIES
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(ORACLES), sorted(set(e.queries()) ^ set(QUERIES))
"""


@pytest.mark.parametrize("names", [("ahocorasick",), ("xxhash",), ("public_tokenizers",), ("funnelbook.llm",), ("corpus_pipeline",)])
def test_core_queries_stay(names):
    done = subprocess.run([sys.executable, "-c", CODE.format(names=names)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
