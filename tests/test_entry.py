"""The driver's entry works with and without the optional text operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["siteledger", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as entry
assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_entry_without_the_text_operators():
    subprocess.run([sys.executable, "-c", BLOCKED], cwd=ROOT, check=True, timeout=120)


def test_entry_names_match():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
