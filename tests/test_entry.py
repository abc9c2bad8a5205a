"""The entry point without the optional package, or without a library that part of it needs."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

# Runs the entry point while the modules named on the command line cannot be imported, and prints its query names.
BLOCKED = """
import importlib.abc, sys
class Block(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if any(name == b or name.startswith(b + ".") for b in sys.argv[1:]):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as entry
print(*entry.queries(), sep="\\n")
assert entry.oracle_sql().keys() <= entry.queries().keys()
"""


def names(*blocked):
    run = subprocess.run([sys.executable, "-c", BLOCKED, *blocked], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return set(run.stdout.split())


def test_queries_stand_without_the_optional_package():
    alone = names("ledgerloom.llm", "corpus_pipeline")
    assert "scorecard" in alone and "pipeline" not in alone and not any(n.startswith("op") and n[2:3].isdigit() for n in alone)
    assert names("ledgerloom.llm") == alone
    assert alone <= names()


def test_a_missing_library_takes_only_its_own_queries():
    whole, some = names(), names("zstandard", "sentencepiece")
    assert all(n.startswith(("op7_", "op13_")) for n in whole - some)
