"""The entry module with and without the part for language-model training text."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

WITHOUT = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("ledgermill.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
assert "fact_transactions" in entry.queries()
assert not any(name.startswith("op") or name == "pipeline" for name in entry.queries())
assert set(entry.oracle_sql()) == set(entry.queries())
"""


def test_the_other_queries_do_not_need_that_part():
    subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_it():
    for path in [*ROOT.glob("ledgermill/**/*.py"), *ROOT.glob("verification/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
