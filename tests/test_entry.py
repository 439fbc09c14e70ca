"""The entry point with and without its optional parts."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

WITHOUT = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["touchline", "llm"]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
names = sorted(entry.queries())
assert "season_totals" in names and not [n for n in names if n.startswith("op")] and "pipeline" not in names
assert set(entry.oracle_sql()) <= set(names)
print(len(names))
"""


def test_queries_without_the_optional_subpackage():
    from touchline.queries import QUERIES
    done = subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == len(QUERIES)


def test_faults_inside_an_optional_part_are_raised(tmp_path, monkeypatch):
    import pytest

    import __spark_entry__ as entry
    (tmp_path / "broken_part.py").write_text("import a_module_that_does_not_exist")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.raises(ModuleNotFoundError):
        entry.optional("broken_part")
