"""The entry module with and without the corpus subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') for k in e.queries()))"


def _said(folder):
    r = subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr
    return r.stdout.split()


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "parcelspark", tmp_path / "parcelspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    queries, oracles, has = _said(tmp_path)
    assert int(queries) > 70 and int(oracles) > 70 and has == "False"


def test_only_the_subpackage_itself_may_be_missing(tmp_path):
    shutil.copytree(ROOT / "parcelspark", tmp_path / "parcelspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    broken = tmp_path / "parcelspark/llm"
    broken.mkdir()
    (broken / "__init__.py").write_text("")
    (broken / "registry.py").write_text("import a_module_that_nobody_has")
    r = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert r.returncode != 0 and "a_module_that_nobody_has" in r.stderr


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "parcelspark").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "parcelspark.llm" not in p.read_text()
