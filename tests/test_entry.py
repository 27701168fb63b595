"""The entry points with and without the text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_without_text_operators(tmp_path):
    shutil.copytree(ROOT / "sparktab", tmp_path / "sparktab", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); assert len(n) > 80 and set(e.oracle_sql()) <= set(n); print(any(k.startswith('op1_') or k == 'pipeline' for k in n))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "False", done.stderr


def test_nothing_else_imports_them():
    for file in (ROOT / "sparktab").rglob("*.py"):
        if "llm" not in file.parts:
            assert "llm" not in file.read_text(), file
