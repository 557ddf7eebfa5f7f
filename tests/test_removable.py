"""The repository without its text operators still imports and lists its other queries."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_the_text_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "corpus_pipeline.py", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(q) == set(e.oracle_sql()), any(n.startswith('op') for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin"}).stdout
    count, equal, text = out.split()[-3:]
    assert int(count) >= 120 and (equal, text) == ("True", "False")
