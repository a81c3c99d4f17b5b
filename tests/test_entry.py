"""The entry module without its optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from coldshelf.oracle import ORACLE
from coldshelf.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(Q), sorted(e.oracle_sql()) == sorted(O))"


def copied(folder: Path) -> Path:
    shutil.copytree(ROOT / "coldshelf", folder / "coldshelf", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, folder)
    return folder


def said(folder: Path, before: str = "") -> str:
    code = f"{before}Q, O = {sorted(QUERIES)}, {sorted(ORACLE)}; {SAY}"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True).stdout.strip()


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "compiled files"])
def test_the_rest_is_registered_without_the_operators(tmp_path, left):
    folder = copied(tmp_path)
    if left != "nothing":
        (folder / "coldshelf" / "llm").mkdir()
    if left == "compiled files":
        (folder / "coldshelf" / "llm" / "__pycache__").mkdir()
        (folder / "coldshelf" / "llm" / "__pycache__" / "queries.cpython-313.pyc").write_bytes(b"")
    assert said(folder) == "True True"


def test_the_rest_is_registered_without_the_tokenizers():
    hidden = "import sys; sys.modules['public_tokenizers'] = None; "
    assert said(ROOT, hidden) == "True True"
