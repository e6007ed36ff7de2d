"""The entry without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [["slabwise/llm"], ["slabwise/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_the_entry_works_without_its_optional_parts(tmp_path, gone):
    tree = tmp_path / "tree"
    shutil.copytree(ROOT, tree, ignore=shutil.ignore_patterns(".git", "__pycache__", ".hypothesis", ".pytest_cache"))
    for name in [*gone, "tests/llm"]:
        path = tree / name
        if path.is_dir():
            shutil.rmtree(path)
        else:
            path.unlink(missing_ok=True)
    code = "import __spark_entry__ as e, tools.compare as c; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), 'subarray_stdev' in q, any(n.startswith('op1_') for n in q), 'pipeline' in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tree, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    number, *there = done.stdout.split()
    without_text = "slabwise/llm" in gone or not (ROOT / "slabwise" / "llm").is_dir()
    assert int(number) > 60 and there == ["True", str(not without_text), "False"]
