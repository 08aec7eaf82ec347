import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_oracles_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_corpus_operators(tmp_path):
    """The library and its entry points don't need the optional part."""
    shutil.copytree(ROOT / "lookout", tmp_path / "lookout", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q.startswith(('op1_', 'pipeline'))])"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})
    assert said.returncode == 0, said.stderr
    assert said.stdout.split()[-1] == "[]"


@pytest.mark.skipif(not (ROOT / "lookout/llm").is_dir(), reason="without the optional part")
def test_broken_part_is_an_error(tmp_path):
    """A part that is there but can't be imported isn't left out silently; a folder without files is no part."""
    shutil.copytree(ROOT / "lookout", tmp_path / "lookout", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    run = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": os.environ["PATH"], "PYTHONPATH": ""})
    assert run().returncode == 0
    (tmp_path / "lookout/llm/queries.py").write_text("import no_such_module")
    assert "no_such_module" in run().stderr
    shutil.rmtree(tmp_path / "lookout/llm")
    (tmp_path / "lookout/llm/__pycache__").mkdir(parents=True)
    assert run().returncode == 0
