"""The driver contract with and without the optional corpus operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES), set(e.oracle_sql()) <= set(e.queries()))"


@pytest.mark.parametrize("missing", ["ahocorasick", "reviewlens.llm", "corpus_pipeline"])
def test_core_queries_load_without_the_corpus_operators(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; {SAY}"
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split() == ["True", "True"]
