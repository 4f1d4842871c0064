"""The driver's contract in deployments that lack parts."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["cumulo.llm", "corpus_pipeline", "public_tokenizers", "xxhash"])
def test_base_queries_without(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as e\n"
        "assert 'daily_rollup' in e.queries() and set(e.oracle_sql()) <= set(e.queries())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_a_fault_of_the_base_is_raised():
    code = "import sys; sys.modules['gate.sinks'] = None\nimport __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode and "gate.sinks" in done.stderr
