"""The entry with parts of the library missing."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from ledgerloom.contract.registry import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

COUNT = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None  # importing it raises ImportError
import __spark_entry__ as entry
assert set(entry.oracle_sql()) <= set(entry.queries())
print(len(entry.queries()))
"""


@pytest.mark.parametrize(
    "missing",
    [
        ["sentencepiece"],
        ["public_tokenizers"],
        ["xxhash", "regex"],
        ["ledgerloom.llm"],
        ["ledgerloom.llm", "corpus_pipeline"],
    ],
)
def test_core_queries_stay_when_something_is_missing(missing):
    run = subprocess.run(
        [sys.executable, "-c", COUNT, *missing], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert run.returncode == 0, run.stderr
    assert int(run.stdout.split()[-1]) == len(QUERIES)
    assert run.stderr.count("left out") == 1
