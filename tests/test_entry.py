"""The entry point without the training-data package."""

import json
import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

CODE = "import json, __spark_entry__ as E; print(json.dumps([sorted(E.queries()), sorted(E.oracle_sql())]))"


@pytest.mark.parametrize("without", [["tidemark/llm", "tests/llm"], ["tidemark/llm", "tests/llm", "corpus_pipeline.py"]])
def test_imports_without_the_package(scratch, without):
    from tidemark.plans import catalog

    copy = os.path.join(scratch, "repo")
    gone = [os.path.join(ROOT, p) for p in without]
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__")
                                                              or os.path.join(folder, n) in gone])
    out = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, timeout=120,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": copy})
    assert out.returncode == 0, out.stderr[-2000:]
    names, sql = json.loads(out.stdout.strip().splitlines()[-1])
    assert names == sorted(catalog.QUERIES) and sql == sorted(catalog.ORACLE)
