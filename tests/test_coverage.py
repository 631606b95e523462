"""COVERAGE.md names queries and test files that exist."""

import os
import re

from tests.conftest import ROOT
from tidemark.plans import catalog


def test_named_queries_and_tests_exist():
    missing = []
    with open(os.path.join(ROOT, "COVERAGE.md"), encoding="utf-8") as f:
        rows = [line.split(" | ") for line in f if re.match(r"\| [A-Z]+\d+\w* \|", line)]
    assert len(rows) > 80
    for cells in rows:
        for name in re.findall(r"`([^`]+)`", cells[-1]):
            if name.startswith("tests/"):
                if not os.path.exists(os.path.join(ROOT, name)):
                    missing.append((cells[0], name))
            elif re.fullmatch(r"[a-z][a-z0-9_]+", name) and name not in catalog.QUERIES:
                missing.append((cells[0], name))
    assert missing == []
