from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from bankmart.session import local_session

    s = local_session("local[4]", shuffle_partitions=8, app_name="bankmart-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="bankmart-test-")


def sf_dir(sf: str) -> str:
    return f"{TESTDATA}/sf{sf}"


def rows(df, *cols):
    """Rows as plain tuples, sorted (None sorts first)."""
    data = df.select(*cols).collect() if cols else df.collect()
    return sorted((tuple(r) for r in data), key=lambda t: tuple((v is not None, v) for v in t))


def write_csv(folder: str, name: str, header: list[str], lines: list[list[str | None]]) -> str:
    """Write a small raw CSV the way the source generators do (pandas style)."""
    import csv

    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL)
        w.writerow(header)
        for line in lines:
            w.writerow(["" if v is None else v for v in line])
    return path
