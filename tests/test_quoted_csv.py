"""CSV with line breaks in quoted fields, read by many splits, against Python's reader."""

from __future__ import annotations

import csv
import os
import random

import pytest

from bankmart.schemas import BRONZE_COLUMNS
from bankmart.sources.bronze import CORRUPT, corrupt_counts, read_bronze, read_csv_text

NAMES = BRONZE_COLUMNS["loans"]
PIECES = ["a", "42", ",", '"', "\n", "\n\n", " ", "x" * 40, "é", '""', "\r\n", "'", "#"]


def written(folder: str, rows: list[list[str]], files: int, line_end: str) -> None:
    os.makedirs(folder)
    step = -(-len(rows) // files)
    for i in range(files):
        with open(os.path.join(folder, f"{i}.csv"), "w", newline="", encoding="utf-8") as fh:
            out = csv.writer(fh, lineterminator=line_end)
            out.writerow(NAMES)
            out.writerows(rows[i * step:(i + 1) * step])


def cells(rng: random.Random) -> list[str]:
    return ["k" + "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 1, 2, 5]))) + "v" for _ in NAMES]


@pytest.mark.parametrize(("split", "line_end"), [(64, "\n"), (257, "\r\n"), (4096, "\n"), (1 << 20, "\n")])
def test_same_rows_as_python(spark, scratch, split, line_end):
    rng = random.Random(split)
    rows = [cells(rng) for _ in range(150)] + [["k" + "long\n" * 300 + "v", *cells(rng)[1:]]] + [cells(rng) for _ in range(20)]
    written(os.path.join(scratch, "loans"), rows, 3, line_end)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        text = read_csv_text(spark, os.path.join(scratch, "loans"), "loans")
        got = [list(r) for r in text.orderBy("_arrival").select(*NAMES).collect()]
        assert got == rows  # in file order, too
        assert corrupt_counts({"loans": text}).first().corrupt_rows == 0
        assert read_bronze(spark, os.path.join(scratch, "loans"), "loans").count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_blank_lines_missing_end_and_open_quote(spark, scratch):
    folder = os.path.join(scratch, "loans")
    os.makedirs(folder)
    row = ",".join(f"g{i}" for i in range(len(NAMES)))
    with open(os.path.join(folder, "a.csv"), "w", encoding="utf-8") as fh:
        fh.write(",".join(NAMES) + "\n\n" + row + "\n   \n" + row + '\n"never closed,' + row + "\n" + row)
    text = read_csv_text(spark, folder, "loans").collect()
    assert sorted(r.loan_id == "g0" for r in text) == [False, True, True]
    assert sum(r[CORRUPT] is not None for r in text) == 1  # the open quote takes the rest of the file


def test_header_alone_and_empty_cells(spark, scratch):
    folder = os.path.join(scratch, "loans")
    written(folder, [], 1, "\n")
    assert read_csv_text(spark, folder, "loans").count() == 0
    other = os.path.join(scratch, "more")
    written(other, [[""] * len(NAMES), ["x"] + [""] * (len(NAMES) - 1)], 2, "\n")
    assert sorted(str(r.loan_id) for r in read_csv_text(spark, other, "loans").collect()) == ["None", "x"]
