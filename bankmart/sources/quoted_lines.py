"""CSV records whose quoted fields may hold line breaks, read split by split.

A file is read as lines, in the splits that Spark makes of it.  A line break
stands inside a quoted field where the quotes before it are odd in number, so
a first pass counts the quotes of each split and sums them up per file: then
every split knows whether it starts inside a quoted field.  A second pass
joins lines to records within a split.  What a record has in the next splits
goes on as fragments (two per split at most), and those alone are shuffled and
joined; where no split starts inside a field there are none.

Quotes are read as the format's rules (RFC 4180) write them: a field that holds
one is quoted and has it doubled.  A stray quote in an unquoted field makes
one record of all lines up to the next quote, with a wrong number of cells.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bankmart.session import ship_library, staged

WHOLE, TAIL, REST = 0, 1, 2  # parts: a whole record, the start of one at a split's end, lines of an earlier split's
_OUT = pa.schema([("file", pa.string()), ("block", pa.int64()), ("pos", pa.int64()), ("part", pa.int64()), ("value", pa.string())])
OUT = "file string, block long, pos long, part long, value string"


def text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with their file, split and order."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), "value")


def split_states(lines: DataFrame) -> DataFrame:
    """file, block, and whether the split starts and ends inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    upto = F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) % 2
    return odd.select("file", "block", ((upto + F.col("odd")) % 2 == 1).alias("starts_inside"), (upto == 1).alias("ends_inside"))


class _Joiner:
    """Joins the lines of splits, given in order, to records."""

    def __init__(self, header: list[str], delimiter: str):
        self.header, self.delimiter = header, delimiter
        self.split: tuple | None = None
        self.inside = self.heading = False
        self.open: list[str] = []  # lines of the record that isn't complete yet
        self.start, self.part = 0, WHOLE
        self.out: list[tuple] = []

    def emit(self, part: int, pos: int, text: str) -> None:
        if self.heading and part != REST:
            found = next(csv.reader([text.removeprefix("﻿").removesuffix("\r")], delimiter=self.delimiter), [])
            if found != self.header:
                raise ValueError(f"the header of {self.split[0]} is not the first file's: {found}")
            self.heading = False
        elif part != WHOLE or text.strip():  # blank lines are no records
            self.out.append((*self.split, pos, part, text))

    def close(self) -> None:
        """The split ends: an open record goes on in the next one."""
        if self.open:
            self.emit(REST if self.part == REST else TAIL, self.start, "\n".join(self.open))
            self.open = []

    def begin(self, split: tuple, inside: bool) -> None:
        self.close()
        self.split, self.inside, self.heading = split, inside, split[1] == 0
        self.part = REST if inside else WHOLE

    def lines(self, pos: np.ndarray, value: pa.Array) -> None:
        """The next lines of the split; records of one line stay in Arrow."""
        odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False) & 1
        state = (np.cumsum(odd) + self.inside) & 1  # after each line
        before = np.append(int(self.inside), state[:-1])
        single = (before == 0) & (state == 0)
        at = np.flatnonzero(~single)
        if self.heading and single[0]:
            self.emit(WHOLE, int(pos[0]), value[0].as_py())
            single[0] = False
        blank = pc.equal(pc.utf8_trim_whitespace(value), "").to_numpy(zero_copy_only=False)
        self.singles.append((np.flatnonzero(single & ~blank), pos, value, self.split))
        for i, text in zip(at.tolist(), value.take(pa.array(at)).to_pylist(), strict=True):
            if not self.open:
                self.start = int(pos[i])
            self.open.append(text)
            if not state[i]:
                self.emit(self.part, self.start, "\n".join(self.open))
                self.open, self.part = [], WHOLE
        self.inside = bool(state[-1])

    def batch(self, got: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        self.singles: list[tuple] = []
        file, block, pos, value, inside = got.columns
        changes = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(changes) + 1).tolist(), got.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            split = (file[lo].as_py(), block[lo].as_py())
            if split != self.split:
                self.begin(split, inside[lo].as_py())
            self.lines(pos[lo:hi].to_numpy(), value[lo:hi])
        for at, where, text, split in self.singles:
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(split[0]), len(at)), pa.repeat(pa.scalar(split[1], pa.int64()), len(at)), pa.array(where[at]),
                     pa.repeat(pa.scalar(WHOLE, pa.int64()), len(at)), text.take(pa.array(at))], schema=_OUT)
        yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.out:
            columns = list(zip(*self.out, strict=True))
            self.out = []
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT)


def _joined(header: list[str], delimiter: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joiner = _Joiner(header, delimiter)
        for got in batches:
            if got.num_rows:
                yield from joiner.batch(got)
        joiner.close()
        yield from joiner.rest()

    return run


def records(spark: SparkSession, paths: str | list[str], header: list[str], delimiter: str = ",") -> DataFrame:
    """file, block, pos (of a record's start) and value, the text of every record but the
    headers; a file with another header than ``header`` fails the read."""
    ship_library(spark)
    lines = text_lines(spark, paths)
    # a row per split, as the driver holds one for every task anyway
    states = staged(split_states(lines), "split-states")
    known = lines.join(F.broadcast(states), ["file", "block"])
    run = _joined(header, delimiter)

    def joined(lines: DataFrame) -> DataFrame:
        return lines.select("file", "block", "pos", "value", "starts_inside").mapInArrow(run, OUT)

    whole = joined(known).where(F.col("part") == WHOLE).select("file", "block", "pos", "value")
    if not states.where("starts_inside or ends_inside").limit(1).count():
        return _without_return(whole)
    parts = joined(known.where("starts_inside or ends_inside")).where(F.col("part") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "pos")
    parts = parts.withColumn("record", F.sum((F.col("part") == TAIL).cast("int")).over(order))
    stitched = parts.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "pos", "value"))).alias("p")).select(
        "file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["pos"].alias("pos"),
        F.concat_ws("\n", F.transform("p", lambda x: x["value"])).alias("value"))
    return _without_return(whole.unionByName(stitched))


def _without_return(found: DataFrame) -> DataFrame:
    """Lines may end in a carriage return too."""
    end = F.expr("if(endswith(value, '\r'), left(value, length(value) - 1), value)")
    return found.withColumn("value", end)
