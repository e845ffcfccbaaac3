"""Removal of repeated runs of lines by winnowing, in DataFrame functions.

A document is its sequence of lines that aren't blank, hashed without the
white space around them.  A window starts at each line and is the least run
of lines with ``MIN_WORDS`` words.  A window selects its least line hash (the
first of equals); neighbouring windows mostly select the same place, and one row
stands for all windows of a selected place, its fingerprint the line's hash.
A repeated run of at least ``MIN_WORDS`` words holds a whole window, so both
places of it select equal fingerprints: places whose fingerprint is selected
once go, before any window is looked at by itself.  The others are joined by
fingerprint, with the hash of the window around it, to the first place of that
window, and each match is extended line by line both ways.  Backward, a line
that matches too starts a matching window itself, so that is what neighbouring
matches with one offset are; forward, the tail after the last of them is
extended, which is shorter than a window.  Every run that so repeats an
earlier place is deleted; a window that overlaps its first place in the same
document is not a repeat.  Earlier is by document id (null last), then row,
then line.

Line and window hashes have 64 bits; two different lines of n fall together
with odds of about n * n / 2 ** 65.

Defined results: null text stays null and has no lines; empty texts and
documents under ``MIN_WORDS`` words stay as they are; very long texts take time
by their lines times ``MIN_WORDS``; of repeated rows the first stays whole; an
empty table gives no rows; all columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import written

MIN_WORDS = 50


def _lines(text: Column) -> Column:
    """at, hash and number of words of the lines that aren't blank."""
    lines = F.transform(F.split(text, "\n"), lambda line, at: F.struct(at.alias("at"), F.trim(F.translate(line, "\r\t", "  ")).alias("s")))
    return F.transform(F.filter(lines, lambda x: x["s"] != ""), lambda x: F.struct(
        x["at"].alias("at"), F.xxhash64(x["s"]).alias("h"), F.size(F.split(x["s"], " +")).alias("words")))


def _windows(lines: Column, min_words: int) -> Column:
    """Of the window from each line, where there are words enough: first line, and w with
    its number of lines, least line hash (the first of equals) and where, and hash."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("n"), F.lit((1 << 63) - 1).cast("long").alias("least"), F.lit(0).alias("at"),
                     F.lit(7).cast("long").alias("h"))

    def add(acc: Column, x: Column) -> Column:
        less = x["h"] < acc["least"]
        return F.when(acc["words"] >= min_words, acc).otherwise(F.struct(
            (acc["words"] + x["words"]).alias("words"), (acc["n"] + 1).alias("n"), F.least(acc["least"], x["h"]).alias("least"),
            F.when(less, acc["n"]).otherwise(acc["at"]).alias("at"), F.xxhash64(acc["h"], x["h"]).alias("h")))

    # a window of one line needs no scan of the lines after it
    def one(x: Column) -> Column:
        return F.struct(x["words"].alias("words"), F.lit(1).alias("n"), x["h"].alias("least"), F.lit(0).alias("at"),
                        F.xxhash64(F.lit(7).cast("long"), x["h"]).alias("h"))

    found = F.transform(lines, lambda x, i: F.struct(i.alias("first"), F.when(x["words"] >= min_words, one(x)).otherwise(
        F.aggregate(F.slice(lines, i + 1, min_words), start, add)).alias("w")))
    return F.filter(found, lambda x: x["w"]["words"] >= min_words)


def selected(lines: DataFrame, min_words: int) -> DataFrame:
    """_row, _id, least and windows (i, n, h) of every place that windows select."""
    held = lines.select("_row", "_id", _windows(F.col("_lines"), min_words).alias("_w")).where("size(_w) > 0")

    def place(x: Column) -> Column:
        return x["first"] + x["w"]["at"]

    # windows that select one place follow each other
    begins = F.filter(F.sequence(F.lit(0), F.size("_w") - 1), lambda k: (k == 0) | (place(F.get("_w", k)) != place(F.get("_w", k - 1))))
    held = held.select("_row", "_id", "_w", begins.alias("_b"))
    each = F.transform("_b", lambda k, j: F.slice("_w", k + 1, F.coalesce(F.get("_b", j + 1), F.size("_w")) - k))
    held = held.select("_row", "_id", F.explode(each).alias("ws"))
    return held.select("_row", "_id", F.col("ws")[0]["w"]["least"].alias("least"), F.transform("ws", lambda x: F.struct(
        x["first"].alias("i"), x["w"]["n"].alias("n"), x["w"]["h"].alias("h"))).alias("windows"))


def repeated_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Row and raw line range (first, last) of every run that repeats an earlier
    place, for a written table of _row, _id and _lines."""
    places = written(selected(lines, min_words), "line-places")
    often = places.groupBy("least").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("least")
    windows = places.join(often, "least", "left_semi").select("_row", "_id", "least", F.explode("windows").alias("x"))
    windows = written(windows.select("_row", "_id", "least", "x.i", "x.n", "x.h"), "line-windows")
    # null ids come last: the flag orders before the id
    place = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"), F.col("i").alias("i"))
    firsts = (windows.groupBy("least", "h").agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("c")).where("c > 1")
              .select("least", "h", F.col("p.row").alias("row0"), F.col("p.i").alias("i0")))
    matches = windows.join(firsts, ["least", "h"]).where((F.col("_row") != F.col("row0")) | (F.col("i") >= F.col("i0") + F.col("n")))
    matches = written(matches.select("_row", "i", "n", "row0", (F.col("i0") - F.col("i")).alias("delta")), "line-matches")

    run = Window.partitionBy("_row", "row0", "delta").orderBy("i")
    last = matches.withColumn("after", F.lead("i").over(run)).where("after is null or after > i + 1")
    tail = (last.select("_row", "row0", "delta", (F.col("i") + F.col("n")).alias("at"))
            .join(lines.select("_row", F.col("_lines.h").alias("own")), "_row")
            .select("_row", "row0", "at", "delta", F.slice("own", F.col("at") + 1, min_words).alias("own"))
            .join(lines.select(F.col("_row").alias("row0"), F.col("_lines.h").alias("other")), "row0")
            .select("_row", "at", F.arrays_zip(F.col("own").alias("a"), F.slice("other", F.col("at") + F.col("delta") + 1, min_words).alias("b")).alias("ab")))
    differs = F.array_position(F.transform("ab", lambda x: ~F.coalesce(x["a"] == x["b"], F.lit(False))), F.lit(True))
    tail = tail.select("_row", F.col("at").alias("i"), F.when(differs > 0, differs - 1).otherwise(F.size("ab")).cast("int").alias("n")).where("n > 0")

    # join touching ranges
    ranges = matches.select("_row", "i", (F.col("i") + F.col("n")).alias("e")).unionByName(tail.select("_row", "i", (F.col("i") + F.col("n")).alias("e")))
    ranges = ranges.groupBy("_row", "i").agg(F.max("e").alias("e"))
    in_row = Window.partitionBy("_row").orderBy("i")
    reach = F.max("e").over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("new", F.coalesce((F.col("i") > reach).cast("int"), F.lit(1))).withColumn("island", F.sum("new").over(in_row))
    return ranges.groupBy("_row", "island").agg(F.min("i").alias("i"), F.max("e").alias("e")).select("_row", "i", "e")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later repeats deleted from the text column, and the
    columns n_lines_ and n_deleted_: its lines, and how many went."""
    held = written(docs.withColumn("_row", F.monotonically_increasing_id()), "line-docs")
    lines = written(held.select("_row", F.col(id_col).cast("long").alias("_id"), _lines(F.col(text_col)).alias("_lines"))
                    .where("size(_lines) > 0"), "lines")
    runs = repeated_runs(lines, min_words)
    # runs count lines that aren't blank; here back to lines of the text
    raw = (runs.groupBy("_row").agg(F.collect_list(F.struct("i", "e")).alias("runs"))
           .join(lines.select("_row", F.col("_lines.at").alias("at")), "_row")
           .select("_row", F.transform("runs", lambda r: F.struct(
               F.get("at", r["i"]).alias("lo"), F.get("at", r["e"] - 1).alias("hi"))).alias("_runs")))
    out = held.join(raw, "_row", "left")
    split = F.split(F.col(text_col), "\n")
    kept = F.filter(split, lambda line, at: ~F.exists("_runs", lambda r: at.between(r["lo"], r["hi"])))
    gone = F.aggregate("_runs", F.lit(0), lambda n, r: n + (r["hi"] - r["lo"] + 1).cast("int"))
    return out.withColumns({
        text_col: F.when(F.col("_runs").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")),
        "n_lines_": F.coalesce(F.size(split), F.lit(0)), "n_deleted_": F.coalesce(gone, F.lit(0)),
    }).drop("_row", "_runs")
