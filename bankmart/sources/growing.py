"""Keep-first tables that grow by increments.

The first row of a key wins, as in ``operators/dedupe.py``, but over all
increments, given in the order of their arrival.  Beside its data a table has

* an index: the keys that were taken, in files bucketed by key, and
* a Bloom filter of them in blocks (``functions/bloom.py``).

An increment's distinct keys are looked up in the filter's blocks; those that
it may hold, the increment's true repeats and about one in a hundred others,
are looked up in the index, which is read in its buckets and not shuffled.  The
increment's rows are then deduplicated, rid of the known keys by the same
shuffle, and written: the rows themselves are shuffled once and staged nowhere.
So an increment shuffles its own rows and keys and no others.

Data, index and filter of a version are written first and its manifest last:
an increment that breaks off is as if it had not begun.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmart.functions import bloom
from bankmart.operators.dedupe import dedupe_keep_first
from bankmart.session import ensure_checkpoint_dir, staged
from bankmart.sources.snapshots import CODEC, SnapshotTable, Version, freed, scratch

DATABASE = "bankmart_growing"
KEY = "_key"
#: Files of sorted keys: a key has what it doesn't share with the one before.
KEY_FILES = {"compression": CODEC, "parquet.writer.version": "PARQUET_2_0"}
#: Keys to a block of the filter; twice as many on average and it is built anew.
BLOCK_KEYS = 2500
#: Parts of the index, one for each increment, before they are made one.
MOST_PARTS = 16


def key_text(key: str) -> Column:
    """The key as a text that is never null: null keys count as one key."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


class GrowingTable(SnapshotTable):
    def add(self, rows: DataFrame, key: str, after: Callable[[DataFrame], DataFrame] = lambda df: df) -> Version:
        """Takes the rows of an increment whose keys are new, the first of each by
        arrival, and appends ``after`` of them (columns as ever; may drop rows).
        ``rows`` are read twice, for the keys and for the rest: best from a table."""
        number = self.next_number()
        old = self.version() if number > 1 else None
        rows = rows.withColumn(KEY, key_text(key))
        with scratch(self.spark) as stage:
            keys, first = rows.select(KEY).distinct(), dedupe_keep_first(rows, KEY)
            if old:
                keys = stage(keys, "keys")
                known = self.known(old, keys, stage)
                keys, first = (df.join(known, KEY, "left_anti") for df in (keys, first))
            buckets = old.index["buckets"] if old else int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            index = [*(old.index["keys"] if old else []), self._write_keys(keys, buckets, number)]
            added = self.read_folders(index[-1:], f"{KEY} string")
            n_keys = added.count() + (old.index["n_keys"] if old else 0)
            if len(index) > MOST_PARTS:
                index = [self._write_keys(self.read_folders(index, f"{KEY} string"), buckets, number)]
            blocks = self._blocks(old) if old else 0
            if not blocks or n_keys > 2 * BLOCK_KEYS * blocks:
                blocks = buckets * max(1, -(-n_keys // (BLOCK_KEYS * buckets)))
                filters = bloom.build(self.read_folders(index, f"{KEY} string"), F.col(KEY), blocks)
            else:
                filters = bloom.merge(self._filter(old).unionByName(bloom.build(added, F.col(KEY), blocks)))
            filter_folder = self.draft("filter", number)
            self.write_folder(filters, filter_folder)
            new = after(first.drop(KEY))
            folder = self.draft("data", number)
            n = self.write_folder(new, folder)["rows"]
        return self.commit(Version(number, [*(old.data if old else []), folder], new.schema.jsonValue(), n + (old.rows if old else 0),
                                   counts={"added": n}, index={"keys": index, "filter": [filter_folder], "bucket_blocks": blocks // buckets,
                                                               "buckets": buckets, "n_keys": n_keys}))

    def known(self, of: Version, keys: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = staged) -> DataFrame:
        """Those of ``keys`` (column ``_key``) that the table of that version has taken."""
        maybe = keys
        if blocks := self._blocks(of):
            block = bloom.block_of(F.col(KEY), blocks)
            asked = keys.withColumn("block", block).join(self._filter(of), "block").where(bloom.may_hold(F.col("bits"), F.col(KEY)))
            maybe = stage(asked.select(KEY), "maybe")
        found = None
        for folder in of.index["keys"]:
            part = maybe.join(self._keys(folder, of.index["buckets"]), KEY, "left_semi")
            found = part if found is None else found.unionByName(part)
        return stage(found, "known")

    @staticmethod
    def _blocks(of: Version) -> int:
        """Blocks of its filter; none if that is of an earlier kind, whose blocks went by another hash."""
        return of.index.get("bucket_blocks", 0) * of.index["buckets"]

    def _filter(self, of: Version) -> DataFrame:
        return self.read_folders(of.index["filter"], "block long, bits binary")

    def _table(self, folder: str) -> str:
        folder_of_all = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{DATABASE}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{folder_of_all}'")
        return f"{DATABASE}.{folder.replace('-', '_')}"

    def _write_keys(self, keys: DataFrame, buckets: int, number: int) -> str:
        folder = self.draft("keys", number)
        # dealt as the files are, or every task would write a file for every bucket
        dealt = keys.repartition(buckets, KEY)
        with freed(self.spark):
            (dealt.write.options(**KEY_FILES).bucketBy(buckets, KEY).sortBy(KEY)
             .option("path", f"{self.path}/{folder}").saveAsTable(self._table(folder)))
        return folder

    def _keys(self, folder: str, buckets: int) -> DataFrame:
        """A part of the index, known to Spark by its buckets."""
        name = self._table(folder)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({KEY} string) USING parquet "
                       f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{self.path}/{folder}'")
        return self.spark.table(name)
