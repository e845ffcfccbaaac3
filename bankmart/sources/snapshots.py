"""Versions of a table in a folder of any Hadoop file system.

A version is a folder of data files of its own and a manifest, a small JSON
file that is written when the data are complete.  Readers go by the newest
manifest, so they see the old or the new table and nothing between; a write
that breaks off leaves files that no manifest names, and the table as it was.
Writers of the same next version collide at the manifest: the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bankmart.session import ensure_checkpoint_dir

MANIFESTS = "_versions"
#: Codec of data files: two thirds of the default's bytes for text.
CODEC = "zstd"
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT = "spark.sql.files.maxPartitionBytes"
#: Bytes of a table's files to a task that sorts or hashes what it reads.
MOST_SPLIT = 1 << 24
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Partitions that a task writes side by side; only a task with more of them sorts its rows.
MOST_WRITERS = 8


@contextmanager
def _setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def writers(spark: SparkSession, most: int) -> Iterator[None]:
    """Within, a task keeps up to ``most`` files open (0: as the session has it), so
    rows that go to few partitions are not sorted, nor spilled, to be written."""
    with _setting(spark, WRITERS, most) if most else nullcontext():
        yield


def freed(spark: SparkSession):
    """Within, a write's shuffle files go when it ends: its table is what others read.
    Else they stay until the driver happens to collect its garbage."""
    return _setting(spark, FREED, "true")


def narrow_splits(spark: SparkSession):
    """Within, a task reads ``MOST_SPLIT`` bytes of files at most: a row of a table
    takes some twenty bytes there and five hundred where it is sorted, so a task of
    the usual 128 MB would spill.  For tables alone: the records of a text file
    must be read in the splits in which its quotes were counted."""
    return _setting(spark, SPLIT, min(MOST_SPLIT, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a function like ``staged`` whose tables are removed at the end."""
    folder = Folder(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}")

    def stage(df: DataFrame, what: str) -> DataFrame:
        path = f"{folder.path}/{what}-{uuid.uuid4().hex}"
        with freed(spark):
            df.write.option("compression", CODEC).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        folder.remove("")


@dataclass(frozen=True)
class Version:
    """What a manifest says: counts are those observed while the data were written."""

    number: int
    data: list[str]  # folders of data files
    schema: dict
    rows: int
    partitions: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)
    index: dict = field(default_factory=dict)  # what a kind of table keeps beside its data


class Folder:
    """The few file operations that a table needs, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self.path = path.rstrip("/")
        self._fs = self._jvm.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.Path(f"{self.path}/{name}")

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file, which others see when it is complete."""
        draft, at = self._at(f"{name}.{uuid.uuid4().hex}.draft"), self._at(name)
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        if self._fs.exists(at) or not self._fs.rename(draft, at):
            self._fs.delete(draft, False)
            raise FileExistsError(f"{self.path}/{name}: another writer was first")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._folder = spark, path.rstrip("/"), Folder(spark, path)

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._folder.names(MANIFESTS) if n.removesuffix(".json").isdigit()]

    def version(self, number: int | None = None) -> Version:
        """The version of that number, or the newest."""
        known = self.numbers()
        if not known or (number is not None and number not in known):
            raise FileNotFoundError(f"{self.path} has no version{'' if number is None else f' {number}'}")
        return Version(**json.loads(self._folder.read(f"{MANIFESTS}/{known[-1] if number is None else number:012d}.json")))

    def read(self, number: int | None = None) -> DataFrame:
        of = self.version(number)
        return self._data(of, of.data)

    def read_folders(self, folders: list[str], schema: StructType | str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _data(self, of: Version, folders: list[str]) -> DataFrame:
        schema = StructType.fromJson(of.schema)
        if not of.partitions:
            return self.read_folders(folders, schema)
        # Spark finds partitions below one root at a time
        each = [self.read_folders([f], schema) for f in folders]
        return reduce(DataFrame.unionByName, each)

    @staticmethod
    def draft(what: str, number: int) -> str:
        """Name of a folder that no manifest has yet."""
        return f"{what}-{number:012d}-{uuid.uuid4().hex}"

    def next_number(self) -> int:
        return max(self.numbers(), default=0) + 1

    def write_folder(self, df: DataFrame, folder: str, partition_by: list[str] | None = None,
                     counts: dict[str, F.Column] | None = None) -> dict[str, int]:
        """Writes ``df`` to ``folder``; rows and ``counts`` as observed meanwhile."""
        seen = Observation()
        out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counts or {}).items()])
        with writers(self.spark, MOST_WRITERS if partition_by else 0), freed(self.spark):
            out.write.mode("errorifexists").option("compression", CODEC).partitionBy(*(partition_by or [])).parquet(f"{self.path}/{folder}")
        return {n: int(v or 0) for n, v in seen.get.items()}

    def commit(self, version: Version) -> Version:
        self._folder.create(f"{MANIFESTS}/{version.number:012d}.json", json.dumps(asdict(version)))
        return version

    def write(self, df: DataFrame, partition_by: list[str] | None = None, counts: dict[str, F.Column] | None = None,
              index: dict | None = None) -> Version:
        """``df`` as the next version; rows and ``counts`` are observed as it is written."""
        number = self.next_number()
        folder = self.draft("data", number)
        got = self.write_folder(df, folder, partition_by, counts)
        return self.commit(Version(number, [folder], df.schema.jsonValue(), got.pop("rows"), list(partition_by or []), got, index or {}))

    def append(self, df: DataFrame, partition_by: list[str] | None = None, counts: dict[str, F.Column] | None = None) -> Version:
        """The next version: the newest one's data and ``df``, with the same columns.
        ``counts`` are those of ``df`` alone, ``rows`` of all."""
        number = self.next_number()
        old = self.version() if number > 1 else None
        folder = self.draft("data", number)
        got = self.write_folder(df, folder, partition_by, counts)
        rows = got.pop("rows")
        return self.commit(Version(number, [*(old.data if old else []), folder], df.schema.jsonValue(), rows + (old.rows if old else 0),
                                   list(partition_by or []), got | {"added": rows}))

    def added(self, since: int | None = None) -> DataFrame:
        """The rows appended after version ``since`` (the last increment by default)."""
        of = self.version()
        return self._data(of, of.data[-1:] if since is None else of.data[since:])

    def vacuum(self, keep: int = 1) -> list[str]:
        """Removes all versions but the newest ``keep``, and what broken writes left
        behind; not while others write or read those.  Returns the folders removed."""
        known = self.numbers()
        live = {f for n in known[-keep:] for f in self._named(self.version(n))}
        gone = [n for n in self._folder.names("") if n != MANIFESTS and n not in live]
        for n in known[:-keep]:
            self._folder.remove(f"{MANIFESTS}/{n:012d}.json")
        for name in gone:
            self._folder.remove(name)
        return gone

    @staticmethod
    def _named(version: Version) -> list[str]:
        """All folders that a manifest names."""
        return [*version.data, *[f for x in version.index.values() for f in (x if isinstance(x, list) else [])]]
