"""Lake layout and sinks: ``{root}/{raw,bronze,silver,gold}/{table}``.

One ``root`` argument replaces the source pipeline's bucket and key strings;
it can be any Hadoop file system URI.  Tables are written whole, as the source
pipeline overwrote one object per table, each write as a new version (see
``snapshots``): a reader has the old or the new table, and a write that breaks
off loses nothing.  Written tables are also the lineage cut between layers:
gold reads silver from storage, never through the silver job's plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from bankmart.sources.snapshots import SnapshotTable, Version

LAYERS = ("raw", "bronze", "silver", "gold", "state")


@dataclass
class Lake:
    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def snapshots(self, layer: str, table: str) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path(layer, table))

    def version(self, layer: str, table: str) -> Version:
        """The newest version with the counts observed while it was written."""
        return self.snapshots(layer, table).version()

    def table(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """A table of the lake (bronze / silver / gold), its newest version by default."""
        return self.snapshots(layer, table).read(version)

    def write(self, df: DataFrame, layer: str, table: str, partition_by: list[str] | None = None,
              counts: dict[str, F.Column] | None = None) -> int:
        """``df`` as the new version of ``layer/table``; returns the rows written.

        Rows and ``counts`` are observed during the write itself, so the table
        is not scanned a second time.
        """
        return self.snapshots(layer, table).write(df, partition_by, counts).rows

    def register(self, layer: str, tables: list[str]) -> list[str]:
        """Temp views ``{layer}_{table}`` over written tables (catalog step)."""
        names = []
        for t in tables:
            name = f"{layer}_{t}"
            self.table(layer, t).createOrReplaceTempView(name)
            names.append(name)
        return names

    def register_catalog(self, layer: str, tables: list[str], database: str | None = None) -> list[str]:
        """External catalog tables ``{database}.{table}`` (by default ``{layer}``) over the
        newest versions, with their partitions found and the statistics of tables
        and columns collected, so that joins and scans are planned by them."""
        database = database or layer
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root.rstrip('/')}/_databases/{database}'")
        names = []
        for t in tables:
            name = f"`{database}`.`{t}`"
            of = self.version(layer, t)
            if len(of.data) > 1:
                raise ValueError(f"{layer}/{t} grew by increments: write it as one version first")
            folder, = of.data
            parted = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in of.partitions)})" if of.partitions else ""
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.spark.sql(f"CREATE TABLE {name} ({StructType.fromJson(of.schema).toDDL()}) USING parquet {parted} "
                           f"LOCATION '{self.path(layer, t)}/{folder}'")
            if of.partitions:
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            known = [f"`{f.name}`" for f in self.spark.table(name).schema if not isinstance(f.dataType, (StructType, ArrayType, MapType))]
            self.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(known)}")
            names.append(f"{database}.{t}")
        return names

    def export_csv(self, df: DataFrame, name: str, files: int | None = None) -> str:
        """Header CSV export of a gold result for dashboards, a file per partition.

        ``files`` asks for so many files instead (1 for tools that read one).
        """
        out = f"{self.root.rstrip('/')}/exports/{name}"
        data = df.repartition(files) if files else df
        data.write.mode("overwrite").option("header", True).option("escape", '"').csv(out)
        return out
