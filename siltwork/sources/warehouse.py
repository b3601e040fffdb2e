"""The catalog: layers, tables, and publishing a written batch as a table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.operators.constraints import VIOLATIONS
from siltwork.schemas import LAYERS, SPECS
from siltwork.sources.delimited import BAD_LINE
from siltwork.sources.staging import REJECTED


@dataclass(frozen=True)
class Warehouse:
    """Three databases under one root folder that all executors share.

    ``prefix`` is put before the layer names, so several warehouses can live in
    one catalog.
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def table_name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.table_name(layer, table))

    def layer_path(self, layer: str) -> str:
        return f"{self.root}/{self.database(layer)}"

    def batch_path(self, layer: str, table: str, batch: str) -> str:
        return f"{self.layer_path(layer)}/{table}/batch={batch}"

    def create_layers(self) -> None:
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} "
                f"LOCATION '{self.layer_path(layer)}'"
            )

    def reset(self, confirm: bool = False) -> None:
        """Drop all layers with their tables and data, and create them empty."""
        if not confirm:
            raise ValueError("reset deletes every table; pass confirm=True")
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")
            folder, files = self._manifests(layer)
            files.delete(folder, True)
        self.create_layers()

    def recreate_table(self, layer: str, table: str, path: str | None = None) -> None:
        """Drop the table if it exists and create it empty with its declared layout.

        Published batches keep their files; only the table is replaced. Its
        folder is a new one, so rows inserted before do not come back. Snapshots
        do not show the table until a batch is published.
        """
        version, batches = self._manifest(layer)
        if batches.pop(table, None):
            self._write_manifest(layer, version + 1, batches)
        name = self.table_name(layer, table)
        path = path or f"{self.layer_path(layer)}/{table}/empty-{uuid.uuid4().hex[:12]}"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._create(name, SPECS[table].ddl(layer), path)

    def recreate_tables(self, layer: str) -> None:
        for table in SPECS:
            self.recreate_table(layer, table)

    def publish(self, layer: str, table: str, path: str, ddl: str | None = None) -> None:
        """Point the table at a completely written batch.

        Readers see the old batch until this catalog update and the new one
        after it; a load that fails earlier leaves the table as it was. ``ddl``
        lays out tables that are not in the registry.
        """
        self.publish_together(layer, {table: (path, ddl)})

    def publish_together(
        self, layer: str, batches: Mapping[str, tuple[str, str | None]]
    ) -> None:
        """Point several tables at their batches, given as path and, if any, layout.

        The layer's manifest, which names the batches of all its tables, is replaced in
        one step, so whoever reads by ``snapshot`` sees all of them or none. The catalog
        follows table by table.
        """
        made = {
            table: {"path": path, "ddl": ddl or SPECS[table].ddl(layer)}
            for table, (path, ddl) in batches.items()
        }
        version, before = self._manifest(layer)
        self._write_manifest(layer, version + 1, before | made)
        for table, batch in made.items():
            self._point(self.table_name(layer, table), batch["ddl"], batch["path"])

    def _point(self, name: str, ddl: str, path: str) -> None:
        if not self.spark.catalog.tableExists(name):
            self._create(name, ddl, path)
            return
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(name)

    def snapshot(self, layer: str) -> dict[str, DataFrame]:
        """The layer's published tables as of one moment, whatever is published later."""
        _, batches = self._manifest(layer)
        return {
            table: self.spark.read.schema(_columns(batch["ddl"])).parquet(batch["path"])
            for table, batch in batches.items()
        }

    def _manifests(self, layer: str):
        """The folder of the layer's manifests, and its file system."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.layer_path(layer)}/_manifests")
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _manifest(self, layer: str) -> tuple[int, dict[str, dict]]:
        """Number and content of the newest manifest; 0 and nothing before the first."""
        folder, files = self._manifests(layer)
        if not files.exists(folder):
            return 0, {}
        found = [entry.getPath() for entry in files.listStatus(folder)]
        numbered = [(int(p.getName()), p) for p in found if p.getName().isdigit()]
        if not numbered:
            return 0, {}
        version, newest = max(numbered, key=lambda n: n[0])
        stream = files.open(newest)
        try:
            read = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return version, json.loads(read)

    def _write_manifest(self, layer: str, version: int, batches: dict[str, dict]) -> None:
        """A new manifest appears whole, under a number that none has yet."""
        folder, files = self._manifests(layer)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        hidden = path(folder, f"_{uuid.uuid4().hex}")
        stream = files.create(hidden)
        try:
            stream.write(bytearray(json.dumps(batches).encode()))
        finally:
            stream.close()
        shown = path(folder, f"{version:020}")
        if files.exists(shown) or not files.rename(hidden, shown):
            files.delete(hidden, False)
            raise RuntimeError(f"another load has published to {layer} at the same time")

    def rejects(self, layer: str, table: str) -> DataFrame:
        """Rows set aside when the published batch was loaded, with the reason."""
        batch = self._location(layer, table).rsplit("/", 1)[0]
        reason = BAD_LINE if layer == "bronze" else VIOLATIONS
        # Declared, since a batch without rows has no file to tell its layout.
        layout = T.StructType(list(self.table(layer, table).schema.fields))
        layout = layout.add(reason, T.StringType()).add(REJECTED, T.BooleanType())
        rows = self.spark.read.schema(layout).parquet(batch)
        return rows.where(F.col(REJECTED)).drop(REJECTED)

    def remove_old_batches(self, layer: str, table: str) -> list[str]:
        """Delete the table's batches other than the published one; returns their paths.

        A refresh leaves the replaced batch in place, since queries may still be
        reading it. Call this once they are done.
        """
        current = self._location(layer, table)
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.layer_path(layer)}/{table}")
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        removed = []
        for entry in files.listStatus(folder):
            batch = entry.getPath()
            if batch.getName() not in current.split("/"):
                files.delete(batch, True)
                removed.append(batch.toString())
        return removed

    def _location(self, layer: str, table: str) -> str:
        details = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table_name(layer, table)}")
        return details.where("col_name = 'Location'").first()["data_type"]

    def _create(self, name: str, ddl: str, path: str) -> None:
        self.spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{path}'")


def _columns(ddl: str) -> T.StructType:
    """A layout as a reader takes it: texts of any length, no defaults, all optional."""
    fields = T.StructType.fromDDL(ddl).fields
    texts = (T.VarcharType, T.CharType)
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, texts) else f.dataType)
            for f in fields
        ]
    )
