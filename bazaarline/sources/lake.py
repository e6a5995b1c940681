"""Layered Parquet storage under one root; the path prefix picks the file system."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..session import KEPT
from .buckets import BucketTable


class Lake:
    """``Lake(spark, root)`` reads and writes ``root/<layer>/<name>``.

    ``root`` may be ``file:``, ``hdfs:`` or ``s3a:``. Snapshot tables (dimensions) are kept as
    ``v=<n>`` folders: a merge writes version n+1 completely and then an empty ``_PUBLISHED`` file.
    Readers take the newest version that has one, so a failed write is never seen, whatever
    committer is in use; no version is ever written into a folder that exists.
    """

    MARKER = "_PUBLISHED"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str, schema=None) -> DataFrame | None:
        """The dataset, or None where it does not exist (or holds no file yet)."""
        if not self.exists(layer, name):
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.parquet(self.path(layer, name))
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return None
            raise

    def write(self, df: DataFrame, layer: str, name: str, mode: str = "overwrite",
              partition_by: Sequence[str] = ()) -> str:
        path = self.path(layer, name)
        writer = df.write.mode(mode).options(**KEPT)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return path

    def replace_partition(self, df: DataFrame, layer: str, name: str, column: str, value: str) -> str:
        """Write one partition ``column=value`` whole; a rerun replaces it and leaves the others."""
        path = f"{self.path(layer, name)}/{column}={value}"
        df.drop(column).write.mode("overwrite").options(**KEPT).parquet(path)
        return path

    def exists(self, layer: str, name: str) -> bool:
        fs, path = self._fs(self.path(layer, name))
        return fs.exists(path)

    # -- snapshot tables ---------------------------------------------------------------

    def _fs(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def _versions(self, name: str) -> dict[int, bool]:
        """Versions by number, and whether they are published."""
        fs, base = self._fs(self.path("warehouse", name))
        if not fs.exists(base):
            return {}
        found = {}
        for status in fs.listStatus(base):
            folder = status.getPath().getName()
            if folder.startswith("v="):
                found[int(folder[2:])] = fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), self.MARKER))
        return found

    def snapshot(self, name: str, schema) -> DataFrame:
        """Newest committed version of a snapshot table, or an empty table. A table in buckets is read by its manifest."""
        if self.exists("warehouse", f"{name}/manifest"):
            in_buckets = BucketTable(self, name, "", "", schema)
            manifest = in_buckets.manifest()
            if manifest.version:
                return in_buckets.read(manifest)
        versions = [v for v, published in self._versions(name).items() if published]
        if not versions:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path('warehouse', name)}/v={max(versions)}")

    def publish(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as the next version and return it read back from there."""
        path = f"{self.path('warehouse', name)}/v={max(self._versions(name), default=0) + 1}"
        df.write.mode("errorifexists").options(**KEPT).parquet(path)
        fs, marker = self._fs(f"{path}/{self.MARKER}")
        fs.create(marker, False).close()
        return self.spark.read.schema(df.schema).parquet(path)

    # -- fact tables -------------------------------------------------------------------

    def facts(self, name: str, schema) -> DataFrame:
        found = self.read("warehouse", name)
        return self.spark.createDataFrame([], schema) if found is None else found

    def append_facts(self, df: DataFrame, name: str, partition_by: Sequence[str] = ("date_month",)) -> None:
        self.write(df, "warehouse", name, mode="append", partition_by=partition_by)

    def scratch(self, label: str) -> str:
        return f"{self.root}/_scratch/{label}-{uuid.uuid4().hex}"
