"""Keyed tables in hash buckets: a change writes the buckets it touches and a new list of all."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import KEPT

BUCKET_ROWS = 100_000   # rows of a bucket; at twice as many on average the number of buckets doubles


@dataclass
class Manifest:
    """Where each bucket is: its generation of files, its rows, and the largest value of the numbered column."""

    version: int = 0
    buckets: int = 0
    entries: dict[int, tuple[int, int, int]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(rows for _, rows, _ in self.entries.values())

    @property
    def top(self) -> int:
        return max((top for _, _, top in self.entries.values()), default=0)


class BucketTable:
    """``warehouse/<name>`` as ``data/g=<generation>/b=<bucket>`` and ``manifest/m=<n>``.

    A change writes a new generation of the touched buckets, then the next manifest, then its marker. Readers take the newest
    manifest that has one and only the folders it names, so files of a change that failed are never seen, and
    buckets that did not change are not written again. One writer at a time. Old generations and manifests stay for
    readers that began before; ``vacuum`` removes those no longer named. The manifest has one row per bucket.
    """

    def __init__(self, lake, name: str, key: str, number: str, schema: StructType, bucket_rows: int | None = None):
        self.lake, self.name, self.key, self.number, self.schema = lake, name, key, number, schema
        self.bucket_rows = bucket_rows or BUCKET_ROWS
        self.base = lake.path("warehouse", name)

    def _children(self, folder: str, prefix: str) -> list[tuple[int, str]]:
        fs, path = self.lake._fs(f"{self.base}/{folder}")
        found = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted((int(p.getName()[len(prefix):]), p.toString()) for p in found if p.getName().startswith(prefix))

    def exists(self) -> bool:
        return self.manifest().version > 0

    def manifest(self, pinned: int | None = None) -> Manifest:
        """The newest manifest, or the one of a given version (0: an empty table)."""
        for version, path in reversed(self._children("manifest", "m=")):
            if pinned is not None and version != pinned:
                continue
            fs, marker = self.lake._fs(f"{path}/{self.lake.MARKER}")
            if fs.exists(marker):
                rows = self.lake.spark.read.parquet(path).collect()  # one row per bucket
                return Manifest(version, rows[0]["buckets"] if rows else 1,
                                {r["bucket"]: (r["generation"], r["rows"], r["top"]) for r in rows if r["bucket"] is not None})
        return Manifest()

    def bucket_of(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def touched(self, keys: DataFrame, manifest: Manifest) -> list[int]:
        """Buckets that hold any of the keys: at most all of them."""
        return sorted(r[0] for r in keys.select(self.bucket_of(F.col(self.key), manifest.buckets)).distinct().collect())

    def read(self, manifest: Manifest | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """The table, or some of its buckets."""
        manifest = manifest or self.manifest()
        wanted = manifest.entries if only is None else [b for b in only if b in manifest.entries]
        paths = [f"{self.base}/data/g={manifest.entries[b][0]}/b={b}" for b in wanted]
        spark = self.lake.spark
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def replace(self, rows: DataFrame, manifest: Manifest, gone: Iterable[int], buckets: int | None = None,
                derived: Mapping[str, Column] | None = None) -> Manifest:
        """Write ``rows`` as the new content of the buckets ``gone`` (all of ``rows`` must belong there) and publish.

        ``derived`` gives columns that follow from the others: they are made again behind the shuffle instead of sent through it.
        """
        buckets = buckets or manifest.buckets
        generation = max((g for g, _ in self._children("data", "g=")), default=0) + 1
        path = f"{self.base}/data/g={generation}"
        rows.withColumn("b", self.bucket_of(F.col(self.key), buckets)).drop(*(derived or {})).hint("rebalance", "b") \
            .withColumns(dict(derived or {})) \
            .write.mode("errorifexists").options(**KEPT).partitionBy("b").parquet(path)
        written = self.lake.spark.read.schema(StructType([*self.schema.fields, StructField("b", IntegerType())])).parquet(path).groupBy("b").agg(
            F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(self.number), F.lit(0)).alias("top")).collect()
        gone = set(gone)
        entries = {b: e for b, e in manifest.entries.items() if b not in gone and buckets == manifest.buckets}
        entries |= {r["b"]: (generation, r["rows"], r["top"]) for r in written}
        return self._publish(Manifest(manifest.version, buckets, entries))

    def _publish(self, manifest: Manifest) -> Manifest:
        version = max((m for m, _ in self._children("manifest", "m=")), default=0) + 1
        path = f"{self.base}/manifest/m={version}"
        rows = [(manifest.buckets, b, *e) for b, e in sorted(manifest.entries.items())] or [(manifest.buckets, None, None, None, None)]
        self.lake.spark.createDataFrame(rows, "buckets int, bucket int, generation int, rows long, top long").coalesce(1) \
            .write.mode("errorifexists").parquet(path)
        fs, marker = self.lake._fs(f"{path}/{self.lake.MARKER}")
        fs.create(marker, False).close()
        return Manifest(version, manifest.buckets, manifest.entries)

    def merge(self, batch: DataFrame, dirty: Callable[[DataFrame, DataFrame], DataFrame],
              change: Callable[[DataFrame, DataFrame, int | None], DataFrame], first: DataFrame | None = None) -> Manifest:
        """Merge a batch. ``dirty(old, batch)`` gives the keys that will change, ``change(old, batch, top)`` the new rows of
        their buckets. Only the buckets of the batch are read, only those of dirty keys written; without dirty
        keys nothing is. ``first`` holds the rows of a table kept in another way before."""
        from ..session import materialise

        manifest = self.manifest()
        if not manifest.version:
            rows = materialise(change(first if first is not None else self.lake.spark.createDataFrame([], self.schema), batch, None), "first-buckets")
            return self.replace(rows, Manifest(), [], max(1, -(-rows.count() // self.bucket_rows)))
        batch = materialise(batch, "batch")
        old = self.read(manifest, self.touched(batch, manifest))
        keys = materialise(dirty(old, batch).select(self.key).distinct(), "dirty-keys")
        gone = self.touched(keys, manifest)
        if not gone:
            return manifest
        chosen = batch.join(keys.withColumnRenamed(self.key, "__key"), F.col(self.key).eqNullSafe(F.col("__key")), "left_semi")
        rows = change(self.read(manifest, gone), chosen, manifest.top)
        done = self.replace(rows, manifest, gone)
        if done.rows > 2 * self.bucket_rows * done.buckets:
            done = self.replace(self.read(done), done, done.entries, 2 * done.buckets)
        return done

    def vacuum(self, pinned: int | None = None) -> int:
        """Remove generations and manifests other than those of the newest (or a pinned) manifest; returns the generations removed."""
        manifest = self.manifest(pinned)
        named = {g for g, _, _ in manifest.entries.values()}
        old = [p for g, p in self._children("data", "g=") if g not in named]
        for path in [*old, *[p for m, p in self._children("manifest", "m=") if m != manifest.version]]:
            fs, where = self.lake._fs(path)
            fs.delete(where, True)
        return len(old)
