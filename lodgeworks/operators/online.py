"""Online snapshots in hashed buckets: a run rewrites the buckets it touches, a lookup reads those of its keys.

Every run writes new files below its own number and then a manifest that names, per bucket, the run
whose files hold it. The manifest is what makes a run visible: a lost run leaves files that nothing names, and the
version before it stays as it was. Inside a bucket rows are sorted by key, and a Bloom filter over the keys
lets the scan skip what it does not need.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeworks.operators.asof import latest_by_key
from lodgeworks.operators.store import FeatureView, snapshot
from lodgeworks.session import staged

BUCKETS = 64


class OnlineStore:
    """Newest row per key below ``root``. ``buckets`` is fixed when the store is first written."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], ts: str, buckets: int = BUCKETS) -> None:
        if buckets < 1:
            raise ValueError("a store needs a bucket")
        self.spark, self.root, self.keys, self.ts, self.buckets = spark, root.rstrip("/"), list(keys), ts, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The newest version; 0 before the first run."""
        at, files = self._files(f"{self.root}/manifest")
        if not files.exists(at):
            return 0
        names = [f.getPath().getName() for f in files.listStatus(at) if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
        return max((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), default=0)

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """The run that holds each bucket; at most ``buckets`` rows."""
        version = self.version() if version is None else version
        if not version:
            return {}
        rows = self.spark.read.parquet(f"{self.root}/manifest/version={version}").collect()
        if any(r["buckets"] != self.buckets for r in rows):
            raise ValueError(f"the store has {rows[0]['buckets']} buckets")
        return {r["bucket"]: r["run"] for r in rows}

    def _paths(self, manifest: dict[int, str], wanted: Sequence[int] | None = None) -> list[str]:
        return [f"{self.root}/data/run={run}/bucket={b}" for b, run in sorted(manifest.items()) if wanted is None or b in wanted]

    def read(self, version: int | None = None) -> DataFrame | None:
        """The whole snapshot, or None before the first run."""
        paths = self._paths(self.manifest(version))
        return self.spark.read.parquet(*paths) if paths else None

    def materialize(self, rows: DataFrame, end: str, start: str | None = None) -> int:
        """Merge the newest rows with ``start < ts <= end`` and return the version; buckets without such a row stay as they are.

        Without new rows the version does not change.
        """
        version = self.version()
        manifest = self.manifest(version)
        fresh = staged(snapshot(rows, self.keys, self.ts, end, start).withColumn("_bucket", self._bucket()), "fresh")
        touched = {r["_bucket"] for r in fresh.select("_bucket").distinct().collect()}
        if not touched:
            return version
        merged = fresh
        if known := self._paths(manifest, touched):
            before = self.spark.read.schema(fresh.drop("_bucket").schema).parquet(*known).withColumn("_bucket", self._bucket())
            merged = latest_by_key(fresh.unionByName(before), [*self.keys, "_bucket"], self.ts)
        run = uuid.uuid4().hex
        writer = merged.repartition("_bucket").sortWithinPartitions("_bucket", *self.keys).withColumnRenamed("_bucket", "bucket").write
        for k in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        writer.partitionBy("bucket").parquet(f"{self.root}/data/run={run}")
        entries = {**manifest, **{b: run for b in touched}}
        table = self.spark.createDataFrame([(b, r, self.buckets) for b, r in sorted(entries.items())], "bucket int, run string, buckets int")
        table.coalesce(1).write.mode("error").parquet(f"{self.root}/manifest/version={version + 1}")
        return version + 1

    def lookup(self, requests: DataFrame, fields: Sequence[str] | None = None, version: int | None = None,
               as_of: str | None = None, ttl: timedelta | None = None) -> DataFrame | None:
        """``requests`` joined with the stored fields of their keys; only the buckets of those keys are read.

        With ``as_of`` and ``ttl`` fields of older rows read as null. None before the first run. The driver receives the
        numbers of the buckets, at most ``buckets``.
        """
        manifest = self.manifest(version)
        if not manifest:
            return None
        wanted = {r[0] for r in requests.select(self._bucket()).distinct().collect()}
        paths = self._paths(manifest, wanted)
        schema = self.spark.read.parquet(self._paths(manifest)[0]).schema
        stored = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        fields = [c for c in (fields or schema.fieldNames()) if c not in self.keys]
        kept = stored.select(*self.keys, F.col(self.ts).alias("_at"), *[F.col(f).alias(f"_v_{f}") for f in fields])
        joined = requests.join(kept, self.keys, "left")
        fresh = F.lit(True)
        if as_of is not None and ttl is not None:
            fresh = F.col("_at") >= F.lit(as_of).cast(schema[self.ts].dataType) - F.expr(f"INTERVAL '{int(ttl.total_seconds())}' SECOND")
        return joined.withColumns({f: F.when(fresh, F.col(f"_v_{f}")) for f in fields}).drop("_at", *[f"_v_{f}" for f in fields])

    def vacuum(self, keep: int = 2) -> int:
        """Delete the data of runs, and manifests, that none of the newest ``keep`` versions names; returns the number of runs deleted.

        Call it while no run is being written; readers of older versions lose their files.
        """
        newest = self.version()
        kept = {run for v in range(max(1, newest - keep + 1), newest + 1) for run in self.manifest(v).values()}
        deleted = 0
        at, files = self._files(f"{self.root}/data")
        if files.exists(at):
            for f in files.listStatus(at):
                if f.getPath().getName().removeprefix("run=") not in kept:
                    files.delete(f.getPath(), True)
                    deleted += 1
        at, files = self._files(f"{self.root}/manifest")
        for f in files.listStatus(at) if files.exists(at) else ():
            name = f.getPath().getName()
            if name.startswith("version=") and int(name.removeprefix("version=")) <= newest - keep:
                files.delete(f.getPath(), True)
        return deleted


def materialize_view(spark: SparkSession, view: FeatureView, root: str, end: str, start: str | None = None, buckets: int = BUCKETS) -> OnlineStore:
    """One run of a view's source into its store."""
    source = view.table
    columns = [*view.entity.keys, source.timestamp, *[f for f in view.fields if f != source.timestamp]]
    store = OnlineStore(spark, root, view.entity.keys, source.timestamp, buckets)
    store.materialize(source.read(spark).select(*columns), end, start)
    return store
