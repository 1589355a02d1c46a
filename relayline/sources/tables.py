"""Versioned Parquet tables (S6, S7, S11, S12, and the write side of M1).

Built-in file tables cannot MERGE, DELETE or overwrite a path that the same
job reads, so a table here is a folder of numbered snapshots
``<root>/v=<n>/``. A change reads the latest snapshot, computes the next one
as a DataFrame, writes it aside, checks and tags it there, and publishes it
as ``v=<n+1>`` by one rename; readers see whole, checked versions only. One
writer per table at a time is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import control as ctl
from ..schemas import CONTROL, KEY, SEND_RESULT_COLUMNS


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None,
                 cluster: list[str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.cluster = cluster or []

    # -- file system (Hadoop API: works for local, HDFS and object stores)
    def _fs_path(self, p: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _exists(self, p: str) -> bool:
        fs, path = self._fs_path(p)
        return bool(fs.exists(path))

    def _touch(self, p: str) -> None:
        fs, path = self._fs_path(p)
        fs.create(path, True).close()

    def _rename(self, a: str, b: str) -> None:
        fs, src = self._fs_path(a)
        if fs.exists(self._fs_path(b)[1]) or not fs.rename(src, self._fs_path(b)[1]):
            raise OSError(f"could not publish {b}: another writer, or no rename")

    def versions(self) -> list[int]:
        """Committed, valid versions in ascending order."""
        fs, path = self._fs_path(self.root)
        if not fs.exists(path):
            return []
        out = []
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v="):
                v = int(name[2:])
                d = f"{self.root}/{name}"
                if self._exists(f"{d}/_SUCCESS"):
                    out.append(v)
        return sorted(out)

    def latest(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    # -- read / write
    def read(self, version: int | None = None) -> DataFrame:
        """A snapshot (latest by default); an empty table when none exists yet."""
        if version is None:
            version = self.latest()
        if version is None:
            if self.schema is None:
                raise FileNotFoundError(f"no committed version under {self.root}")
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.parquet(self.path(version))

    def tagged(self, tag: str) -> int | None:
        """The committed version written with ``tag``, if any."""
        for v in reversed(self.versions()):
            if self._exists(f"{self.path(v)}/_TAG_{tag}"):
                return v
        return None

    def write(self, df: DataFrame, unique_key: list[str] | None = None, tag: str | None = None,
              rules: dict | None = None) -> int:
        """Write ``df`` as the next version and return its number.

        With ``unique_key`` the written files are checked for repeated keys,
        and with ``rules`` (name -> predicate that no row may meet) for broken
        rows; an error is raised and nothing is published. ``tag`` marks the
        version (e.g. a stream epoch) so a retry can see it is done.
        """
        latest = self.latest()
        version = 0 if latest is None else latest + 1
        if self.schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        if self.cluster:
            # REBALANCE: AQE sizes the write tasks and splits a hot lead
            df = df.hint("rebalance", *self.cluster).sortWithinPartitions(*self.cluster)
        aside = f"{self.root}/_aside-{uuid.uuid4().hex}"
        df.write.parquet(aside)
        written = self.spark.read.parquet(aside)
        try:
            if unique_key and not (written.groupBy(*unique_key).count().where("count > 1").isEmpty()):
                raise ValueError(f"the next version of {self.root} repeats keys {unique_key}")
            if rules:
                broken = written.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in rules.items()]).first().asDict()
                broken = {n: c for n, c in broken.items() if c}
                if broken:
                    raise ValueError(f"the next version of {self.root} breaks {broken}")
        except ValueError:
            fs, path = self._fs_path(aside)
            fs.delete(path, True)
            raise
        if tag:
            self._touch(f"{aside}/_TAG_{tag}")
        self._rename(aside, self.path(version))
        return version

    def publish(self, view_name: str, version: int | None = None) -> DataFrame:
        """Point a view at a version (the latest by default)."""
        df = self.read(version)
        df.createOrReplaceTempView(view_name)
        return df

    def publish_table(self, namespace: str, name: str, version: int | None = None) -> DataFrame:
        """Point ``namespace.name`` in the catalog at a version (the
        latest by default); the namespace is made if it is missing. The table
        is external, so pointing it elsewhere deletes no data."""
        version = self.latest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
        self.spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{name}`")
        return self.spark.catalog.createTable(f"`{namespace}`.`{name}`", path=self.path(version), source="parquet")


class ControlTable(SnapshotTable):
    """The control table: clustered by lead so a snapshot's files group a lead's rows."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, CONTROL, cluster=["lead_id", "etapa_funil"])

    def upsert(self, batch: DataFrame, now, check_unique: bool = True, tag: str | None = None, then=None) -> int:
        """M1 then write: the next version is the merged table, passed through
        ``then`` (table -> table) if given."""
        merged = ctl.upsert(self.read(), batch, now)
        return self.write(then(merged) if then else merged, KEY if check_unique else None, tag, rules=ctl.row_rules())

    def append(self, rows: DataFrame) -> int:
        """S11."""
        return self.write(ctl.append(self.read(), rows), rules=ctl.row_rules())

    def delete_where(self, predicate) -> int:
        """S12."""
        return self.write(ctl.delete_where(self.read(), predicate))

    def changes_since(self, version: int) -> DataFrame:
        """Change feed from ``version`` to the latest."""
        return ctl.changes(self.read(version), self.read())


class BucketedControlTable:
    """The control table partitioned by ``bucket = pmod(xxhash64(lead_id), n)``.

    An upsert reads only the buckets its batch touches (partition pruning on
    the bucket list, at most ``n`` integers) and rewrites only those buckets
    with Spark's dynamic partition overwrite, so a batch costs O(touched
    buckets), not O(table). The merged buckets are first written to a staging
    folder named after the batch ``tag``, then copied, then the tag is marked
    applied. A copy that a lost job left unfinished is finished before the next
    upsert of any tag, and an applied tag is never copied again, so a batch is
    applied once and no later one is undone. Readers see a bucket either before
    or after the copy (no cross-bucket snapshot); one writer at a time is
    assumed.
    """

    def __init__(self, spark: SparkSession, root: str, staging_root: str, n_buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.staging_root = staging_root.rstrip("/")
        self.n_buckets = n_buckets
        self.schema = T.StructType(CONTROL.fields + [T.StructField("bucket", T.IntegerType(), False)])
        self._fs = SnapshotTable(spark, root)

    def bucket_of(self, lead_id="lead_id"):
        return F.pmod(F.xxhash64(F.col(lead_id)), F.lit(self.n_buckets)).cast("int")

    def read(self) -> DataFrame:
        if not self._fs._exists(f"{self.root}/_SUCCESS") and not self._fs._exists(self.root):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.root)

    def _write(self, df: DataFrame, path: str, dynamic: bool) -> None:
        # REBALANCE: AQE sizes the write tasks and splits a bucket made big by a hot lead
        w = (df.withColumn("bucket", self.bucket_of()).hint("rebalance", "bucket")
               .write.mode("overwrite").partitionBy("bucket"))
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
        w.parquet(path)

    def write_all(self, df: DataFrame) -> None:
        """Replace the whole table."""
        self._write(ctl.conform(df), self.root, dynamic=False)

    def upsert(self, batch: DataFrame, now, tag: str, then=None, everywhere: bool = False) -> list[int]:
        """M1 on the touched buckets only; returns the rewritten bucket numbers.
        ``then`` (table -> table) is applied to their merged rows; with
        ``everywhere`` all buckets are touched."""
        self._finish()
        staged = f"{self.staging_root}/{tag}"
        if self.tagged(tag) is not None:
            return []
        src = ctl.dedupe_batch(ctl.refuse_null_keys(batch.select(*SEND_RESULT_COLUMNS)))
        current = self.read()
        if not everywhere:
            touched = sorted(r[0] for r in src.select(self.bucket_of().alias("b")).distinct().collect())
            current = current.where(F.col("bucket").isin(touched))
        merged = ctl.upsert(current.drop("bucket"), src, now)
        self._write(then(merged) if then else merged, staged, dynamic=False)
        self._fs._touch(f"{self.staging_root}/_pending/{tag}")
        return self._copy(tag)

    def tagged(self, tag: str) -> str | None:
        """``tag`` if its batch is applied."""
        return tag if self._fs._exists(f"{self.staging_root}/{tag}/_APPLIED") else None

    def _copy(self, tag: str) -> list[int]:
        staged = f"{self.staging_root}/{tag}"
        result = self.spark.read.schema(self.schema).parquet(staged)
        buckets = sorted(r[0] for r in result.select("bucket").distinct().collect())
        self._write(result.drop("bucket"), self.root, dynamic=True)
        self._fs._touch(f"{staged}/_APPLIED")
        fs, path = self._fs._fs_path(f"{self.staging_root}/_pending/{tag}")
        fs.delete(path, False)
        return buckets

    def _finish(self) -> None:
        """Finish the copy of a batch whose job was lost on the way."""
        fs, path = self._fs._fs_path(f"{self.staging_root}/_pending")
        if fs.exists(path):
            for tag in sorted(st.getPath().getName() for st in fs.listStatus(path)):
                self._copy(tag)
