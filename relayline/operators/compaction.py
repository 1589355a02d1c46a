"""Compaction of small files.

The fragments of a partition are sorted by size and dealt to groups by the
running sum of the sizes before them: group floor(sum / target). A fragment
is smaller than ``target``, so a group holds less than twice the target, and all
but a partition's last hold at least the target less one fragment. Partitions are packed
in parallel (a window over files, not rows). Only fragments are read and
rewritten, one group to a file, by Spark's own readers and writers; files of
``target`` bytes and more stay as they are.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def file_groups(files: DataFrame, by: list[str], name: str, size: str, target: int) -> DataFrame:
    """``files`` smaller than ``target`` with their ``grupo`` in each partition
    ``by``, the files and the size of it. Ties go by name."""
    part = Window.partitionBy(*by).orderBy(size, name).rowsBetween(Window.unboundedPreceding, -1)
    small = files.where(F.col(size) < target)
    placed = small.withColumn("grupo", F.floor(F.coalesce(F.sum(size).over(part), F.lit(0)) / F.lit(target)).cast("long"))
    whole = Window.partitionBy(*by, "grupo")
    return placed.withColumn("arquivos", F.count(F.lit(1)).over(whole)).withColumn("total", F.sum(size).over(whole))


def files_of(spark: SparkSession, root: str) -> DataFrame:
    """``(dir, path, bytes)`` of the Parquet files under ``root``, listed by
    Spark; no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(root)
    return listed.select(F.regexp_replace("path", "/[^/]*$", "").alias("dir"), "path", F.col("length").alias("bytes"))


def _same_file(c: Column) -> Column:
    """Paths as names inside the table: listings and scans may differ in how
    they write the file system."""
    return F.regexp_extract(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), "((?:[^/]+=[^/]+/)*[^/]+)$", 1)


class Compaction:
    """Compaction of the partitioned Parquet table at ``root``, one writer at
    a time. The merged files are written aside, then a journal names them and
    the fragments they replace, then they are moved in and the fragments
    deleted; ``finish`` completes a run that was lost after its journal, and a run
    lost before it has changed nothing. Between journal and end readers may
    see a row in its old and its new file: read after ``finish`` says True."""

    def __init__(self, spark: SparkSession, root: str, staging: str):
        self.spark, self.root, self.staging = spark, root.rstrip("/"), staging.rstrip("/")

    def _fs(self, p: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def plan(self, target: int) -> DataFrame:
        """The groups that are worth a rewrite: two fragments or more."""
        return file_groups(files_of(self.spark, self.root), ["dir"], "path", "bytes", target).where("arquivos > 1")

    def run(self, target: int) -> int:
        """Compact; the number of fragments that were replaced."""
        self.finish()
        run_id = uuid.uuid4().hex
        out = f"{self.staging}/{run_id}"
        plan = self.plan(target).select("dir", "path", "grupo").withColumn(
            "_number", F.dense_rank().over(Window.orderBy("dir", "grupo")) - 1)  # a row per file
        plan.write.parquet(f"{out}/plan")
        plan = self.spark.read.parquet(f"{out}/plan")
        groups = plan.agg(F.max("_number").alias("n")).first()["n"]
        if groups is None:
            return 0
        paths = [r.path for r in plan.select("path").collect()]  # names of files, not rows
        table = self.spark.read.option("basePath", self.root).parquet(self.root)
        columns = [c for c in table.columns]
        kept = self.spark.read.option("basePath", self.root).schema(table.schema).parquet(*paths)
        numbers = plan.select(_same_file(F.col("path")).alias("_file"), "_number")
        rows = kept.withColumn("_file", _same_file(F.col("_metadata.file_path"))).join(F.broadcast(numbers), "_file")
        partitions = self._partition_columns(paths[0])
        rows = rows.select(*columns, "_number").repartitionById(int(groups) + 1, F.col("_number").cast("int")).drop("_number")
        writer = rows.write
        (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{out}/files")
        fs, journal = self._fs(f"{self.staging}/_journal-{run_id}")
        merged = [r.path for r in files_of(self.spark, f"{out}/files").select("path").collect()]
        stream = fs.create(journal, True)
        stream.write(bytearray(json.dumps({"run": run_id, "old": paths, "new": merged}).encode()))
        stream.close()
        self.finish()
        return len(paths)

    def _partition_columns(self, path: str) -> list[str]:
        inside = path.rsplit(self.root.rsplit("/", 1)[-1] + "/", 1)[-1].split("/")[:-1]
        return [p.split("=", 1)[0] for p in inside if "=" in p]

    def finish(self) -> bool:
        """Complete runs that have a journal; True when none is left."""
        fs, path = self._fs(self.staging)
        if not fs.exists(path):
            return True
        for status in fs.listStatus(path):
            if not status.getPath().getName().startswith("_journal-"):
                continue
            source = fs.open(status.getPath())
            done = json.loads(bytes(source.readAllBytes()).decode())
            source.close()
            for new in done["new"]:
                _, src = self._fs(new)
                inside = src.toString().split(f"{done['run']}/files/", 1)[1]
                _, dst = self._fs(f"{self.root}/{inside}")
                if fs.exists(src) and not fs.rename(src, dst):
                    raise OSError(f"could not move {new}")
            for old in done["old"]:
                fs.delete(self._fs(old)[1], False)
            fs.delete(status.getPath(), False)
        return True
