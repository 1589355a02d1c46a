"""Fixture tables, written once per session to the shared checkpoint folder.

The original's seed job writes its tables and the pipeline reads them; here
the derived fixtures are likewise written as Parquet under
``spark.checkpoint.dir`` the first time a query needs them, and read back
afterwards. That cuts their lineage (a lost executor recomputes from the
written files, not from ``lineitem``), keeps query plans small, and gives
later scans one file per shuffle partition, clustered and sorted by lead so
point lookups prune row groups.

The folder is keyed by the content identity of the inputs (file sizes and
modification times), the parameters and the package source, so a later
session reuses finished tables and a change to data or code never reads
stale ones. A table is published by renaming a finished write, so a
concurrent reader sees all of it or nothing.
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import DEFAULT_AS_OF
from ..schemas import CONTROL, GOLD, MANIFEST, PLATFORM_REPORT, RAW, RESPONSE, SEND_RESULT
from ..session import checkpoint_dir
from . import fixtures as fx
from .layout import Colocated, read_by_day, write_by_day

COMPRESSION = "zstd"  # half of snappy's bytes for hashes in hex

LEAST_BUCKETS, INPUT_PER_BUCKET = 16, 8 << 20  # buckets of a co-located table; bytes of lineitem for each

_LOCK = threading.RLock()  # builders call other accessors


def _source_digest() -> str:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for dirpath, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()


def _fs(spark: SparkSession, p: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(p)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _exists(spark: SparkSession, p: str) -> bool:
    fs, path = _fs(spark, p)
    return bool(fs.exists(path))


def _rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    fs.mkdirs(d.getParent())
    return bool(fs.rename(s, d))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark's readers resolve it: a URI keeps its file system, a
    plain path gets the default one."""
    fs, p = _fs(spark, path.rstrip("/"))
    return fs.makeQualified(p).toString()


_WRITTEN: dict[tuple, DataFrame] = {}  # read-back DataFrames: files are listed and footers read once


def _typed(df: DataFrame, schema) -> DataFrame:
    return df if schema is None else df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


class Fixtures:
    """Accessors for every fixture table of one input folder.

    ``materialize=False`` returns the lazy DataFrames instead (whole lineage
    back to ``lineitem``); results are identical.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool | None = None,
                 as_of=DEFAULT_AS_OF, batch_size: int = 50, n_buckets: int | None = None, frozen_at=None):
        self.spark = spark
        self.sf_dir = qualified(spark, sf_dir)
        if materialize is None:
            materialize = os.environ.get("RELAYLINE_MATERIALIZE", "1") != "0"
        self.materialize = materialize
        self.as_of, self.batch_size, self.n_buckets = as_of, batch_size, n_buckets
        self.frozen_at = frozen_at or as_of

    # -- plumbing
    def _identity(self) -> str:
        """Content identity of the derived tables: input files (path, size,
        modification time), parameters and the package source. Equal identity
        means equal tables, so any session may reuse them; a change to the
        data or to the code gives a new folder."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/lineitem.parquet")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files = sorted((st.getPath().toString(), st.getLen(), st.getModificationTime())
                       for st in fs.listStatus(path))
        h = hashlib.sha1(repr((files, self.as_of, self.batch_size, self.n_buckets, self.frozen_at)).encode())
        h.update(_source_digest().encode())
        return h.hexdigest()[:16]

    def _root(self) -> str:
        return f"{checkpoint_dir(self.spark)}/relayline-fixtures/{self._identity()}"

    def _get(self, name: str, build, cluster: list[str] | None = None, schema=None, laid=None,
             deal: bool = True) -> DataFrame:
        """The table, written once; with ``schema`` its columns are cast to it
        and it is read with it (S8). It is dealt out and sorted by ``cluster``;
        with ``deal=False`` only sorted, where rows come from a table that is
        clustered so already. ``laid`` builds it dealt out and sorted."""
        if not self.materialize:
            return _typed(build(), schema)
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.as_of, self.batch_size, self.n_buckets, self.frozen_at, name)
        with _LOCK:
            written = _WRITTEN.get(key)
            if written is None:
                path = f"{self._root()}/{name}"
                if not _exists(self.spark, f"{path}/_SUCCESS"):
                    # write aside, then publish with one rename: readers never see a partial table
                    tmp = f"{path}.tmp-{self.spark.sparkContext.applicationId}"
                    df = _typed((laid or build)(), schema)
                    if cluster:
                        # REBALANCE: AQE sizes the write tasks and splits a hot key
                        df = (df.hint("rebalance", *cluster) if deal else df).sortWithinPartitions(*cluster)
                    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(tmp)
                    if not _rename(self.spark, tmp, path) and not _exists(self.spark, f"{path}/_SUCCESS"):
                        raise OSError(f"could not publish {path}")
                reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
                written = _WRITTEN[key] = reader.parquet(path)
        return written

    def lineitem(self) -> DataFrame:
        return fx.table(self.spark, self.sf_dir, "lineitem")

    # -- tables
    def gold(self) -> DataFrame:
        return self._get("gold", lambda: fx.gold(self.lineitem()), schema=GOLD,
                         laid=lambda: fx.gold(self.lineitem(), laid=True))

    def gold_with_duplicates(self) -> DataFrame:
        """Not written: each row follows from one line, so ``lineitem`` is read
        as fast, and only the columns that a query asks for are made."""
        return _typed(fx.gold_with_duplicates(self.lineitem()), GOLD)

    def raw(self) -> DataFrame:
        return self._get("raw", lambda: fx.raw(self.lineitem()), ["lead_id"], RAW)

    def manifest(self) -> DataFrame:
        return self._get("manifest", lambda: fx.manifest(self.lineitem()), ["lead_id"], MANIFEST)

    def control(self) -> DataFrame:
        return self._get("control", lambda: fx.control(self.gold()), ["lead_id", "etapa_funil"], CONTROL,
                         deal=False)

    def send_results(self) -> DataFrame:
        return self._get("send_results", lambda: fx.send_results(self.gold(), self.control(), self.as_of),
                         ["lead_id", "etapa_funil"], SEND_RESULT, deal=False)

    def version(self, name: str, build) -> DataFrame:
        """A version of the control table as ``build`` makes it, written once."""
        return self._get(name, build, schema=CONTROL)

    def feed(self, name: str, build) -> DataFrame:
        """A change feed between two versions, written once."""
        return self._get(name, build)

    def platform_report(self) -> DataFrame:
        return self._get("platform_report", lambda: fx.platform_report(self.control()), ["event_id"], PLATFORM_REPORT)

    def batched_sends(self) -> DataFrame:
        return self._get("batched_sends", lambda: fx.batched_sends(
            self.gold(), self.control(), self.as_of, self.batch_size, self.n_buckets, self.frozen_at), ["plataforma", "batch_id"], deal=False)

    def responses(self) -> DataFrame:
        return self._get("responses", lambda: fx.responses(self.batched_sends(), self.as_of), ["plataforma", "batch_id"],
                         RESPONSE)

    def report_history(self) -> DataFrame:
        return self._get("report_history", lambda: fx.report_history(self.platform_report()), ["event_id"], PLATFORM_REPORT)

    # -- other layouts of the same tables
    def folder(self, name: str, write) -> str:
        """The folder that ``write(path)`` fills, filled once and published by a rename."""
        path = f"{self._root()}/{name}"
        with _LOCK:
            if not _exists(self.spark, f"{path}/_SUCCESS"):
                tmp = f"{path}.tmp-{self.spark.sparkContext.applicationId}"
                write(tmp)
                if not _rename(self.spark, tmp, path) and not _exists(self.spark, f"{path}/_SUCCESS"):
                    raise OSError(f"could not publish {path}")
        return path

    def gold_by_day(self) -> DataFrame:
        """Gold in one folder per conversion day."""
        return read_by_day(self.spark, self.folder("gold_by_day", lambda p: write_by_day(
            fx.gold_core(self.gold()), p, "overwrite", whole=fx.gold_columns, compression=COMPRESSION)), GOLD)

    def _buckets(self) -> int:
        """Buckets that grow with the input, and so stay as large as they are."""
        fs, path = _fs(self.spark, f"{self.sf_dir}/lineitem.parquet")
        return max(LEAST_BUCKETS, -(-fs.getContentSummary(path).getLength() // INPUT_PER_BUCKET))

    def _colocated(self, name: str, rows: DataFrame, schema) -> Colocated:
        buckets = self._buckets()
        path = f"{self._root()}/{name}"
        table = Colocated(self.spark, f"relayline_{name}_{self._identity()}", path, schema, buckets)
        with _LOCK:
            if not _exists(self.spark, f"{path}/_SUCCESS"):
                tmp = Colocated(self.spark, f"{table.name}_tmp", f"{path}.tmp-{self.spark.sparkContext.applicationId}",
                                schema, buckets)
                tmp.write(rows)
                self.spark.sql(f"DROP TABLE {tmp.name}")
                if not _rename(self.spark, tmp.path, path) and not _exists(self.spark, f"{path}/_SUCCESS"):
                    raise OSError(f"could not publish {path}")
            table.register()
        return table

    def gold_colocated(self) -> DataFrame:
        return self._colocated("gold_colocated", self.gold(), GOLD).read()

    def control_colocated(self) -> DataFrame:
        return self._colocated("control_colocated", self.control(), CONTROL).read()
