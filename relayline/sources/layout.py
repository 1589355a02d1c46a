"""Physical layouts of gold and control that let scans and joins skip work.

* ``write_by_day``: gold in one folder per conversion day. A window (F2) becomes
  a partition filter, so a daily run opens the folders of its window only; a
  join that fixes the days prunes them at run time.
* ``Colocated``: a table bucketed and sorted by (lead_id, etapa_funil) with
  Spark's ``bucketBy``. Joins and aggregations on these two columns read each
  bucket where it lies, without a shuffle of the table (J1, J3, S13). Two
  tables meet bucket by bucket if they have the same number of buckets.

Both use Spark's own writers and readers. Buckets are as large as their keys
make them: with repeated gold keys (``quality.gold_key_duplicates``) prefer the
plain tables, whose shuffles AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import GOLD_KEY

DAY = "dia"


def with_day(gold: DataFrame) -> DataFrame:
    return gold.withColumn(DAY, F.to_date("data_hora_conversao"))


def write_by_day(gold: DataFrame, path: str, mode: str = "errorifexists", whole=None, **options) -> None:
    """One folder per conversion day. AQE sizes the files of a day and splits a
    heavy one; rows are sorted by lead inside, so a lead's rows share row groups.
    ``whole`` makes the rows' other columns once they are dealt out and sorted,
    from the columns of ``gold``, which the shuffle then moves alone."""
    dealt = with_day(gold).hint("rebalance", DAY).sortWithinPartitions(DAY, "lead_id")
    rows = dealt if whole is None else with_day(whole(dealt))
    rows.write.mode(mode).options(**options).partitionBy(DAY).parquet(path)


def read_by_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Gold and its ``dia``; nothing is listed or read beyond what filters leave."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).parquet(path)


class Colocated:
    """A bucketed table at ``path``, known to the session's catalog as ``name``."""

    def __init__(self, spark: SparkSession, name: str, path: str, schema: T.StructType, buckets: int):
        self.spark, self.name, self.path, self.schema, self.buckets = spark, name, path, schema, buckets

    def write(self, df: DataFrame) -> None:
        """Replace the table; every bucket is one file. The input must not
        come from the table itself."""
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        (rows.repartition(self.buckets, *GOLD_KEY).sortWithinPartitions(*GOLD_KEY)
         .write.mode("overwrite").option("path", self.path)
         .bucketBy(self.buckets, *GOLD_KEY).sortBy(*GOLD_KEY).saveAsTable(self.name))

    def register(self) -> None:
        """Make the files known to this session's catalog."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(GOLD_KEY)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
                       f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)
