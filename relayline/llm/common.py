"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from relayline.session import bound_arrow_batches, checkpoint_dir

#: A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder of ``spark.checkpoint.dir`` and
    read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (made := _made.get()) is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators with large tables on the way and a small result: the
    result is written, and the tables that made it are deleted."""
    @functools.wraps(operator)
    def run(*args, **kwargs) -> DataFrame:
        token = _made.set([])
        try:
            result, made = operator(*args, **kwargs), _made.get()
        finally:
            _made.reset(token)
        result = materialize(result, operator.__name__)
        spark = result.sparkSession
        for place in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return result
    return run


def set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, list]:
    """``docs`` with its columns under the names c0, c1, ... beside copies of
    the ``needed`` ones, so that an operator's own names cannot clash; and the
    expressions that give the columns back."""
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    return docs.select(*kept, *needed), [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def map_arrow(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with batches of a bounded size in bytes."""
    bound_arrow_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, schema: str | T.StructType,
             make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """``mapInArrow`` over columns: ``make`` runs once per task and returns
    a function from the batch's columns (name -> list) to the result's.
    Binary and string columns arrive as ``bytes`` and ``str``."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in small(batch):
                cols = step({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[f.name], type=f.type) for f in out], schema=out)
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return map_arrow(df, run, schema)


def small(batch: pa.RecordBatch, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes each, one row at least, so a
    task's Python memory does not follow the length of the texts."""
    rows = batch.num_rows
    step = max(1, min(rows, rows * most // max(1, batch.nbytes)))
    for at in range(0, rows, step):
        yield batch.slice(at, step)


def runs(rows: pa.Table, key: str) -> Iterator[tuple[int, int]]:
    """(start, end) of equal neighbours in a column."""
    values = rows.column(key).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    yield from zip(np.r_[0, cuts], np.r_[cuts, len(values)])


def by_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of all rows of one key, from rows sorted by it. A key's pieces
    are joined once, however many batches they come in."""
    held: list[pa.Table] = []

    def whole() -> pa.Table:
        return held[0] if len(held) == 1 else pa.concat_tables(held).combine_chunks()

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        for start, end in runs(rows, key):
            if held and held[-1][key][0] != rows[key][start]:
                yield whole()
                held.clear()
            held.append(rows.slice(start, end - start))
    if held:
        yield whole()


def grouped(df: DataFrame, key: str, schema: str, make: Callable) -> DataFrame:
    """``make()``'s function of a key's rows (an Arrow table, all of them) to
    columns, for keys of bounded size: one shuffle, one Python call per
    partition instead of one per key."""
    kind = T._parse_datatype_string(schema)
    out = arrow_schema(kind)

    def run(batches):
        step, cols, size = make(), None, 0
        for rows in by_group(batches, key):
            got = step(rows)
            cols = got if cols is None else {k: v + got[k] for k, v in cols.items()} if size else got
            size = len(next(iter(cols.values())))
            if size >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in out], schema=out)
                cols, size = None, 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in out], schema=out)

    return map_arrow(df.repartition(key).sortWithinPartitions(key), run, kind)


def spread(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id connected with each row by the pairs (a, b) of rows."""
    label = ids.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            return label
        label = new


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected edges ``(a, b)`` of longs:
    ``(node, label)`` with the smallest node of each component as label.

    Each round points every node at its smallest neighbour (partial
    aggregates first, so a hub costs one row per task), follows the pointers
    to their roots by doubling, and contracts the edges to the roots. The
    number of nodes at least halves per round. Nulls and loops are ignored;
    no edges give an empty table.
    """
    edges = materialize(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
                        .where("a <> b").distinct(), name)
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = materialize(both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("up")), name)
        while True:
            step = up.select(F.col("node").alias("up"), F.col("up").alias("next"))
            up = materialize(up.join(step, "up").select(
                "node", F.col("next").alias("up"), (F.col("next") != F.col("up")).alias("moved")), name)
            if up.where("moved").isEmpty():
                break
            up = up.drop("moved")
        up = up.select("node", "up")
        maps.append(up)
        left, right = (up.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab")
        edges = materialize(edges.join(left, "a").join(right, "b")
                            .select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b"))
                            .where("a <> b").distinct(), name)
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    out = maps[0].withColumnRenamed("up", "label")
    for up in maps[1:]:
        out = out.join(up.select(F.col("node").alias("label"), "up"), "label", "left").select(
            "node", F.coalesce("up", "label").alias("label"))
    return out


def running(df: DataFrame, group: list[str], order: list, value: str, bucket: str, out: str) -> DataFrame:
    """Exact running sum of ``value`` within ``group`` by ``order``, spread
    over many tasks: ``bucket`` is a column that rises with ``order``; sums
    per bucket are added up first, then rows are ranked inside their bucket
    only. ``df`` is read twice. Rows equal in ``order`` must be equal."""
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum")).select(
        *[F.col(c).alias(f"_{c}") for c in group], F.col(bucket).alias(f"_{bucket}"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0).cast("long")).alias("_start"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = df.withColumn(out, F.sum(value).over(inside))
    on = [ranked[c].eqNullSafe(starts[f"_{c}"]) for c in [*group, bucket]]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return ranked.join(starts, cond).withColumn(out, F.col(out) + F.col("_start")).drop(
        "_start", *[f"_{c}" for c in [*group, bucket]])
