"""Sinks and table maintenance on plain Parquet.

* ``append`` (K1): ``mode("append")``.
* ``replace_period`` (K2): "delete the period, then append" is a write
  partitioned by (year, month) with dynamic partition overwrite: only the
  periods present in the frame are replaced, in one job, and a re-run of the
  same load gives the same table.
* ``upsert`` / ``latest`` (K3, J2, M5): MERGE by key (matched -> update, else
  insert) as a log plus a latest-wins view. A batch is one partition
  (number, writer, batch id): the number, one more than the highest folder
  name when the batch began, is in the path alone, so a new batch lists one
  folder and reads no file of the log, however long that is. A marker per
  batch keeps its number and tells that it is complete: a replay of a complete
  batch is known before any work starts, one that died is written again at
  its old number. Writers that begin at the same time may take the same
  number; batches are ordered by (number, writer, batch id), which is total,
  so the view has one row per key always.
* ``compact`` rewrites the view into a new directory (never over the path
  being read) under a reserved writer.
* ``create_upsert_table`` / ``upsert_into`` / ``latest_of_table``: the same
  log as a catalog table bucketed by key. Every batch is written into the
  same buckets, so the latest-wins view reads bucket by bucket and needs no
  shuffle of the log, however large it grows.
* ``materialize`` (K7): named, commented dataset written once and read back.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from farecast.session import list_names, remove_path, touch
from farecast.sources.files import is_table

BATCH_COL = "batch_id"
WRITER_COL = "writer"
SEQUENCE_COL = "__sequence"
ORDER_COLS = (SEQUENCE_COL, WRITER_COL, BATCH_COL)
MARKERS = "_batches"  # Spark's listings pass over names that begin with "_"
DEFAULT_WRITER = "default"
COMPACTED = "_compacted"


def append(df: DataFrame, target: str, partition_cols: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Append to a path, or to a catalog table (a name without '/'), which is created at first (K1, K4)."""
    writer = df.write.mode("append").format(fmt)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.saveAsTable(target) if is_table(target) else writer.save(target)


def replace_period(
    df: DataFrame,
    target: str,
    period_cols: Sequence[str] = ("metadata_year", "metadata_month"),
    period: Sequence[int] | None = None,
) -> None:
    """Replace periods of the table at ``target``, a path or a catalog name, and leave all others untouched.

    With ``period`` exactly that one is replaced, also by no rows at all;
    rows of other periods in ``df`` are an error of the caller and are not
    written. Without it the periods present in ``df`` are replaced.
    """
    spark, named = df.sparkSession, is_table(target)
    if named and not spark.catalog.tableExists(target):  # the columns of partitions go last, as they do in the table
        df = df.select(*[c for c in df.columns if c not in period_cols], *period_cols)
        df.limit(0).write.partitionBy(*period_cols).saveAsTable(target)
    if named:
        df = df.select(*spark.table(target).columns)
    if period is None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.insertInto(target, overwrite=True) if named else writer.partitionBy(*period_cols).parquet(target)
        return
    where = dict(zip(period_cols, map(int, period), strict=True))
    for c, v in where.items():
        df = df.where(F.col(c) == F.lit(v))
    rows = df.drop(*period_cols)
    if not named:
        rows.write.mode("overwrite").parquet("/".join([target.rstrip("/"), *(f"{c}={v}" for c, v in where.items())]))
        return
    view = f"__period_{uuid.uuid4().hex[:12]}"
    rows.createOrReplaceTempView(view)
    spec = ", ".join(f"{c} = {v}" for c, v in where.items())
    spark.sql(f"INSERT OVERWRITE TABLE {target} PARTITION ({spec}) SELECT * FROM {view}")
    spark.catalog.dropTempView(view)


def _check_unique(batch: DataFrame, key: str, batch_id: int) -> None:
    """No key twice, none null (a null key matches nothing, so it would be lost in the view)."""
    dup = batch.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).limit(1).collect()
    if dup and dup[0][key] is None:
        raise ValueError(f"batch {batch_id} holds a row without a key")
    if dup:
        raise ValueError(f"batch {batch_id} holds key {dup[0][key]} more than once")


def reserve(spark: SparkSession, path: str, batch_id: int, writer: str = DEFAULT_WRITER) -> tuple[int, bool]:
    """The batch's number in the log at ``path``, and whether it is complete already.

    A batch that has begun before keeps its number; a new one gets one more than the highest there is,
    by one listing of the log's folder, and its marker."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", writer):
        raise ValueError(f"not a writer name: {writer!r}")
    mine = f"{path.rstrip('/')}/{MARKERS}/{writer}/{int(batch_id)}"
    found = list_names(spark, mine)
    for name in found:
        if name.isdigit():
            return int(name), f"{name}.done" in found
    number = next_number(spark, path)
    touch(spark, f"{mine}/{number}")
    return number, False


def _complete(spark: SparkSession, path: str, batch_id: int, writer: str, number: int) -> None:
    touch(spark, f"{path.rstrip('/')}/{MARKERS}/{writer}/{int(batch_id)}/{number}.done")


class Batch(NamedTuple):
    """Where a batch of a log is, and whether this call wrote it (not so for a replay of a complete one)."""

    path: str
    new: bool


def upsert(
    batch: DataFrame,
    path: str,
    batch_id: int,
    key: str = "trip_id",
    check_unique: bool = True,
    writer: str = DEFAULT_WRITER,
) -> Batch:
    """Write one batch of keyed rows into the log at ``path``.

    A key may appear once per batch (as MERGE requires); with
    ``check_unique`` a batch with a duplicate fails before anything is
    written. ``writer`` names who counts the batch ids, e.g. a stream's query
    id. An empty batch leaves an empty partition. A batch that is complete
    already (the same writer and batch id) is not written again.
    """
    spark = batch.sparkSession
    number, done = reserve(spark, path, batch_id, writer)
    target = batch_partition(path, batch_id, writer, number)
    if not done:
        if check_unique:
            _check_unique(batch, key, batch_id)
        batch.write.mode("overwrite").parquet(target)
        _complete(spark, path, batch_id, writer, number)
    return Batch(target, not done)


def batch_partition(path: str, batch_id: int, writer: str, number: int) -> str:
    """Directory of one batch inside an upsert log."""
    return f"{path.rstrip('/')}/{SEQUENCE_COL}={int(number)}/{WRITER_COL}={writer}/{BATCH_COL}={int(batch_id)}"


def _log_schema(columns: StructType) -> StructType:
    names = {**dict.fromkeys((SEQUENCE_COL, BATCH_COL), LongType()), WRITER_COL: StringType()}
    data = [f for f in columns.fields if f.name not in names]
    return StructType([*data, *[StructField(c, names[c]) for c in ORDER_COLS]])


def read_log(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows of an upsert log with the columns that order its batches. A writer's name is text,
    whatever it looks like."""
    schema = _log_schema(schema or spark.read.parquet(path).schema)
    return spark.read.schema(schema).parquet(path)


def _batch_order(spark: SparkSession, path: str) -> Column:
    """One number per batch of the log at ``path`` that orders like (number, writer, batch id).

    Numbers aggregate by hash, structs only by sorting. The writers and their last batch come from the
    markers' folder names; where they are not there or the product is no long, it is the struct."""
    root = f"{path.rstrip('/')}/{MARKERS}"
    writers = list_names(spark, root)
    span = 1 + max((int(b) for w in writers for b in list_names(spark, f"{root}/{w}")), default=0)
    if not writers or next_number(spark, path) * len(writers) * span >= 1 << 63:
        return F.struct(*ORDER_COLS)
    rank = F.create_map(*[F.lit(v) for w, i in zip(writers, range(len(writers))) for v in (w, i)])[F.col(WRITER_COL)]
    known = F.coalesce(rank.cast("long"), F.raise_error(F.lit("a batch of the log has no marker")).cast("long"))
    return (F.col(SEQUENCE_COL) * F.lit(len(writers)) + known) * F.lit(span) + F.col(BATCH_COL)


def _newest_per_key(log: DataFrame, key: str, order: Column) -> DataFrame:
    """A narrow aggregate (key -> its last batch) joined back to the log.

    Only the key is read for it: what orders the batches is in their path."""
    newest = log.groupBy(key).agg(F.max(order).alias("__newest"))
    # ">=" says the same as "=" here and stays out of the join keys, so buckets by key still match
    rows = log.join(newest, key).where(order >= F.col("__newest"))
    return rows.drop("__newest", *ORDER_COLS)


def latest(spark: SparkSession, path: str, key: str = "trip_id") -> DataFrame:
    """Latest-wins view of an upsert log: per key the row of its last batch."""
    log = read_log(spark, path)  # its files are listed before the markers, so every batch seen has one
    return _newest_per_key(log, key, _batch_order(spark, path))


def changes_since(log: DataFrame, number: int, key: str = "trip_id") -> DataFrame:
    """One row (inserted, updated): keys that batches from ``number`` on brought, and keys they changed.

    One aggregate over the key and the batch numbers; nothing has to be counted before a run."""
    ends = log.groupBy(key).agg(F.min(SEQUENCE_COL).alias("first"), F.max(SEQUENCE_COL).alias("last"))
    new, old = F.col("first") >= F.lit(number), (F.col("first") < F.lit(number)) & (F.col("last") >= F.lit(number))
    return ends.agg(F.count_if(new).alias("inserted"), F.count_if(old).alias("updated"))


def next_number(spark: SparkSession, path: str) -> int:
    """The number the next batch of the log at ``path`` would get."""
    taken = [int(n.split("=", 1)[1]) for n in list_names(spark, path) if n.startswith(f"{SEQUENCE_COL}=")]
    return max(taken, default=-1) + 1


def create_upsert_table(
    spark: SparkSession, name: str, schema: StructType, path: str, key: str = "trip_id", buckets: int = 64
) -> None:
    """Create (if absent) an upsert log table at ``path``: partitioned by
    number, writer and batch id, bucketed and sorted by ``key`` into ``buckets`` buckets.
    Size ``buckets`` for the whole log (e.g. log size / 256 MB); it is fixed
    for the life of the table."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}, {SEQUENCE_COL} BIGINT, {WRITER_COL} STRING, {BATCH_COL} BIGINT) "
        f"USING parquet PARTITIONED BY ({', '.join(ORDER_COLS)}) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS "
        f"LOCATION '{path}'"
    )


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def upsert_into(
    batch: DataFrame,
    name: str,
    batch_id: int,
    key: str = "trip_id",
    check_unique: bool = True,
    writer: str = DEFAULT_WRITER,
) -> Batch:
    """Write one batch into an upsert log table. As with ``upsert`` a complete
    batch is not written again, and one with a duplicate key fails before
    anything is written."""
    spark = batch.sparkSession
    path = _location(spark, name)
    number, done = reserve(spark, path, batch_id, writer)
    target = batch_partition(path, batch_id, writer, number)
    if done:
        return Batch(target, False)
    if check_unique:
        _check_unique(batch, key, batch_id)
    cols = [c for c in spark.table(name).columns if c not in ORDER_COLS]
    view = f"__upsert_batch_{uuid.uuid4().hex[:12]}"
    batch.select(*cols).createOrReplaceTempView(view)
    quoted = ", ".join(f"`{c}`" for c in cols)
    # a static partition spec replaces exactly this batch's partition
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({SEQUENCE_COL} = {number}, {WRITER_COL} = '{writer}', "
        f"{BATCH_COL} = {int(batch_id)}) SELECT {quoted} FROM {view}"
    )
    spark.catalog.dropTempView(view)
    _complete(spark, path, batch_id, writer, number)
    return Batch(target, True)


def latest_of_table(spark: SparkSession, name: str, key: str = "trip_id") -> DataFrame:
    """Latest-wins view of an upsert log table; bucketed by key, so the
    aggregate runs per bucket without an exchange."""
    return _newest_per_key(spark.table(name), key, F.struct(*ORDER_COLS))


def compact(
    spark: SparkSession, path: str, new_path: str, key: str = "trip_id", remember: bool = False
) -> DataFrame:
    """Rewrite the latest-wins view into a new log at ``new_path``.

    The rows go to the reserved writer's partition, so no later batch of any
    writer replaces them, and later batches number higher. The new log counts
    its writers' batches from scratch; with ``remember`` it knows the old log's
    complete ones, so that a replay of theirs is one there, too (for streams
    that go on with the new log)."""
    if new_path.rstrip("/") == path.rstrip("/"):
        raise ValueError("compact into a new directory, not over the log being read")
    upsert(latest(spark, path, key), new_path, 0, key, check_unique=False, writer=COMPACTED)
    for writer in list_names(spark, f"{path.rstrip('/')}/{MARKERS}") if remember else ():
        if writer == COMPACTED:
            continue
        for batch_id in list_names(spark, f"{path.rstrip('/')}/{MARKERS}/{writer}"):
            if any(n.endswith(".done") for n in list_names(spark, f"{path.rstrip('/')}/{MARKERS}/{writer}/{batch_id}")):
                touch(spark, f"{new_path.rstrip('/')}/{MARKERS}/{writer}/{batch_id}/0")
                touch(spark, f"{new_path.rstrip('/')}/{MARKERS}/{writer}/{batch_id}/0.done")
    return spark.read.parquet(new_path)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a table from the catalog (an external table's files stay)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def reset(spark: SparkSession, name: str | None = None, *paths: str) -> None:
    """Reset a target before a run (K5): drop the table and delete the given
    data and checkpoint folders."""
    if name:
        drop_table(spark, name)
    for p in paths:
        remove_path(spark, p)


def sql_over(df: DataFrame, view: str, query: str) -> DataFrame:
    """Run SQL over a frame through a temp view on the frame's own session (K6)."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(query)


def materialize(df: DataFrame, path: str, name: str | None = None, comment: str | None = None) -> DataFrame:
    """Write ``df`` as a dataset and return a frame that reads it (K7).

    With ``name``, the dataset is also registered in the session catalog as
    an external Parquet table carrying ``comment``.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    if name:
        drop_table(spark, name)
        spark.catalog.createTable(name, path=path, source="parquet", description=comment)
        return spark.table(name)
    return spark.read.parquet(path)
