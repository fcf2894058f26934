"""Helpers shared by the training-data operators of this subpackage.

All operators read ``doc_id`` and ``text`` by name and carry nothing else
unless they say so; extra columns, whatever their names, are never touched.
Python work runs in ``mapInArrow`` over slices of a few hundred rows, so a
task holds one Arrow batch (bounded in bytes) and one slice at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.session import ship_code

SLICE_ROWS = 256
BATCH_BYTES = 16 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


_TYPES = {
    "int": T.IntegerType, "long": T.LongType, "double": T.DoubleType, "string": T.StringType,
    "boolean": T.BooleanType, "binary": T.BinaryType,
}


def columns(text: str) -> T.StructType:
    """A schema from ``"name type, ..."``; needs no session, so modules can define theirs when imported."""
    pairs = [c.split() for c in text.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t]()) for n, t in pairs])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Get a session ready for Python tasks: the package on the workers, and Arrow
    batches capped in bytes (very long texts) unless the session has a smaller cap."""
    ship_code(spark)
    if int(spark.conf.get(_BATCH_CONF, str(2**31 - 1)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


_RELEASE: list[Callable[[], None]] = []


def release_before_other_work(clear: Callable[[], None]) -> None:
    """``clear`` frees a cache that a worker keeps between tasks; it is called when the worker turns to
    another operator, whose memory the cache would take."""
    _RELEASE.append(clear)


def map_slices(
    df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: T.StructType, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Map slices of rows: ``make()`` runs once a task and gives ``fn(columns) -> columns``
    over dicts of Python lists (numpy arrays may come back). Row counts may differ."""
    bound_batches(df.sparkSession)
    fields = [(f.name, f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        from farecast.llm import common

        for clear in common._RELEASE:
            clear()
        out = pa.schema([pa.field(n, to_arrow_type(t)) for n, t in fields])
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                got = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                if got is not None:
                    yield pa.RecordBatch.from_arrays(
                        [c if isinstance(c := got[f.name], pa.Array) else pa.array(c, f.type) for f in out], schema=out
                    )

    return df.mapInArrow(run, schema)


def id_text(col: str = "doc_id") -> Column:
    """The id as text, for the crc32 folds."""
    return F.col(col).cast("string")


def fold(mod: int, col: str = "doc_id") -> Column:
    """crc32(id as text) mod ``mod``; null for a null id."""
    return F.crc32(F.encode(id_text(col), "UTF-8")) % F.lit(mod)


def fold_of(doc_id: int | None, mod: int) -> int | None:
    """Same in Python."""
    import zlib

    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % mod


def hash_sample(df: DataFrame, by: Sequence[str], bound: int) -> DataFrame:
    """At most ``bound`` rows: those with the smallest hash of ``by`` (a top-n, never a full sort)."""
    return df.orderBy(F.xxhash64(*by), *by).limit(bound)


def labelled_sample(
    spark: SparkSession, labels: DataFrame, label: str, mod: int, held_out: int, bound: int, id_type: T.DataType
) -> DataFrame:
    """At most ``bound`` labelled ids outside the held-out fold as a broadcast-sized frame (doc_id, label).

    Null ids and labels are left out; an id with several labels gets their
    rounded mean (ties up). The rows are a top-n by hash of the id, so the
    sample does not depend on partitioning; their number is what bounds the
    broadcast (``bound`` * 16 bytes).
    """
    rows = (
        hash_sample(
            labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(mod) != held_out)).select(
                F.col("doc_id").cast(id_type).alias("doc_id"), F.col(label).cast("int").alias("label")
            ),
            ["doc_id"],
            bound,
        )
        .groupBy("doc_id")
        .agg(F.floor(F.avg("label") + 0.5).cast("int").alias("label"))
        .collect()
    )
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("label", T.IntegerType())])
    return F.broadcast(spark.createDataFrame([(r[0], r[1]) for r in rows], schema))
