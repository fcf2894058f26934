"""Batch sources: monthly files (S1), saved tables (S2), any format (S3),
small literal inputs (S6)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farecast.schemas import RAW, SILVER

# fixed values: names of one monthly file, as published (month zero-padded) and as landed by the original load
MONTHLY_FILE = "yellow_tripdata_{year}-{month:02d}.parquet"
LANDED_FILE = "yellow_tripdata_{year}_{month}.parquet"

# where a scan found a row: the path of its file, and its number in that file
FILE, ROW = "__file", "__row"


def monthly_path(root: str, year: int, month: int, template: str = MONTHLY_FILE) -> str:
    """Path of one landed monthly file; the month is zero-padded in the name only."""
    return f"{root.rstrip('/')}/{template.format(year=int(year), month=int(month))}"


def read_trips(
    spark: SparkSession,
    root: str,
    year: int,
    month: int,
    schema: T.StructType = RAW,
    template: str = MONTHLY_FILE,
    position: bool | None = False,
) -> DataFrame:
    """Scan one monthly raw file with the file's own types, as ``schema``.

    Columns are matched whatever their case and cast; a column the file does
    not have is NULL. Reading the file's footer is the only job. ``position``
    adds where the scan found each row (``FILE``, ``ROW``); ``None`` adds it
    only to a file without an ``event_id``.
    """
    found = spark.read.parquet(monthly_path(root, year, month, template))
    if position is None:
        position = "event_id" not in {c.lower() for c in found.columns}
    where = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW)] if position else []
    return found.select(*_as_schema(found, schema), *where)


def _as_schema(found: DataFrame, schema: T.StructType) -> list[Column]:
    """The columns of ``schema`` out of a scan, whatever their case there, cast; NULL where it has none."""
    names = {c.lower(): c for c in found.columns}
    return [
        (F.col(f"`{names[f.name.lower()]}`") if f.name.lower() in names else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]


def read_months(
    spark: SparkSession,
    root: str,
    periods: Sequence[tuple[int, int]] | None = None,
    schema: T.StructType = RAW,
    template: str = MONTHLY_FILE,
    period_cols: Sequence[str] = ("metadata_year", "metadata_month"),
) -> DataFrame:
    """Scan many monthly files at once, each row tagged with its file's period (S1 + P1).

    One scan over ``periods`` (their paths alone are listed) or over every file that fits
    ``template``; year and month come from the file's name. The files share their types, as
    ``schema``'s columns are cast from those of one of them; months that differ are read by
    ``read_trips``.
    """
    if periods is None:
        paths = [f"{root.rstrip('/')}/{re.sub(r'{[^}]*}', '*', template)}"]
    else:
        paths = [monthly_path(root, y, m, template) for y, m in periods]
    found = spark.read.parquet(*paths)
    pattern = re.escape(template)
    for field, digits in (("year", r"(?<year>\d+)"), ("month", r"(?<month>\d+)")):
        pattern = re.sub(r"\\{" + field + r"[^}]*\\}", lambda _: digits, pattern)
    order = sorted(("year", "month"), key=lambda f: pattern.index(f"?<{f}>"))
    name = F.col("_metadata.file_path")
    tags = [
        F.regexp_extract(name, f"/{pattern}(/|$)", order.index(f) + 1).cast("int").alias(c)
        for f, c in zip(("year", "month"), period_cols)
    ]
    return found.select(*_as_schema(found, schema), *tags)


def is_table(target: str) -> bool:
    """Whether ``target`` names a catalog table (it has no '/' or ':') and not a path."""
    return "/" not in target and ":" not in target


def read_table(
    spark: SparkSession,
    path: str,
    period: tuple[int, int] | None = None,
    period_cols: Sequence[str] = ("metadata_year", "metadata_month"),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read a saved table (a path, or a catalog name if it has no '/').

    ``period`` filters on the partition columns; on a table written with
    ``partitionBy(year, month)`` the filter prunes directories at planning.
    A known ``schema`` (partition columns included) spares the job that
    reads Parquet footers to infer it.
    """
    if is_table(path):
        df = spark.table(path)
    else:
        df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if period is not None:
        y, m = period
        df = df.where((F.col(period_cols[0]) == F.lit(int(y))) & (F.col(period_cols[1]) == F.lit(int(m))))
    return df


def read_format(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, **options: Any
) -> DataFrame:
    """Generic ``spark.read.format(fmt).load(path)`` (Parquet by default)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def trips_from_rows(
    spark: SparkSession, rows: Iterable[Mapping[str, Any] | Sequence[Any]], schema: T.StructType = SILVER
) -> DataFrame:
    """A small literal frame with the silver columns, used in place of the
    silver table (e.g. one request to score). Rows may be dicts or tuples."""
    ordered = [tuple(r.get(f.name) for f in schema.fields) if isinstance(r, Mapping) else tuple(r) for r in rows]
    return spark.createDataFrame(ordered, schema)
