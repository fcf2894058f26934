"""Scalar column helpers.

The scaler arithmetic is plain Column arithmetic (codegen, no Python worker).
``apply_scalar`` is the one escape hatch for a caller's own element-wise
function; it runs as an Arrow-batched pandas UDF, never row at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def zscore(x: Column, mean: float, std: float) -> Column:
    """(x - mean) / std, with a zero std treated as 1 (constant target)."""
    return (x.cast("double") - F.lit(float(mean))) / F.lit(float(std) if std else 1.0)


def inverse_zscore(z: Column, mean: float, std: float) -> Column:
    """z * std + mean, the inverse of :func:`zscore`."""
    return z.cast("double") * F.lit(float(std) if std else 1.0) + F.lit(float(mean))


def apply_scalar(
    df: DataFrame,
    in_col: str,
    out_col: str,
    fn: Callable[[pd.Series], pd.Series],
    return_type: T.DataType | str = "double",
) -> DataFrame:
    """Add ``out_col = fn(in_col)`` computed batch-wise by a pandas UDF."""
    udf = F.pandas_udf(fn, returnType=return_type)
    return df.withColumn(out_col, udf(F.col(in_col)))


def comparable(df: DataFrame, text_cols: tuple[str, ...] = ()) -> DataFrame:
    """Project a result to types that compare equal across engines.

    decimal and float -> double, timestamps -> 'yyyy-MM-dd HH:mm:ss.SSSSSS'
    text, ``text_cols`` (integer columns holding NULLs, which pandas turns
    into floats on one side and nullable ints on the other) -> text. Used
    only at the output of the registered check queries.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in text_cols:
            c = c.cast("string")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        cols.append(c.alias(f.name))
    return df.select(*cols)
