"""Standard scaling of the target.

The fit is one global aggregate (mean, population std) whose single row is
the only thing brought to the driver; applying and inverting are Column
arithmetic with those two numbers as literals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farecast.functions.scalar import inverse_zscore, zscore
from farecast.schemas import MONEY


@dataclass(frozen=True)
class Scaler:
    mean: float
    std: float  # population std; 0 is applied as 1

    @property
    def scale(self) -> float:
        return self.std if self.std else 1.0


def scaler_stats(df: DataFrame, col: str = "tip_amount", fit_on: str = "all") -> DataFrame:
    """One-row frame (fit_on, mean, std) -- the fit as a DataFrame (A3).

    ``fit_on='all'`` uses every row (as the original pipeline did, test rows
    included); ``'train'`` only rows with ``data_type = 'train'``.
    """
    rows = df if fit_on == "all" else df.where(F.col("data_type") == F.lit(fit_on))
    x = F.col(col).cast("double")
    return rows.agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")).select(
        F.lit(fit_on).alias("fit_on"), "mean", "std"
    )


def fit_scaler(df: DataFrame, col: str = "tip_amount", fit_on: str = "all") -> Scaler:
    row = scaler_stats(df, col, fit_on).first()
    return Scaler(float(row["mean"] or 0.0), float(row["std"] or 0.0))


def scale(df: DataFrame, scaler: Scaler, col: str = "tip_amount", out: str | None = None) -> DataFrame:
    """Replace (or add ``out``) with the z-score of ``col`` as double."""
    return df.withColumn(out or col, zscore(F.col(col), scaler.mean, scaler.std))


def inverse_scale(
    df: DataFrame, scaler: Scaler, col: str = "scaled_predicted_tip_amount", out: str = "predicted_tip_amount"
) -> DataFrame:
    """``out = decimal(13,2)(col * std + mean)``; the decimal cast rounds half up."""
    return df.withColumn(out, inverse_zscore(F.col(col), scaler.mean, scaler.std).cast(MONEY))
