"""Scalar expressions that batch and streaming share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    """The value as a double, or null where it isn't a finite number."""
    x = x.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def with_finite(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: finite(F.col(c)) for c in columns})


def ratio(a: Column, b: Column) -> Column:
    """a / b, or null where b is 0."""
    return F.try_divide(a, b)


def pick(df: DataFrame, name: str, kind: str) -> Column:
    """A column if the frame has it, else a typed null."""
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
