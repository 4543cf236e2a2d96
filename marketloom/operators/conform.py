"""Fitting a DataFrame to a declared layout, and the numeric clean-up before loading."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType, VarcharType


_BIGINT_END = float(2**63)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the layout's columns by name, cast them, and reject over-long strings.

    A missing column is an error here; a string wider than its declared width is an
    error when the rows are written.  Columns outside the layout are dropped.
    """
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df.select(*[_fit(field) for field in schema.fields])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every double column."""
    doubles = double_columns(df)
    return df.replace(float("nan"), None, subset=doubles) if doubles else df


def integral_columns(df: DataFrame) -> DataFrame:
    """Which double columns hold whole numbers only: (column_name, all_integral).

    Whole numbers are those that fit ``bigint``.  NULL and NaN are ignored; a column
    with nothing else is not integral.  All columns are tested in one pass.
    """
    names = double_columns(df)
    if not names:
        raise ValueError("no double columns")
    tested = nan_to_null(df.select(*names)).agg(*[all_integral(name).alias(name) for name in names])
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.coalesce(F.col(name), F.lit(False)).alias("all_integral"),
        )
        for name in names
    ]
    return tested.select(F.inline(F.array(*rows)))


def all_integral(name: str) -> Column:
    """Aggregate: whether a column without NaN holds whole numbers only; NULL if it is empty."""
    return F.bool_and((F.col(name) % 1 == 0) & (F.abs(name) < _BIGINT_END))


def narrow_integral(df: DataFrame, whole: Sequence[str] | None = None) -> DataFrame:
    """Cast the double columns that hold whole numbers only to ``bigint``.

    ``whole`` names them where they are known, as from the metrics of a staged version
    (``publish.narrowed``).  Otherwise they are measured, which reads ``df``: it is then
    a stored table, not one still to be computed.
    """
    if not double_columns(df):
        return df
    if whole is None:
        rows = integral_columns(df).filter("all_integral").collect()  # one per column at most
        whole = [row["column_name"] for row in rows]
    return nan_to_null(df).withColumns({name: F.col(name).cast("bigint") for name in whole})


def double_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, DoubleType)]


def _fit(field: StructField) -> Column:
    column = F.col(field.name)
    if not isinstance(field.dataType, VarcharType):
        return column.cast(field.dataType).alias(field.name)
    text, width = column.cast("string"), field.dataType.length
    too_long = F.raise_error(F.lit(f"{field.name}: longer than {width} characters"))
    return F.when(F.length(text) > width, too_long.cast("string")).otherwise(text).alias(field.name)


def stack_rows(frames: list[DataFrame]) -> DataFrame:
    """Union of result frames by column name."""
    return reduce(DataFrame.unionByName, frames)
