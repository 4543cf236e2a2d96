"""Small input frames for the unit tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.schemas import RAW, SILVER


def raw(spark: SparkSession, table: str, *rows: dict) -> DataFrame:
    """A raw table; columns a row leaves out are NULL."""
    columns = list(RAW[table])
    data = [tuple(row.get(c) for c in columns) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))


def silver(spark: SparkSession, table: str, *rows: dict) -> DataFrame:
    fields = SILVER[table].fieldNames()
    return spark.createDataFrame([tuple(row.get(c) for c in fields) for row in rows], SILVER[table])


def columns(df: DataFrame, *names: str) -> list[tuple]:
    return sorted((tuple(row) for row in df.select(*names).collect()), key=repr)
