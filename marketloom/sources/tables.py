"""CSV and Parquet readers and writers."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketloom.schemas import stored


#: Column of ``read_raw_csv`` with the text of a line that does not fit the header.
MALFORMED = "_malformed"

# A task reads a compressed text file whole, so none is longer than this.
_ROWS_PER_TEXT_FILE = 250_000
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_raw_csv(
    spark: SparkSession, path: str, required: Iterable[str] = (), malformed: bool = False
) -> DataFrame:
    """Read header CSV with every column as a string; extra columns are kept.

    The first header gives the names.  Every further file must carry the same
    header (``enforceSchema`` off), so reordered columns fail instead of mixing.  A line
    with too few or too many fields gives what it has and NULLs; with ``malformed`` a last
    column holds its text, and NULL for lines that fit.
    """
    names = spark.read.option("header", True).csv(path).schema
    missing = [name for name in required if name not in names.fieldNames()]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if not malformed:
        return reader.schema(names).csv(path)
    reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    whole = StructType([*names.fields, StructField(MALFORMED, StringType())])
    lines = reader.schema(whole).csv(path)
    # Spark counts the fields it reads, so this column takes all others along.
    with_others = F.length(F.concat_ws("", MALFORMED, *names.fieldNames())) >= 0
    return lines.withColumn(MALFORMED, F.when(with_others, F.col(MALFORMED)))


def one_delivery(spark: SparkSession, pattern: str) -> None:
    """Raise if the pattern of a path meets files or folders of more than one name.

    A stray second delivery would otherwise be merged in silently.  Only names are listed.
    """
    name = re.escape(pattern.rpartition("/")[2]).replace(r"\*", "[^/]*")
    listed = spark.read.format("binaryFile").load(pattern).select(
        F.regexp_extract("path", f"/({name})(/|$)", 1).alias("name")
    )
    names = [row["name"] for row in listed.distinct().limit(2).collect()]
    if len(names) > 1:
        raise ValueError(f"{pattern} meets more than one delivery: {sorted(names)}")


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write header CSV that ``read_raw_csv`` reads back unchanged, padding included.

    It is gzip at its fastest level: a delivery is read once, and plain text takes several
    times the room of the tables made of it.
    """
    writer = df.write.mode("errorifexists").option("header", True)
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer = writer.option("maxRecordsPerFile", _ROWS_PER_TEXT_FILE)
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a Parquet table by its declared schema, in the declared column order.

    Declaring the schema keeps partition columns typed even when a partition holds
    only NULLs, and spares the footer read that inference needs.
    """
    return spark.read.schema(stored(schema)).parquet(path).select(*schema.fieldNames())


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[Column] = (),
    mode: str = "overwrite",
) -> int:
    """Write Parquet and return the number of rows written, counted during the write."""
    return write_measured(df, path, partition_by, sort_by, mode)["rows"]


def write_measured(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[Column] = (),
    mode: str = "overwrite",
    measures: Mapping[str, Column] | None = None,
) -> dict[str, Any]:
    """Write Parquet and return what was observed of the rows during the write.

    That is their number, ``rows``, and the aggregates given as ``measures``.

    Overwriting replaces the whole table, partitions without new rows included.
    Partitioned tables are rebalanced on the partition columns first.  Adaptive
    execution then merges small months and splits large ones, so neither a swarm of
    small files nor a single task holding a whole month can arise.
    """
    counted = Observation()
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    others = [measure.alias(name) for name, measure in (measures or {}).items()]
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows"), *others).write.mode(mode)
    writer = writer.option("partitionOverwriteMode", "static").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return counted.get


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each write or query when it ends, not whenever Java collects.

    Otherwise those of all steps of a run can lie on the executors' disks at once.
    """
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, in the folder all executors share.

    The folder is ``spark.checkpoint.dir``, or the warehouse where that is unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or (
        f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    )
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
