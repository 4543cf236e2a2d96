"""What was measured of a version while it was written, kept beside the tables.

A version's metrics are one row in ``<root>/_metrics/v=<run_id>/<table>``, written after its
files: rows, NULLs of each column, the double columns that hold whole numbers only, and the
number and total size of the files.  Validation reads these rows and lists the files.  It
opens none of them, and still notices a version with files lost, added or cut short.  A
version without metrics was never finished.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.conform import stack_rows
from marketloom.sources.manifest import version_path

_METRICS = (
    "table_name string, rows long, nulls map<string, long>, whole array<string>,"
    " files long, bytes long"
)


def keep(
    spark: SparkSession,
    root: str,
    table: str,
    run_id: str,
    rows: int,
    nulls: Mapping[str, int],
    whole: Sequence[str],
) -> None:
    """Write the metrics of a version whose files are complete."""
    found = stored_files(spark, root, [table], run_id).first()
    row = (table, rows, dict(nulls), list(whole), found["found_files"], found["found_bytes"])
    metrics = spark.createDataFrame([row], _METRICS).coalesce(1)
    metrics.write.mode("errorifexists").parquet(f"{_path(root, run_id)}/{table}")


def written(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The metrics of a run's versions, a row for each table that was finished."""
    reader = spark.read.schema(_METRICS).option("recursiveFileLookup", True)
    return reader.parquet(_path(root, run_id))


def stored_files(
    spark: SparkSession, root: str, tables: Iterable[str], run_id: str
) -> DataFrame:
    """(table_name, found_files, found_bytes) of the versions, from a listing of their files."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    listing = listing.option("pathGlobFilter", "*.parquet")
    totals = (
        F.count(F.lit(1)).alias("found_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("found_bytes"),
    )
    return stack_rows(
        [
            listing.load(version_path(root, table, run_id))
            .agg(*totals)
            .withColumn("table_name", F.lit(table))
            for table in tables
        ]
    )


def _path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/_metrics/v={run_id}"
