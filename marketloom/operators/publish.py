"""Publishing: stage a version, validate what was staged, then point readers to it.

Each run writes its own ``<root>/<table>/v=<run_id>`` folder.  One publication in the
manifest beside the tables (``sources/manifest.py``) then makes all of them the published
ones: readers see the old or the new set of versions and never a part of either.  It needs
no catalog and outlasts every session.  A version that fails validation is never in it.
Catalog views of the published versions can be made for convenience.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketloom.operators.conform import (
    all_integral,
    conform,
    double_columns,
    nan_to_null,
    narrow_integral,
)
from marketloom.operators.quality import STAGING_MINIMA, NoNulls, enforce
from marketloom.schemas import GOLD, PARTITIONS, stored
from marketloom.sources import metrics
from marketloom.sources.manifest import announce, version_path, versions
from marketloom.sources.tables import read_table, write_measured

DATABASE = "warehouse"

# Sorted files let readers skip row groups.  A partitioned write sorts its rows by the
# partition columns anyway, so one more column there costs little.
# Column and direction (True: descending).
SORT_WITHIN = {
    "fact_orders": ("order_date_key", False),
    "revenue_by_category": ("total_revenue", True),
}


def stage(df: DataFrame, root: str, table: str, run_id: str) -> int:
    """Conform the table, write it as a new version, and return its row count.

    The version's metrics are observed during the write and kept beside it.
    """
    fitted = nan_to_null(conform(df, GOLD[table]))
    path = version_path(root, table, run_id)
    order = []
    if table in SORT_WITHIN:
        name, descending = SORT_WITHIN[table]
        order.append(F.desc(name) if descending else F.asc(name))
    columns, doubles = fitted.columns, double_columns(fitted)
    measures = {f"nulls_{n}": F.count_if(F.col(c).isNull()) for n, c in enumerate(columns)}
    measures |= {f"whole_{n}": all_integral(c) for n, c in enumerate(doubles)}
    found = write_measured(
        fitted, path, PARTITIONS.get(table, ()), order, mode="errorifexists", measures=measures
    )
    nulls = {c: found[f"nulls_{n}"] for n, c in enumerate(columns)}
    whole = [c for n, c in enumerate(doubles) if found[f"whole_{n}"]]
    metrics.keep(df.sparkSession, root, table, run_id, found["rows"], nulls, whole)
    return found["rows"]


def staged(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame:
    return read_table(spark, version_path(root, table, run_id), GOLD[table])


def narrowed(spark: SparkSession, root: str, table: str, run_id: str) -> DataFrame:
    """A staged version, its doubles that hold whole numbers only as ``bigint``.

    Which ones do is known from the version's metrics; the table is not read for it.
    """
    found = metrics.written(spark, root, run_id).where(F.col("table_name") == table).first()
    if found is None:
        raise LookupError(f"{table} of {run_id} has no metrics under {root}")
    return narrow_integral(staged(spark, root, table, run_id), found["whole"])


def staged_checks(
    spark: SparkSession,
    root: str,
    tables: Iterable[str],
    run_id: str,
    minima: Mapping[str, int] = STAGING_MINIMA,
    not_null: Sequence[NoNulls] = (),
) -> DataFrame:
    """Checks of staged versions from their metrics and a listing of their files, as rows.

    Each table has at least its minimum of rows (one without a minimum: one row).  One whose
    files are not those written, judged by their number and total size, has a failed row
    ``stored_bytes`` more.  ``not_null`` names columns that must have no NULL.  A version
    without metrics fails.
    """
    names = list(tables)
    wanted = spark.createDataFrame(
        [(name, minima.get(name, 1)) for name in names], "table_name string, least long"
    )
    versions_found = (
        wanted.join(metrics.written(spark, root, run_id), "table_name", "left")
        .join(metrics.stored_files(spark, root, names, run_id), "table_name", "left")
        .withColumn("missing", F.col("rows").isNull())
    )

    def row(name: Column, observed: Column, expected: Column, passed: Column) -> Column:
        return F.struct(
            "table_name",
            name.alias("check_name"),
            F.coalesce(observed, F.lit(0)).cast("bigint").alias("observed"),
            F.coalesce(expected, F.lit(0)).cast("bigint").alias("expected"),
            F.coalesce(passed & ~F.col("missing"), F.lit(False)).alias("passed"),
        )

    rows, least = F.col("rows"), F.col("least")
    intact = F.expr("coalesce(found_files = files and found_bytes = bytes, false)")
    stored_bytes = row(F.lit("stored_bytes"), F.col("found_bytes"), F.col("bytes"), intact)
    checks = [
        row(F.lit("min_rows"), rows, least, rows >= least),
        F.when(~intact, stored_bytes),
    ]
    for check in not_null:
        nulls = F.col("nulls")[check.column]
        asked = row(F.lit(check.name), nulls, F.lit(0), nulls == 0)
        checks.append(F.when(F.col("table_name") == check.table, asked))
    return versions_found.select(
        F.inline(F.filter(F.array(*checks), lambda found: found.isNotNull()))
    )


def validate(
    spark: SparkSession,
    root: str,
    tables: Iterable[str],
    run_id: str,
    minima: Mapping[str, int] = STAGING_MINIMA,
    not_null: Sequence[NoNulls] = (),
) -> list[str]:
    """Check the staged versions; raises before anything is swapped."""
    return enforce(staged_checks(spark, root, tables, run_id, minima, not_null))


def published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The published version of a table, found through the manifest."""
    found = versions(spark, root)
    if table not in found:
        raise LookupError(f"{table} has not been published under {root}")
    return staged(spark, root, table, found[table])


def make_views(
    spark: SparkSession, root: str, tables: Iterable[str], database: str = DATABASE
) -> None:
    """Replace the catalog's views of the tables by ones of their published versions."""
    current = versions(spark, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in tables:
        columns = ", ".join(_typed_columns(GOLD[table]))
        source = f"parquet.`{version_path(root, table, current[table])}`"
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT {columns} FROM {source}")


def publish(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    run_id: str,
    minima: Mapping[str, int] = STAGING_MINIMA,
    database: str | None = None,
) -> list[str]:
    """Stage all tables, validate all of them, publish them, and make views in ``database``."""
    for table, df in frames.items():
        stage(df, root, table, run_id)
    lines = validate(spark, root, frames, run_id, minima)
    announce(spark, root, frames, run_id)
    if database:
        make_views(spark, root, frames, database)
    return lines


def _typed_columns(schema: StructType) -> list[str]:
    """Casts keep the view's types when a partition column is inferred from the folders."""
    return [
        f"CAST({field.name} AS {field.dataType.simpleString()}) AS {field.name}"
        for field in stored(schema).fields
    ]
