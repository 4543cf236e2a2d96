"""Which version of each table counts: a manifest of publications, each a folder of its own.

Tables lie under a root as ``<root>/<table>/v=<run_id>``.  A publication names the tables
it publishes and their version, and nothing of the other tables.  It is one file in a
folder that no other writer uses, and it appears by one rename.  So publishers never meet:
two at once both show up, in whatever order they finish, and no lock or retry is needed.
Readers take each table's publication with the highest number; of publications made at the
same time, which share a number, all readers take the same one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_PUBLICATION = "number long, token string, run_id string, tables array<string>"


def version_path(root: str, table: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{table}/v={run_id}"


def versions(spark: SparkSession, root: str) -> dict[str, str]:
    """The published version of each table; empty before the first publication."""
    return _latest(spark, root)[1]


def announce(spark: SparkSession, root: str, tables: Iterable[str], run_id: str) -> None:
    """Make the written versions the published ones, all at once; other tables keep theirs."""
    token = uuid.uuid4().hex
    row = (_latest(spark, root)[0] + 1, token, run_id, list(tables))
    publication = spark.createDataFrame([row], _PUBLICATION).coalesce(1)
    publication.write.mode("errorifexists").parquet(f"{_manifest_path(root)}/{token}")


def _latest(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number of the last publication, 0 before the first, and each table's version."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_manifest_path(root))
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return 0, {}
    reader = spark.read.schema(_PUBLICATION).option("recursiveFileLookup", True)
    latest = (
        reader.parquet(_manifest_path(root))
        .withColumns({"name": F.explode("tables"), "at": F.struct("number", "token")})
        .groupBy("name")
        .agg(F.max("number").alias("number"), F.max_by("run_id", "at").alias("run_id"))
        .collect()  # a row for each table
    )
    found = {row["name"]: row["run_id"] for row in latest}
    return max((row["number"] for row in latest), default=0), found


def _manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/_published"
