"""Getting a session ready for operators that run Python in its workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that a worker gets at a time, unless the session says otherwise: documents can be long.
ROWS = 1000

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Hand the package to the workers, and keep their batches small."""
    ship(spark)
    if spark.conf.get(BATCH_ROWS, None) is None:
        spark.conf.set(BATCH_ROWS, ROWS)


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark as a Python file, once per application, like --py-files."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    folder = os.path.realpath(tempfile.mkdtemp())
    target = os.path.join(folder, f"{package.name}.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)
