"""Small documents, and documents that are awkward in every column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as extra columns of the input.
CLASHING = (
    "fingerprint", "row", "_salt", "hash", "size", "n", "anchor", "score", "copies", "length",
    "start", "budget", "tokens", "domain", "n_tokens", "found", "target", "id0", "data", "digest",
    "component_id", "gone", "prefix", "rank", "label",
)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents from (doc_id, text) or whole rows."""
    whole = [
        row if len(row) == 5 else (*row, "en", "src1", None if row[1] is None else len(row[1]))
        for row in rows
    ]
    return spark.createDataFrame(whole, SCHEMA)


def with_clashes(docs: DataFrame) -> DataFrame:
    names = [name for name in CLASHING if name not in docs.columns]
    return docs.withColumns({name: F.lit("x") for name in names})


AWKWARD = [
    (0, None, None, None, None),
    (1, "", "en", "src0", 0),
    (2, " \n\t ", "en", None, 5),
    (3, "word", None, "src1", 4),
    (None, "no id here at all, is there", "en", "src2", None),
    (4, "the same text twice over", "de", "nonsense", 24),
    (5, "the same text twice over", "de", "src3", 24),
    (5, "the same text twice over", "de", "src3", 24),
    (6, "é 漢字 \U0001f642 text" * 20, "fr", "src4", None),
    (7, "long " * 30_000, "en", "src0", 150_000),
    (8, "x" * 200_000, "en", "src0", 200_000),
    (9, "12345 67890", "es", "src5", 11),
    (-3, "a negative id", "en", "src1", 13),
]
