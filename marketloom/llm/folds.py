"""Which rows a model may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_column: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text, modulo `folds`, is `fold`; false for a null id."""
    hashed = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(hashed % folds == fold, F.lit(False))


#: A sample is thinned to about this many times its size before it is put in order.
SPARE = 5
_STEPS = 1 << 30


def thinned(rows: DataFrame, order: Column, total: Column | int, wanted: int) -> DataFrame:
    """Rows from which the first `wanted` of `total` in `order`, a hash, can be taken.

    Only rows whose hash is small enough stay, about SPARE * `wanted` of them however many there
    are, so that no task has to put more than that in order. Which rows these are follows from
    the rows alone. With up to SPARE * `wanted` rows all stay.
    """
    share = F.lit(float(SPARE * wanted)) / total
    return rows.where(F.pmod(order, F.lit(_STEPS)) < share * _STEPS)


def sample_texts(
    docs: DataFrame, chosen: DataFrame, id_column: str, text_column: str
) -> DataFrame:
    """(doc_id, target, text) of the chosen (doc_id, target), one row for each.

    `chosen` is a sample of a bounded number of rows, which is why it is broadcast. Of rows with
    one doc_id the smallest text counts.
    """
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return (
        narrow.where(F.col("text").isNotNull())
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "target")
        .agg(F.min("text").alias("text"))
    )
