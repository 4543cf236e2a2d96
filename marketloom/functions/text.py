"""Text clean-up for names and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "unknown"


def title_text(column: Column) -> Column:
    """Trim spaces and capitalise each space-separated word."""
    return F.initcap(F.trim(column))


def code_text(column: Column) -> Column:
    """Trim spaces and upper-case."""
    return F.upper(F.trim(column))


def or_unknown(*choices: Column) -> Column:
    """The first non-NULL choice, else the ``unknown`` label."""
    return F.coalesce(*choices, F.lit(UNKNOWN))
