"""Tolerant parsing of raw strings: what cannot be read becomes NULL, never an error.

Plain ``cast`` raises on bad input under ANSI mode, so every conversion here goes
through ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StringType

_DECIMAL_TEXT = r"^\s*([+-]?\d+)\.\d*\s*$"
_BELOW_ONE = r"^\s*[+-]?\.\d+\s*$"


def parse_int(text: Column) -> Column:
    """Read an integer; ``"3.7"`` reads as 3 and ``".5"`` as 0, as a non-ANSI cast does."""
    whole_part = F.regexp_extract(text, _DECIMAL_TEXT, 1)
    below_one = F.when(F.regexp_like(text, F.lit(_BELOW_ONE)), F.lit(0))
    return F.coalesce(text.try_cast("int"), whole_part.try_cast("int"), below_one)


def parse(text: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, IntegerType):
        return parse_int(text)
    return text.try_cast(kind)
