"""Threshold buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper weight limits in grams, and lower limits of customer value.
WEIGHT_TIERS = ((300, "Light"), (2000, "Medium"), (10000, "Heavy"))
HEAVIEST = "Very Heavy"
VALUE_TIERS = ((1000, "Gold"), (500, "Silver"), (100, "Bronze"))
LOWEST = "New"


def at_most(value: Column, limits: Sequence[tuple[float, str]], beyond: str) -> Column:
    """First label whose upper limit the value does not exceed; NULL falls to ``beyond``."""
    return _first_match([(value <= limit, label) for limit, label in limits], beyond)


def at_least(value: Column, limits: Sequence[tuple[float, str]], below: str) -> Column:
    """First label whose lower limit the value reaches; NULL falls to ``below``."""
    return _first_match([(value >= limit, label) for limit, label in limits], below)


def _first_match(cases: list[tuple[Column, str]], otherwise: str) -> Column:
    return reduce(
        lambda rest, case: F.when(case[0], F.lit(case[1])).otherwise(rest),
        reversed(cases),
        F.lit(otherwise),
    )
