import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, TimestampNTZType

from marketloom.functions.buckets import (
    HEAVIEST,
    LOWEST,
    VALUE_TIERS,
    WEIGHT_TIERS,
    at_least,
    at_most,
)
from marketloom.functions.dates import date_key
from marketloom.functions.money import (
    DIRECT,
    average,
    avg_whole,
    grouped,
    no_large,
    rounded,
    valid,
)
from marketloom.functions.parsing import parse
from marketloom.functions.text import code_text, title_text


def values(spark, expressions, rows, schema):
    out = spark.createDataFrame([(r,) for r in rows], schema).select(expressions.alias("out"))
    return [row["out"] for row in out.collect()]


def one(spark, aggregate, rows, kind="double"):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return df.agg(aggregate.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "kind, texts, expected",
    [
        (DoubleType(), ["1.5", " 2 ", "abc", "", None], [1.5, 2.0, None, None, None]),
        (
            IntegerType(),
            ["4", "4.0", "4.9", "-3.2", " 7 ", "1e2", "x", "99999999999", "", ".5", "-.5", ".", None],
            [4, 4, 4, -3, 7, None, None, None, None, 0, 0, None, None],
        ),
    ],
)
def test_bad_numbers_become_null(spark, kind, texts, expected):
    assert values(spark, parse(F.col("x"), kind), texts, "x string") == expected


def test_bad_timestamps_become_null(spark):
    texts = ["2018-01-02 03:04:05", "2018-01-02", "2018-13-45", "garbage", "", None]
    out = values(spark, parse(F.col("x"), TimestampNTZType()).cast("string"), texts, "x string")
    assert out == ["2018-01-02 03:04:05", "2018-01-02 00:00:00", None, None, None, None]


def test_text(spark):
    assert values(spark, title_text(F.col("x")), ["  são PAULO-d oeste "], "x string") == [
        "São Paulo-d Oeste"
    ]
    assert values(spark, code_text(F.col("x")), [" sp "], "x string") == ["SP"]


def test_weight_tiers(spark):
    weights = [300.0, 301.0, 2000.0, 2001.0, 10000.0, 10001.0, None]
    tiers = ["Light", "Medium", "Medium", "Heavy", "Heavy", "Very Heavy", "Very Heavy"]
    tier = at_most(F.col("x"), WEIGHT_TIERS, HEAVIEST)
    assert values(spark, tier, weights, "x double") == tiers


def test_value_tiers(spark):
    amounts = [99.99, 100.0, 499.99, 500.0, 999.99, 1000.0, None]
    tiers = ["New", "Bronze", "Bronze", "Silver", "Silver", "Gold", "New"]
    tier = at_least(F.col("x"), VALUE_TIERS, LOWEST)
    assert values(spark, tier, amounts, "x double") == tiers


def test_date_key(spark):
    assert values(spark, date_key(F.to_date("x")), ["2016-01-09"], "x string") == [20160109]


def total(spark, amounts, digits=2):
    df = spark.createDataFrame([(x,) for x in amounts], "x double")
    return grouped(df, [], {"t": "x"}).select(rounded("t", digits)).first()[0]


def mean(spark, amounts):
    df = spark.createDataFrame([(x,) for x in amounts], "x double")
    sums = grouped(df, [], {"t": "x"}, {"n": F.count(valid(F.col("x")))})
    return sums.select(average("t", "n")).first()[0]


def test_sum_is_exact_and_ignores_missing(spark):
    assert total(spark, [0.1] * 10) == 1.0
    assert total(spark, [1.005, None, math.nan]) == 1.01
    assert total(spark, digits=None, amounts=[1.0025, 1.0001]) == 2.0026
    assert total(spark, [None]) is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_extreme_amounts(spark, ansi):
    """Every finite amount counts; nothing raises or wraps around, whatever the ANSI setting."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        big = DIRECT
        assert total(spark, [big, big, 0.25]) == 2 * big + 0.25
        assert total(spark, [1e15, 2.0]) == 1000000000000002.0
        assert total(spark, [1e20]) == 1e20
        assert total(spark, [1e300, 12.25, -1e300, math.nan]) == 12.25
        assert total(spark, [1e308, 1e308, -1e308]) == 1e308
        assert total(spark, [1e308, 1e308]) == math.inf
        assert mean(spark, [math.inf, 2.0, 4.0]) == 3.0
        assert mean(spark, [-big, -big]) == -big
        assert mean(spark, [1e20, 2e20]) == 1.5e20
        assert total(spark, [math.inf]) is None
        assert total(spark, [-0.1] * 7 + [-big]) == -big - 0.7
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_sums_of_any_size_are_exact(spark):
    """Against fractions: totals and averages are the nearest doubles, whatever cancels out."""
    rng = random.Random(3)
    special = [1e15, -1e15, 2.0, 1e20, -1e20, DIRECT, -DIRECT, math.inf, math.nan, 2.0**70, -(2.0**70)]
    kinds = (
        lambda: round(rng.uniform(-1e6, 1e6), 2),
        lambda: rng.uniform(-1, 1) * 10 ** rng.uniform(14, 18),
        lambda: rng.uniform(-1, 1) * 10 ** rng.uniform(0, 300),
        lambda: rng.choice(special),
        lambda: rng.choice([-1, 1]) * 2.0 ** rng.randrange(50, 1000),
    )
    groups = {
        g: [rng.choice(kinds)() for _ in range(rng.randrange(1, 9))]
        if g % 2
        else [kinds[g // 2 % 5]() for _ in range(rng.randrange(1, 9))]
        for g in range(400)
    }
    rows = [(g, g % 7, x) for g, amounts in groups.items() for x in amounts]
    own = [(g, g % 7) for g in groups]
    df = spark.createDataFrame(rows, "g int, h int, x double")
    parts = grouped(df, ["g", "h"], {"t": "x"}, {"n": F.count(valid(F.col("x")))}).withColumn(
        "a", average("t", "n")
    )
    exact = {}
    for g, amounts in groups.items():
        finite = [x for x in amounts if math.isfinite(x)]
        units = [Fraction(round(x * 10000)) if abs(x) <= DIRECT else 10000 * Fraction(x) for x in finite]
        exact[g] = sum(units, Fraction(0)) / 10000, len(finite)
    for row in parts.select("g", rounded("t", None).alias("s"), "a").collect():
        total, count = exact[row["g"]]
        if not count:
            assert row["s"] is None and row["a"] is None
            continue
        assert row["s"] == float(total)
        if abs(total) >= Fraction(DIRECT) * count:
            assert row["a"] == float(total) / count
        else:
            cents = math.floor(abs(total) / count * 100 + Fraction(1, 2))
            assert row["a"] == float(Fraction(cents if total >= 0 else -cents, 100))
    again = grouped(parts, ["h"], {"u": "t"}, sums=True)
    for row in again.select("h", rounded("u", None).alias("s")).collect():
        assert row["s"] == float(sum(exact[g][0] for g, h in own if h == row["h"]))


def test_plain_sums_are_the_general_ones_and_are_grouped_once(spark, capsys):
    rows = [(1, 0.1), (1, 0.2), (1, math.nan), (2, None), (None, -DIRECT), (None, DIRECT), (3, math.inf)]
    df = spark.createDataFrame(rows, "g int, x double")
    others = {"n": F.count(valid(F.col("x")))}
    found = {}
    for plain in (False, True):
        sums = grouped(df, ["g"], {"t": "x"}, others, plain=plain)
        fine = sums.select("g", rounded("t").alias("s"), average("t", "n").alias("a"), "n")
        found[plain] = sorted(map(tuple, fine.collect()), key=repr)
        assert sums.schema["t"].dataType.fieldNames() == ["high", "middle", "low", "places"]
    assert found[True] == found[False]
    capsys.readouterr()
    sums.explain()
    tree = capsys.readouterr().out
    assert tree.count("Exchange") == 1 and "Generate" not in tree
    with pytest.raises(ValueError):
        grouped(sums, ["n"], {"u": "t"}, sums=True, plain=True)


def test_unasked_aggregates_are_not_computed(spark, capsys):
    df = spark.createDataFrame([(1, "a", 1.0)], "g int, k string, x double")
    sums = grouped(df, ["g"], {"t": "x"}, {"kinds": F.count_distinct("k")})
    capsys.readouterr()
    sums.select("g", "t").explain()
    assert "distinct" not in capsys.readouterr().out


@pytest.mark.parametrize(
    "amounts, expected",
    [([1.0, None, DIRECT, -DIRECT], True), ([], True), ([1.0, 1e15], False), ([-1e15], False)],
)
def test_stored_large_amounts_are_noticed(spark, tmp_path, amounts, expected):
    df = spark.createDataFrame([(1.0, x) for x in amounts], "y double, x double")
    df.write.parquet(f"{tmp_path}/t")
    assert no_large(spark.read.parquet(f"{tmp_path}/t"), "y", "x") is expected


def test_averages_round_half_up(spark):
    assert mean(spark, [0.01, 0.02]) == 0.02
    assert mean(spark, [1.0, None]) == 1.0
    assert mean(spark, [None]) is None
    assert one(spark, avg_whole("x", 1), [0] * 19 + [1], "int") == 0.1
    assert one(spark, avg_whole("x", 1), [0] * 19 + [-1], "int") == -0.1


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(cents=st.lists(st.integers(0, 10**9), min_size=1, max_size=40))
def test_sum_does_not_depend_on_order(spark, cents):
    amounts = [c / 100 for c in cents]
    expected = sum(cents) / 100
    assert total(spark, amounts) == expected
    assert total(spark, amounts[::-1]) == expected
