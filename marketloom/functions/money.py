"""Exact, order-independent sums and averages of amounts stored as doubles.

Adding doubles gives a result that depends on the order in which partitions are
merged, so a rerun or a lost executor can change the last digits.  Amounts are
therefore summed as whole 1/10000 units: associative, inside code generation, and
about twice as fast here as summing decimals.  The units are cut into three parts of
21 bits, so that no part's ``bigint`` sum can overflow before there are four million
million rows.  Amounts with up to four decimals are exact.

Units of amounts beyond ``DIRECT`` do not fit a ``bigint``.  Such an amount is a whole
number of eighths, of up to 1027 bits.  Its bits go to places of 30 bits, and each place
is a ``bigint`` sum of its own: a superaccumulator.  ``grouped`` sums it as a row for each
place, which amounts of the usual size never have: they pay for one null column.  No
place overflows before there are eight thousand million amounts of that size in one group.
Carries are settled once per group, and a total is rounded once, to the nearest double.

The arithmetic is SQL text, which Spark parses in one go.

Every finite amount counts.  One that is infinite or NaN is none and counts as missing,
whatever the session's ANSI setting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to here the units of an amount are a bigint.
DIRECT = 9e14
UNITS = 10_000
_UNIT = "0.0001BD"
_PART = 21  # bits of a part of the units
_PLACE = 30  # bits of a place of the large amounts
_EIGHTH = UNITS // 8
_PLACES = -(-(1024 + 3) // _PLACE)
# Totals below this many places are handled as decimals.
_NARROW = 3
_INFINITY = "double('infinity')"
_FIELDS = ("high", "middle", "low")


def valid(amount: Column) -> Column:
    """The amount, or NULL for what is none."""
    return F.when(F.abs(amount) < F.expr(_INFINITY), amount)  # NaN is above every number


def grouped(
    rows: DataFrame,
    keys: Sequence[str],
    amounts: Mapping[str, str],
    others: Mapping[str, Column] | None = None,
    sums: bool = False,
    plain: bool = False,
) -> DataFrame:
    """The rows grouped by keys: exact sums of the amounts, and other aggregates.

    ``amounts`` names the columns to sum: doubles, or with ``sums`` exact sums.  An exact
    sum is a struct for ``rounded`` and ``average``.  Each row goes into its group once,
    and once for every place of an amount beyond ``DIRECT``; those add up by themselves,
    combined within map tasks like all else.

    ``plain`` says that no amount is beyond ``DIRECT``, as ``no_large`` finds of a stored
    table.  The rows are then grouped by the keys alone, once.
    """
    others = others or {}
    named = [aggregate.alias(name) for name, aggregate in others.items()]
    if plain:
        if sums:
            raise ValueError("exact sums tell by themselves whether they are large")
        return rows.groupBy(*keys).agg(*[_plain_sum(c, n) for n, c in amounts.items()], *named)
    parts = {name: _sum_parts(c) if sums else _parts(c) for name, c in amounts.items()}
    places = [
        _numbered(f"{c}.places IS NOT NULL", _sum_places(c), n)
        if sums
        else _numbered(_is_large(c), _places(c), n)
        for n, c in enumerate(amounts.values())
    ]
    itself = "array(CAST(NULL AS struct<amount: int, place: int, digit: bigint>))"
    each = rows.withColumn("_large", F.expr(f"explode(concat({itself}, {', '.join(places)}))"))
    totals = [
        F.expr(f"struct({', '.join(f'sum({p}) AS {f}' for f, p in fields.items())})").alias(name)
        for name, fields in parts.items()
    ]
    place = F.expr("struct(_large.amount, _large.place)").alias("_place")
    found = each.groupBy(*keys, place).agg(F.sum("_large.digit").alias("_digit"), *totals, *named)
    # Each by itself, so that one nobody asks for is not computed.
    whole = [
        F.expr(f"max({name}) FILTER (WHERE _place.place IS NULL)").alias(name)
        for name in [*amounts, *others]
    ]
    joined = found.groupBy(*keys).agg(
        *whole,
        # A place is one row here.
        F.expr(
            "collect_list(struct(_place.amount, _place.place, _digit))"
            " FILTER (WHERE _place.place IS NOT NULL)"
        ).alias("_larges"),
    )
    settled = [
        F.expr(
            f"struct({', '.join(f'{name}.{f} AS {f}' for f in _FIELDS)},"
            f" {_dense(n)} AS places)"
        ).alias(name)
        for n, name in enumerate(amounts)
    ]
    return joined.select(*keys, *settled, *others)


def no_large(rows: DataFrame, *amounts: str) -> bool:
    """Whether a stored table has no amount beyond ``DIRECT`` in these columns.

    The files' own minima and maxima answer for nearly all of them; one such amount ends it.
    """
    beyond = [(F.col(c) > DIRECT) | (F.col(c) < -DIRECT) for c in amounts]
    return rows.select(*amounts).filter(reduce(or_, beyond)).isEmpty()


def rounded(total: str, digits: int | None = 2) -> Column:
    """An exact sum as a double amount, rounded half up; unrounded with ``digits`` None."""
    large = _let("x", _settled(total), _large_amount("x", digits))
    small = _fine(_small_amount(total), digits)
    return F.expr(f"if({total}.places IS NOT NULL, {large}, {small})")


def average(total: str, count: str, digits: int = 2) -> Column:
    """An exact sum divided by a count, rounded half up; NULL when the count is zero.

    Beyond ``DIRECT`` the total is rounded to a double first.
    """
    amount = f"{_joined('x', '0')} * {_UNIT}"
    fits = f"x.top < {_NARROW} AND abs({amount}) < {int(DIRECT)}BD * {count}"
    wide = f"try_divide({_large_amount('x', None)}, {count})"
    large = _let("x", _settled(total), f"if({fits}, {_ratio(amount, count, digits)}, {wide})")
    small = _ratio(_small_amount(total), count, digits)
    return F.expr(f"if({total}.places IS NOT NULL, {large}, {small})")


def avg_whole(number: str, digits: int) -> Column:
    """Average of an integer column, rounded half up."""
    return F.expr(_ratio(f"sum(CAST({number} AS bigint))", f"count({number})", digits))


def ratio(total: str, count: str, digits: int) -> Column:
    """Quotient of an amount and a count rounded half up; NULL when the count is zero."""
    return F.expr(_ratio(total, count, digits))


def _ratio(total: str, count: str, digits: int) -> str:
    """In whole numbers, so that no digit of an intermediate quotient is cut off."""
    units = f"CAST(CAST(abs({total}) AS decimal(30,4)) * {UNITS} AS decimal(33,0))"
    below = f"(CAST({count} AS decimal(20,0)) * {UNITS})"
    whole = f"(({units} * {2 * 10**digits} + {below}) div nullif(2 * {below}, 0BD))"
    quotient = f"CAST(CAST({whole} AS decimal(20,0)) * {10.0**-digits:.{digits}f}BD AS double)"
    return f"if(({total}) < 0, -{quotient}, {quotient})"


def _parts(amount: str) -> dict[str, str]:
    """Three parts of the units of an amount that is not large."""
    units = f"CAST(if(abs({amount}) <= {DIRECT!r}D, rint({amount} * {UNITS}D), NULL) AS bigint)"
    low = 2**_PART - 1
    return {
        "high": f"shiftright({units}, {2 * _PART})",
        "middle": f"shiftright({units}, {_PART}) & {low}L",
        "low": f"{units} & {low}L",
    }


def _plain_sum(amount: str, name: str) -> Column:
    fields = ", ".join(f"sum({part}) AS {field}" for field, part in _parts(amount).items())
    return F.expr(f"struct({fields}, CAST(NULL AS array<bigint>) AS places)").alias(name)


def _sum_parts(total: str) -> dict[str, str]:
    return {field: f"{total}.{field}" for field in _FIELDS}


def _is_large(amount: str) -> str:
    return f"abs({amount}) > {DIRECT!r}D AND abs({amount}) < {_INFINITY}"


def _places(amount: str) -> str:
    """(place, digit) of an amount.

    Every step is exact: a remainder of doubles is never rounded, and a power of two, which
    is infinite for the last place, changes the exponent only.  The logarithm may be off by
    one; 53 bits reach over three places.
    """
    highest = f"CAST(floor((log2(abs({amount})) + 3) / {_PLACE}) AS int)"
    bits = f"(abs({amount}) % pow(2D, {_PLACE} * (n + 1) - 3)) * pow(2D, 3 - {_PLACE} * n)"
    digit = f"CAST(signum({amount}) * ({bits} - ({bits}) % 1D) AS bigint)"
    near = f"sequence(greatest({highest} - 3, 0), {highest} + 1)"
    return f"transform({near}, n -> struct(n AS place, {digit} AS digit))"


def _sum_places(total: str) -> str:
    return f"transform({total}.places, (digit, n) -> struct(n AS place, digit AS digit))"


def _numbered(large: str, places: str, number: int) -> str:
    """(amount, place, digit) of an amount that is large, an empty array for others."""
    rows = (
        f"transform(filter({places}, p -> p.digit <> 0),"
        f" p -> struct({number} AS amount, p.place AS place, p.digit AS digit))"
    )
    return f"if({large}, {rows}, array())"


def _dense(number: int) -> str:
    """The sums of all places of one amount, lowest first; NULL if it has none."""
    own = f"filter(_larges, l -> l.amount = {number})"
    digit = "get(transform(filter(own, l -> l.place = n), l -> l._digit), 0)"
    places = f"transform(sequence(0, {_PLACES - 1}), n -> coalesce({digit}, 0L))"
    return _let("own", own, f"if(size(own) > 0, {places}, NULL)")


def _let(name: str, value: str, body: str) -> str:
    """The body's value with the name standing for the value, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _small_amount(total: str) -> str:
    """The total, where there are no large amounts, as an exact decimal."""
    high, middle, low = (f"CAST({total}.{field} AS decimal(19,0))" for field in _FIELDS)
    units = f"{high} * {4**_PART}BD + {middle} * {2**_PART}BD + {low}"
    return f"(CAST({units} AS decimal(30,0)) * {_UNIT})"


def _fine(amount: str, digits: int | None) -> str:
    return f"CAST({amount if digits is None else f'round({amount}, {digits})'} AS double)"


def _settled(total: str) -> str:
    """The total's units: digits of 30 bits, lowest first, the highest one's number, and the sign.

    (digits, top, below); top is -1 for zero.  What is below zero leaves a carry of -1 and
    digits that count up from there, so it is settled once more with its sign turned.
    """
    turned = f"({_carried('transform(u, d -> -d)')}).digits"
    signed = f"struct(if(c.carry < 0, {turned}, c.digits) AS digits, c.carry < 0 AS below)"
    top = "array_max(transform(s.digits, (d, n) -> if(d <> 0, n, -1)))"
    found = _let("u", _units(total), _let("c", _carried("u"), signed))
    return _let("s", found, f"struct(s.digits AS digits, {top} AS top, s.below AS below)")


def _units(total: str) -> str:
    """The total's units as sums by place, not carried yet."""
    high, middle, low = (f"coalesce({total}.{field}, 0L)" for field in _FIELDS)
    added = (
        f"{low} + shiftleft({middle} & {2**9 - 1}L, 21)",
        f"shiftright({middle}, 9) + shiftleft({high} & {2**18 - 1}L, 12)",
        f"shiftright({high}, 18)",
    )
    places = "concat(e.digits, array(e.carry, 0L, 0L))"
    sums = (
        f"zip_with({places}, array({', '.join(added)}),"
        f" (place, part) -> place * {_EIGHTH} + coalesce(part, 0L))"
    )
    return _let("e", _carried(f"{total}.places"), sums)


def _carried(places: str) -> str:
    """Places with any sums as (digits of 30 bits, carry); the carry is 0 or, below zero, -1."""
    here = "(done.carry + place)"
    return (
        f"aggregate({places}, struct(0L AS carry, CAST(array() AS array<bigint>) AS digits),"
        f" (done, place) -> struct(shiftright({here}, {_PLACE}) AS carry,"
        f" concat(done.digits, array({here} & {2**_PLACE - 1}L)) AS digits))"
    )


def _joined(settled: str, lowest: str) -> str:
    """Three places from ``lowest`` on as one whole decimal, with the sign."""
    places = [
        f"CAST(get({settled}.digits, {lowest} + {n}) AS decimal(10,0)) * {2 ** (_PLACE * n)}BD"
        for n in range(_NARROW)
    ]
    whole = f"CAST({' + '.join(places)} AS decimal(30,0))"
    return f"if({settled}.below, -{whole}, {whole})"


def _large_amount(settled: str, digits: int | None) -> str:
    """The total, rounded to decimals where it is narrow, else once, to the nearest double."""
    narrow = _fine(f"{_joined(settled, '0')} * {_UNIT}", digits)
    # A wide total is its three highest places, and one bit for all below them.
    lowest = f"({settled}.top - {_NARROW - 1})"
    rest = f"exists(slice({settled}.digits, 1, greatest({lowest}, 0)), d -> d <> 0)"
    sticky = f"if({rest}, if({settled}.below, -1BD, 1BD), 0BD)"
    head = f"CAST({_joined(settled, lowest)} * 2BD + {sticky} AS decimal(30,0))"
    wide = f"CAST({head} * {_UNIT} AS double) * pow(2D, {_PLACE} * {lowest} - 1)"
    return f"if({settled}.top < {_NARROW}, {narrow}, {wide})"
