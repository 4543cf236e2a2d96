"""Secret scans, in DataFrame functions only.

Patterns find assigned, access and hexadecimal secrets. Besides, strings that consist of a
character class are searched by sliding-window Shannon entropy: a window moves along the string
one character at a time, and the entropy follows from the counts of the character that comes in
and the one that goes out. Runs of windows above the class's threshold are spans, unless the
string is on the allow-list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns. Fixed values.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

WINDOW = 20
#: Entropies are sums of whole millionths of a bit, so that every engine gets the same.
UNIT = 1_000_000
#: Matches whose positions are added up at a time.
BLOCK = 256
MARK = "[SECRET]"


class CharClass(NamedTuple):
    """A kind of string to search by entropy: its characters and the least entropy in bits."""

    kind: str
    characters: str
    pattern: str
    bits: float


CLASSES = (
    CharClass("entropy_hex", "0123456789abcdef", r"[0-9a-f]{20,}", 3.0),
    CharClass(
        "entropy_base64",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        r"[A-Za-z0-9+/_=-]{20,}",
        3.8,
    ),
    # Keys of one case, whose alphabets are too small for the threshold of base64.
    CharClass("entropy_upper_hex", "0123456789ABCDEF", r"[0-9A-F]{20,}", 3.0),
    CharClass(
        "entropy_upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", r"[A-Z0-9]{20,}", 3.4
    ),
    CharClass(
        "entropy_lower", "abcdefghijklmnopqrstuvwxyz0123456789", r"[a-z0-9]{20,}", 3.4
    ),
)
BASE_KINDS = ("assign", "access", "hex")

#: Strings that are no secrets however mixed they look: numbers, UUIDs, words and slugs, examples.
#: Repeated groups are possessive, as Java goes through others by recursion.
ALLOWED = (
    r"^[0-9]+$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^(?:[-_/+=]*+(?:[A-Z]?[a-z]++|[A-Z]++|[0-9]++)(?=[-_/+=]|$))++[-_/+=]*$",
    r"(?i)example|dummy|placeholder|sample",
)


def bits_of_counts(window: int = WINDOW) -> list[int]:
    """c log2 c in units, for counts from 0 to the window's size."""
    return [0, *(round(UNIT * c * math.log2(c)) for c in range(1, window + 1))]


def most_units(bits: float, window: int = WINDOW) -> int:
    """A window has at least `bits` of entropy if its c log2 c sum to no more than this."""
    return round(UNIT * window * (math.log2(window) - bits))


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, found) of the leftmost non-overlapping matches, in code points.

    The text between matches gives the positions. They are added up in blocks, since an array
    grows by copying.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    whole = F.struct(between.alias("between"), found.alias("found"), F.size(found).alias("n"))

    def locate(all_: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(all_["between"][i])
            match = all_["found"][i]
            end = start + F.length(match)
            one = F.struct(start.alias("start"), end.alias("end"), match.alias("found"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        def block(acc: Column, first: Column) -> Column:
            last = F.least(first + F.lit(BLOCK), all_["n"]) - F.lit(1)
            start = F.struct(acc["at"].alias("at"), empty.alias("out"))
            inner = F.aggregate(F.sequence(first, last), start, step)
            return F.struct(
                inner["at"].alias("at"), F.concat(acc["out"], inner["out"]).alias("out")
            )

        firsts = F.sequence(F.lit(0), all_["n"] - F.lit(1), F.lit(BLOCK))
        start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        return F.aggregate(firsts, start, block, lambda acc: acc["out"])

    located = F.transform(F.array(whole), locate)[0]
    return F.when(F.regexp_like(text, F.lit(pattern)), located).otherwise(empty)


def _spans(kind: int, matches: Column) -> Column:
    """The matches as (start, kind, end), which sorts by start, then kind."""
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")
        ),
    )


def base_spans(text: Column) -> Column:
    """Spans of the base patterns, unsorted; matches that are too short are dropped."""
    value = lambda m: F.regexp_extract(m["found"], ASSIGN, 1)
    assign = F.filter(_matches(text, ASSIGN), lambda m: F.length(value(m)) >= ASSIGN_LEAST)
    # Runs of one class: whole runs of the least length are what its matches of that length are.
    access = F.filter(
        _matches(text, ACCESS), lambda m: m["end"] - m["start"] >= ACCESS_LEAST
    )
    hexadecimal = _matches(text, HEX.replace("+", "{%d,}" % HEX_LEAST))
    return F.concat(_spans(0, assign), _spans(1, access), _spans(2, hexadecimal))


def _entropy_runs(found: Column, chars: CharClass, window: int = WINDOW) -> Column:
    """(start, end) within a string of the class: unions of windows above the threshold."""
    bits = F.lit(bits_of_counts(window)).cast("array<long>")
    empty = F.array().cast("array<struct<start:int,end:int>>")
    codes = F.transform(
        F.regexp_extract_all(found, F.lit("."), F.lit(0)),
        lambda c: F.instr(F.lit(chars.characters), c) - F.lit(1),
    )

    def runs(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            come = codes[i]
            gone = F.when(i >= window, codes[i - window]).otherwise(F.lit(-1))
            less = F.when(gone >= 0, acc["counts"][F.greatest(gone, F.lit(0))]).otherwise(0)
            # The character that goes may be the one that comes.
            more = acc["counts"][come] - (gone == come).cast("int")
            units = (
                acc["units"]
                - bits[less]
                + bits[F.greatest(less - 1, F.lit(0))]
                - bits[more]
                + bits[more + 1]
            )
            counts = F.transform(
                acc["counts"],
                lambda n, c: n + (c == come).cast("int") - (c == gone).cast("int"),
            )
            high = (i >= window - 1) & (units <= most_units(chars.bits, window))
            start, end = i - F.lit(window - 1), i + F.lit(1)
            joins = high & (acc["end"] >= start)
            close = high & ~joins & (acc["end"] > 0)
            one = F.struct(acc["start"].alias("start"), acc["end"].alias("end"))
            return F.struct(
                counts.alias("counts"),
                units.alias("units"),
                F.when(high & ~joins, start).otherwise(acc["start"]).alias("start"),
                F.when(high, end).otherwise(acc["end"]).alias("end"),
                F.when(close, F.concat(acc["out"], F.array(one)))
                .otherwise(acc["out"])
                .alias("out"),
            )

        state = F.struct(
            F.array_repeat(F.lit(0), len(chars.characters)).alias("counts"),
            F.lit(0).cast("long").alias("units"),
            F.lit(0).alias("start"),
            F.lit(0).alias("end"),
            empty.alias("out"),
        )
        last = lambda acc: F.when(
            acc["end"] > 0,
            F.concat(
                acc["out"],
                F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))),
            ),
        ).otherwise(acc["out"])
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), state, step, last)

    return F.transform(F.array(codes), runs)[0]


def entropy_spans(
    text: Column, kind: int, chars: CharClass, allowed: Sequence[str] = ALLOWED
) -> Column:
    """Spans of one character class."""

    def suspicious(m: Column) -> Column:
        fine = F.lit(False)
        for pattern in allowed:
            fine = fine | F.regexp_like(m["found"], F.lit(pattern))
        return ~fine

    def located(m: Column) -> Column:
        return F.transform(
            _entropy_runs(m["found"], chars),
            lambda run: F.struct(
                (m["start"] + run["start"]).alias("start"),
                F.lit(kind).alias("kind"),
                (m["start"] + run["end"]).alias("end"),
            ),
        )

    candidates = F.filter(_matches(text, chars.pattern), suspicious)
    return F.flatten(F.transform(candidates, located))


def _listed(spans: Column, kinds: Sequence[str]) -> Column:
    names = F.lit(list(kinds))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])
        ),
        ",",
    )


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    classes: Sequence[CharClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
    keep: bool = False,
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, found[, row]) for each row.

    spans lists kind:start:end by start, then kind, end exclusive, in code points; base_sha256
    is the hash of that list of the base kinds. found is the same as structs, `row` with `keep`
    all columns of the row. Null and empty texts have no spans. Null ids and repeated rows are
    scanned like any other row. Other columns are neither read nor in the way. An empty table
    gives an empty result.

    Very long texts and candidates are scanned whole. A window with just the threshold's entropy
    counts. Spans that start together are listed in the order of the kinds.
    """
    kinds = [*BASE_KINDS, *(c.kind for c in classes)]
    text = F.coalesce(F.col(text_column), F.lit(""))
    added = [
        entropy_spans(text, len(BASE_KINDS) + i, c, allowed) for i, c in enumerate(classes)
    ]
    columns = [
        F.col(id_column).cast("long").alias("doc_id"),
        F.array_sort(base_spans(text)).alias("base"),
        F.array_sort(F.concat(*added)).alias("added") if added else F.array().alias("added"),
    ]
    if keep:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = docs.select(*columns)

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    every = F.array_sort(F.concat("base", "added"))
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(_listed(F.col("base"), kinds), 256).alias("base_sha256"),
        _listed(every, kinds).alias("spans"),
        every.alias("found"),
        *(["row"] if keep else []),
    )


def redacted(text: Column, found: Column, mark: str = MARK) -> Column:
    """The text with each stretch that spans cover replaced by the mark; null stays null."""
    parts = F.array().cast("array<string>")

    def step(acc: Column, s: Column) -> Column:
        clear = s["start"] > acc["at"]
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        first = acc["at"] == 0
        new = F.when(clear | first & (F.size(acc["out"]) == 0), F.array(before, F.lit(mark)))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.concat(acc["out"], F.coalesce(new, parts)).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), parts.alias("out"))
    rest = lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))
    )
    return F.when(F.size(found) > 0, F.aggregate(found, start, step, rest)).otherwise(text)
