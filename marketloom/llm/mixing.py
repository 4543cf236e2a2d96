"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

A budget of tokens flows from the root of a domain, language, source tree to its leaves. At each
node it is shared among the children by weight. A child that has fewer tokens than its share (its
capacity: its tokens times the epochs allowed) takes what it has; what it lacks goes to its
siblings, and only a node all of whose children are full leaves anything to its own siblings.
A leaf then takes whole epochs over its documents and a token-prefix of one more, each epoch in
an order of its own that follows from the seed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import Scratch, table_join

LEVELS = ("domain", "lang", "source")
SEED = 17
MAX_EPOCHS = 4
#: Hexadecimal digits of the order that make up a share of a leaf: 16^3 shares.
SHARE_DIGITS = 3
#: Name of a node whose value is null.
MISSING = "(none)"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column | str) -> Column:
    """Number of runs of characters other than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    """The weight of the node named in the column `level`; 1 for one without a weight."""
    found = F.lit(1)
    for name, weight in weights.items():
        found = F.when(F.col(level) == name, F.lit(weight)).otherwise(found)
    return found.cast("decimal(10,0)")


def _share_out(nodes: DataFrame, parents: Sequence[str]) -> DataFrame:
    """Add `grant` to siblings with `capacity` and `weight` whose parent has `budget`.

    In order of capacity per weight, a node is full if it has no more than its share of what the
    nodes before it left over. The others share the rest by weight, rounded down.
    """
    siblings = Window.partitionBy(*[F.col(p) for p in parents])
    per_weight = F.col("capacity").cast("double") / F.col("weight").cast("double")
    order = siblings.orderBy(per_weight, "name")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    nothing = F.lit(0).cast("decimal(20,0)")
    return (
        nodes.withColumn(
            "_left", F.col("budget") - F.coalesce(F.sum("capacity").over(before), nothing)
        )
        .withColumn("_weights", F.sum("weight").over(after))
        .withColumn("_full", F.expr("capacity * _weights <= _left * weight"))
        .withColumn(
            "_rest",
            F.col("budget")
            - F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(siblings), nothing),
        )
        .withColumn("_open", F.sum(F.when(~F.col("_full"), F.col("weight"))).over(siblings))
        .withColumn(
            "grant",
            F.expr("if(_full, capacity, cast(_rest * weight div _open as decimal(20,0)))"),
        )
        .drop("_left", "_weights", "_full", "_rest", "_open")
    )


def budgets(
    leaves: DataFrame,
    weights: Mapping[str, Mapping[str, int]],
    budget_percent: int,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Leaves (domain, lang, source, tokens) with `epochs`, whole ones, and `prefix`, in tokens.

    The budget is `budget_percent` of all tokens. Weights are positive whole numbers by level
    and name. One row per leaf with a token; the tree is what grows, not the documents. The leaves
    are read twice, once for the sum of all tokens: they are a written table where that matters.
    """
    level = leaves.where("tokens > 0").select(
        *LEVELS, (F.col("tokens") * max_epochs).cast("decimal(20,0)").alias("capacity"), "tokens"
    )
    budget = f"cast(cast(sum(tokens) as decimal(20,0)) * {budget_percent} div 100 as decimal(20,0))"
    tree = level.withColumn("budget", level.agg(F.expr(budget)).scalar())
    for depth, name in enumerate(LEVELS):
        above, here = LEVELS[:depth], LEVELS[: depth + 1]
        nodes = tree.groupBy(*here).agg(
            F.sum("capacity").cast("decimal(20,0)").alias("capacity"),
            F.first("budget").alias("budget"),
        )
        nodes = nodes.withColumn("name", F.col(name)).withColumn(
            "weight", _weight(name, weights.get(name, {}))
        )
        granted = _share_out(nodes, above).select(*here, F.col("grant").alias("budget"))
        tree = tree.drop("budget").join(granted, list(here))
    return tree.select(
        *LEVELS,
        F.expr("cast(budget div tokens as int)").alias("epochs"),
        F.expr("cast(budget % tokens as long)").alias("prefix"),
    )


def _order(doc_id: str, epoch: Column, seed: int) -> Column:
    """Where a document stands in an epoch: hexadecimal digits."""
    return F.md5(
        F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col(doc_id).cast("string"))
    )


def select(
    rows: DataFrame, plan: DataFrame, scratch: Scratch, seed: int = SEED
) -> DataFrame:
    """Rows with `copies`, how often the mix has them; rows it leaves out are dropped.

    `plan` is a written table.

    `rows` has doc_id, domain, lang, source and n_tokens, and any others. The prefix ends before
    the first document that would pass it. A leaf is never sorted as a whole: shares of it, by
    the leading digits of the order, are summed, and only the share in which the prefix ends is
    gone through row by row. Documents with one doc_id follow each other by n_tokens.
    """
    budgeted = table_join(rows, plan, list(LEVELS), ["doc_id"])
    ordered = budgeted.withColumn("_order", _order("doc_id", F.col("epochs") + 1, seed)).withColumn(
        "_share", F.substring("_order", 1, SHARE_DIGITS)
    )
    by_share = Window.partitionBy(*LEVELS).orderBy("_share")
    shares = scratch.table(
        ordered.groupBy(*LEVELS, "_share")
        .agg(F.sum("n_tokens").alias("_tokens"))
        .withColumn("_end", F.sum("_tokens").over(by_share))
        .select(*LEVELS, "_share", "_end", (F.col("_end") - F.col("_tokens")).alias("_start"))
    )
    placed = ordered.join(shares, [*LEVELS, "_share"])
    inside, cut = F.col("_end") <= F.col("prefix"), F.col("_start") <= F.col("prefix")
    along = (
        Window.partitionBy(*LEVELS)
        .orderBy("_order", "doc_id", "n_tokens")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    clear = placed.where(inside | ~cut).withColumn("_in", inside)
    last = placed.where(~inside & cut).withColumn(
        "_in", F.col("_start") + F.sum("n_tokens").over(along) <= F.col("prefix")
    )
    return (
        clear.unionByName(last)
        .withColumn("copies", F.col("epochs") + F.col("_in").cast("int"))
        .where("copies > 0")
        .select(*rows.columns, "copies")
    )


def leaves_of(rows: DataFrame) -> DataFrame:
    """Tokens by leaf."""
    return rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))


def described(docs: DataFrame, domain: Column, tokens: Column, keep: bool = False) -> DataFrame:
    """doc_id, the leaf and n_tokens of each document, and all of it in `row` if `keep`."""
    columns = [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(domain, F.lit(MISSING)).alias("domain"),
        F.coalesce("lang", F.lit(MISSING)).alias("lang"),
        F.coalesce("source", F.lit(MISSING)).alias("source"),
        tokens.alias("n_tokens"),
    ]
    if keep:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return docs.select(*columns)


def mix(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    budget_percent: int,
    tokens: Column | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    keep: bool = False,
) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, copies[, row]): the documents of the mix.

    `tokens` is the number of tokens, words unless given. A null domain, language or source is a
    node named (none); a null doc_id is a document like any other. Texts without a token (null,
    empty) are in a leaf's epoch if they stand before the end of its prefix; a leaf without any
    token gives nothing. Repeated rows are counted and chosen each by itself. An empty table
    gives an empty result. Other columns are neither read nor in the way, and come back in the
    struct `row` with `keep`.

    Texts of any length count whole. Documents of a leaf that tie in its seeded order are taken
    by doc_id and number of tokens; rows equal in those are interchangeable.
    """
    counted = words("text") if tokens is None else tokens
    scratch = Scratch(docs.sparkSession)
    narrow = scratch.table(described(docs, domain, counted))
    leaves = scratch.table(leaves_of(narrow))
    plan = scratch.table(budgets(leaves, weights, budget_percent, max_epochs))
    rows = described(docs, domain, counted, keep) if keep else narrow
    return select(rows, plan, scratch, seed)
