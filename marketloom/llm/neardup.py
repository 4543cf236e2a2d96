"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are turned into their principal axes, the one with the most variance first. Vectors of
one label whose cosine reaches the threshold are no farther apart than `reach` on any axis, so
the label is cut into cells of that width along the first two axes, and only neighbouring cells
are compared, tile by tile. In a tile the leading dimensions are multiplied first. What the rest
can add is bounded by the product of the two suffix norms; a pair stops as soon as its cosine
cannot reach the threshold. What is left over is compared on the vectors as given.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm import vectors
from marketloom.llm.common import Scratch, components, extended, salted_join

THRESHOLD = 0.98
#: Rows of a tile's side, at most about this many.
TILE = 2048
#: A tile is compared so many rows, then so many pairs at a time.
ROWS_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 16
#: Dimensions accumulated before the first test; each later step doubles them.
LEADING = 8
#: Room for rounding in the bounds. The final test has none.
SLACK = 1e-9

KEY = ["label", "rep", "hash"]


def principal_axes(total: np.ndarray) -> np.ndarray:
    """Columns are the axes of a matrix of second moments, the strongest first."""
    _, axes = np.linalg.eigh(total)
    return axes[:, ::-1]


def linked_pairs(
    left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows whose cosine is at least the threshold; of one tile each pair once."""
    units = vectors.unit(left), vectors.unit(right)
    turned = units[0] @ axes, units[1] @ axes
    steps = [0]
    while steps[-1] < len(axes):
        steps.append(min(len(axes), max(LEADING, 2 * steps[-1])))
    suffix = [
        [np.sqrt((side[:, step:] ** 2).sum(axis=1)) for step in steps[1:]] for side in turned
    ]
    low = threshold - SLACK
    for first in range(0, len(left), ROWS_AT_ONCE):
        part = slice(first, first + ROWS_AT_ONCE)
        products = turned[0][part, : steps[1]] @ turned[1][:, : steps[1]].T
        bound = products + np.outer(suffix[0][0][part], suffix[1][0])
        rows, columns = np.nonzero(bound >= low)
        if same:
            upper = rows + first < columns
            rows, columns = rows[upper], columns[upper]
        sums = products[rows, columns]
        rows = rows + first
        for at in range(0, len(rows), PAIRS_AT_ONCE):
            i, j = rows[at : at + PAIRS_AT_ONCE], columns[at : at + PAIRS_AT_ONCE]
            total = sums[at : at + PAIRS_AT_ONCE]
            for step, (begin, end) in enumerate(zip(steps[1:], steps[2:]), start=1):
                more = np.einsum("ij,ij->i", turned[0][i, begin:end], turned[1][j, begin:end])
                total = total + more
                alive = total + suffix[0][step][i] * suffix[1][step][j] >= low
                i, j, total = i[alive], j[alive], total[alive]
            exact = _cosine(left[i], right[j]) >= threshold
            yield i[exact], j[exact]


def _cosine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    left = left / np.abs(left).max(axis=1, keepdims=True)
    right = right / np.abs(right).max(axis=1, keepdims=True)
    return vectors.dot(left, right) / np.sqrt(
        vectors.dot(left, left) * vectors.dot(right, right)
    )


def merged(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row reachable by the links so far and those of i and j."""
    while True:
        least = np.minimum(roots[i], roots[j])
        before = roots.copy()
        np.minimum.at(roots, before[i], least)
        np.minimum.at(roots, before[j], least)
        while (roots[roots] != roots).any():
            roots = roots[roots]
        if (roots == before).all():
            return roots


def _compare(table: pa.Table, axes: np.ndarray, threshold: float) -> pa.Table:
    """Links of one tile: per row with any, how many and the smallest rep reached in the tile."""
    table = table.sort_by([("rep", "ascending"), ("hash", "ascending")])
    side = table.column("side").to_numpy()
    size = table.column("size").to_numpy()
    whole = vectors.matrix(table.column("embedding"), len(axes))
    left = np.nonzero(side == 0)[0]
    right = np.nonzero(side == 1)[0]
    same = not len(right) and bool(table.column("same")[0].as_py())
    if same:
        right = left
    links = np.zeros(len(side), dtype=np.int64)
    roots = np.arange(len(side))
    if len(left) and len(right):
        for i, j in linked_pairs(whole[left], whole[right], axes, threshold, same):
            i, j = left[i], right[j]
            np.add.at(links, i, size[j])
            np.add.at(links, j, size[i])
            if len(i):
                roots = merged(roots, i, j)
    hit = links > 0
    rep = table.column("rep").to_numpy()
    return pa.table(
        {
            "label": table.column("label").filter(pa.array(hit)),
            "rep": rep[hit],
            "hash": table.column("hash").to_numpy()[hit],
            "links": links[hit],
            "root": rep[roots[hit]],
        }
    )


def _cells(classes: DataFrame, axes: np.ndarray, reach: float) -> DataFrame:
    """Classes with x and y, their cell along the first two axes."""
    lead = axes[:, :2]
    names = classes.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = vectors.unit(vectors.matrix(batch.column("embedding"), len(axes))) @ lead
                cell = np.floor(at / (reach + SLACK)).astype(np.int32)
                x, y = cell[:, 0], cell[:, 1] if cell.shape[1] > 1 else np.zeros_like(cell[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(x), pa.array(y)], [*names, "x", "y"]
                )

    return classes.mapInArrow(place, extended(classes.schema, "x int, y int"))


def _tiles(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes with their block of a cell, and the pairs of blocks to compare."""
    cell = ["label", "x", "y"]
    blocks = placed.groupBy(*cell).agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    blocked = salted_join(placed, blocks, cell, ["rep", "hash"]).withColumn(
        "block", F.pmod(F.xxhash64("hash", "rep", F.lit(1)), F.col("blocks")).cast("int")
    )
    each = blocks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    one = each.select("label", "x", "y", "block")
    around = F.lit([-1, 0, 1])
    other = (
        one.withColumn("dx", F.explode(around))
        .withColumn("dy", F.explode(around))
        .select(
            "label",
            (F.col("x") + F.col("dx")).alias("x"),
            (F.col("y") + F.col("dy")).alias("y"),
            F.struct("x", "y", "block").alias("b"),
        )
    )
    pairs = (
        one.join(other, cell)
        .select("label", F.struct("x", "y", "block").alias("a"), "b")
        .where("a <= b")
    )
    return blocked, pairs


def links(scratch: Scratch, classes: DataFrame, threshold: float) -> DataFrame:
    """(label, rep, hash, links, root): what each tile found for each class, in a table."""
    size = vectors.width(classes, "embedding")
    total = vectors.summed(
        classes,
        "embedding",
        size,
        lambda rows: (u := vectors.unit(rows)).T @ u,
        (size, size),
    )
    axes = principal_axes(total)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    blocked, pairs = _tiles(scratch.table(_cells(classes, axes, reach)))
    pairs = scratch.table(pairs.withColumn("tile", F.struct("label", "a", "b")))
    own = blocked.select(*KEY, "size", "embedding", F.struct("x", "y", "block").alias("at"))
    sides = [
        own.join(
            pairs.where("a <> b" if side else "true").select(
                "label",
                F.col(end).alias("at"),
                "tile",
                (F.col("a") == F.col("b")).alias("same"),
                F.lit(side).alias("side"),
            ),
            ["label", "at"],
        )
        for side, end in enumerate("ab")
    ]
    kind = classes.schema["label"].dataType.simpleString()
    found = (
        sides[0]
        .union(sides[1])
        .groupBy("tile")
        .applyInArrow(
            lambda table: _compare(table, axes, threshold),
            f"label {kind}, rep long, hash long, links long, root long",
        )
    )
    return scratch.table(found)


def near_duplicates(
    embeddings: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Rows with equal non-null labels link if their cosine, in double precision, is at least
    `threshold`, which is above zero. n_links counts the other rows linked directly;
    component_id is the smallest vec_id that links reach; kept says whether that is the row
    itself. Null, zero and partly null or non-finite vectors and null labels link with nothing.
    Shorter vectors are filled up with zeros. Repeated rows are vectors of their own that link
    like copies; rows with one vec_id are in one component. A row without vec_id links with
    nothing, and its component_id is null and kept false. Other columns are not read. An empty
    table gives an empty result.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0, and at most 1")
    scratch = Scratch(embeddings.sparkSession)
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).alias("embedding"),
        F.col(label_column).alias("label"),
    )
    valid = rows.where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & vectors.usable(F.col("embedding"))
    )
    classes = scratch.table(
        valid.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"))
        .withColumn("hash", F.xxhash64("embedding"))
    )
    if classes.isEmpty():
        return rows.select("vec_id", *_alone())
    found = links(scratch, classes, threshold)
    roots = components(scratch, found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy(*KEY).agg(F.sum("links").alias("links"))
    told = (
        classes.join(linked, KEY, "left")
        .where("size > 1 or links > 0")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    taking_part = F.col("vec_id").isNotNull() & vectors.usable(F.col("embedding"))
    keyed = rows.withColumn("label", F.when(taking_part, F.col("label")))
    joined = salted_join(keyed, told, ["label", "embedding"], ["vec_id"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _alone() -> list:
    return [
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.col("vec_id").isNotNull().alias("kept"),
    ]
