"""SimHash near-duplicates by anchor-point covering.

A covering code is a set of anchors such that every fingerprint lies within the covering radius
of one. Here the 64 bits are cut into blocks of 23, 23, 15 and 3 bits, each with a perfect code
(two binary Golay codes of radius 3, a Hamming and a repetition code of radius 1), which makes
2^36 anchors of radius 8. Each point has one nearest anchor, found from its syndrome.

Each fingerprint is replicated to every anchor within covering radius plus threshold t: to those
whose blocks lie within their radius of the fingerprint's, but for t bits in all, about 165 for
t = 2. Of two fingerprints that differ in at most t bits, the nearest anchor of one, its home, is
within that distance of the other. So linked fingerprints meet at a home, and are compared there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Scratch, components
from marketloom.operators.joins import heavy_keys, lookup_join

BITS = 64
SEED = 42
WORDS = 3
MAX_DISTANCE = 2
#: Fingerprints of one anchor that one task compares; beyond it they are dealt out by midpoint.
ANCHOR_GROUP = 1000
#: Words of a document that are hashed at a time.
WORDS_AT_ONCE = 1 << 17
#: Points whose nearest anchors are found at a time, and replicas that are compared at a time.
POINTS_AT_ONCE = 1 << 21
COMPARED_AT_ONCE = 1 << 17
#: Fingerprints that a task replicates, about: their number tells the work, their bytes do not.
REPLICATED_BY_TASK = 1 << 13
#: Up to so many fingerprints of an anchor all pairs are looked at, many anchors at a time.
FEW = 8

#: (length, check bits, generator polynomial, radius) of each block's cyclic code. Fixed values.
BLOCKS = (
    (23, 11, 0b101011100011, 3),
    (23, 11, 0b101011100011, 3),
    (15, 4, 0b10011, 1),
    (3, 2, 0b111, 1),
)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 if it has no word."""
    split = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    width = min(words, len(split))
    ends = list(accumulate((len(word) + 1 for word in split), initial=0))
    shingles = len(split) - width + 1
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for first in range(0, shingles, WORDS_AT_ONCE):
        last = min(shingles, first + WORDS_AT_ONCE)
        hashes = np.array(
            [
                hashed(joined[start : end - 1], SEED)
                for start, end in zip(ends[first:last], ends[first + width : last + width])
            ],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > shingles, bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    name: Column | None = None,
) -> DataFrame:
    """(doc_id, fingerprint long[, name]) of each row; the long has the fingerprint's 64 bits.

    `name` is a string that stands for the row.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(text.as_py(), words) for text in batch.column(1)),
                dtype=np.uint64,
                count=batch.num_rows,
            )
            columns = [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]]
            names = ["doc_id", "fingerprint", "name"]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
        *([] if name is None else [name.alias("name")]),
    )
    kind = "doc_id long, fingerprint long" + ("" if name is None else ", name string")
    return narrow.mapInArrow(of, kind)


@cache
def _leaders(length: int, checks: int, generator: int, radius: int) -> np.ndarray:
    """The lightest error of each syndrome; the code is perfect, so it is the only one."""
    leaders = np.zeros(1 << checks, dtype=np.uint64)
    for weight in range(1, radius + 1):
        for places in combinations(range(length), weight):
            error = sum(1 << place for place in places)
            leaders[_remainder(error, checks, generator, length)] = error
    return leaders


def _remainder(word: int, checks: int, generator: int, length: int) -> int:
    for bit in range(length - 1, checks - 1, -1):
        if word >> bit & 1:
            word ^= generator << (bit - checks)
    return word


@cache
def _syndromes(length: int, checks: int, generator: int) -> np.ndarray:
    """The syndrome of each single bit."""
    return np.array(
        [_remainder(1 << bit, checks, generator, length) for bit in range(length)], np.uint16
    )


def _block_anchors(values: np.ndarray, block: tuple, flips: np.ndarray) -> np.ndarray:
    """The nearest code word of each value with each pattern of flips, values by flips."""
    length, checks, generator, radius = block
    single = _syndromes(length, checks, generator)
    syndromes = np.zeros(len(values), dtype=np.uint16)
    flipped = np.zeros(len(flips), dtype=np.uint16)
    for bit in range(length):
        syndromes ^= np.where(values >> np.uint64(bit) & np.uint64(1), single[bit], 0).astype("u2")
        flipped ^= np.where(flips >> np.uint64(bit) & np.uint64(1), single[bit], 0).astype("u2")
    leaders = _leaders(length, checks, generator, radius)
    return values[:, None] ^ flips[None, :] ^ leaders[syndromes[:, None] ^ flipped[None, :]]


def ball(radius: int) -> np.ndarray:
    """All patterns of at most `radius` bits."""
    return np.array(
        [
            sum(1 << place for place in places)
            for weight in range(radius + 1)
            for places in combinations(range(BITS), weight)
        ],
        dtype=np.uint64,
    )


def anchors(values: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for the nearest anchors of all points within `reach` bits of each value.

    As the codes are perfect, these are all anchors within the radius of each block but for
    `reach` bits in all.
    """
    flips = ball(reach)
    found = np.zeros((len(values), len(flips)), dtype=np.uint64)
    low = 0
    for block in BLOCKS:
        mask = np.uint64((1 << block[0]) - 1)
        near = _block_anchors(
            values >> np.uint64(low) & mask, block, flips >> np.uint64(low) & mask
        )
        found |= near << np.uint64(low)
        low += block[0]
    found.sort(axis=1)
    first = np.ones(found.shape, dtype=bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(first)[0], found[first]


def _replicas(classes: DataFrame, reach: int) -> DataFrame:
    """(anchor, fingerprint): each fingerprint at every anchor within radius plus `reach`."""
    at_once = max(1, POINTS_AT_ONCE // len(ball(reach)))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.asarray(batch.column(0)).view(np.uint64)
            for first in range(0, len(whole), at_once):
                values = whole[first : first + at_once]
                rows, found = anchors(values, reach)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(values[rows].view(np.int64))],
                    ["anchor", "fingerprint"],
                )

    return classes.select("fingerprint").mapInArrow(replicate, "anchor long, fingerprint long")


def spanning_links(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (larger, smaller) of at most `distance` bits that join all that such links join."""
    left = np.sort(values)
    links = []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            apart = np.bitwise_count((left[:, None] ^ front[None, :]).view(np.uint64))
            near = apart <= distance
            hit = near.any(axis=1)
            links += zip(left[hit].tolist(), front[near[hit].argmax(axis=1)].tolist())
            front, left = left[hit], left[~hit]
    return links


def _group_links(groups: DataFrame, distance: int) -> DataFrame:
    """Spanning links of each row's `members`, a bounded array of fingerprints."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for members in batch.column(0):
                found += spanning_links(np.asarray(members.values), distance)
            pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"]
            )

    return groups.select("members").mapInArrow(link, "a long, b long")


def anchor_links(
    at: np.ndarray, values: np.ndarray, distance: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (a, b) of fingerprints that meet at a home, and the fingerprints of crowded homes.

    `at` has the anchor of each fingerprint, those of one anchor together. Where none is at home
    nothing is compared.
    """

    def groups() -> tuple[np.ndarray, np.ndarray]:
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])[: len(at)])
        return first, np.diff(np.append(first, len(at)))

    sizes = groups()[1]
    some = np.repeat(sizes > 1, sizes)
    at, values = at[some], values[some]
    first, sizes = groups()
    if not len(first):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    home = anchors(values.view(np.uint64), 0)[1].view(np.int64) == at
    used = np.logical_or.reduceat(home, first)
    first, sizes = first[used], sizes[used]
    a, b = [], []
    for size in range(2, FEW + 1):
        members = values[first[sizes == size][:, None] + np.arange(size)]
        for i, j in combinations(range(size), 2):
            apart = np.bitwise_count((members[:, i] ^ members[:, j]).view(np.uint64))
            a.append(members[apart <= distance, i])
            b.append(members[apart <= distance, j])
    for begin, size in zip(*(x[(sizes > FEW) & (sizes <= ANCHOR_GROUP)] for x in (first, sizes))):
        found = spanning_links(values[begin : begin + size], distance)
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        a.append(pairs[:, 0])
        b.append(pairs[:, 1])
    large = sizes > ANCHOR_GROUP
    crowded = [values[x : x + size] for x, size in zip(first[large], sizes[large])]
    return np.concatenate(a), np.concatenate(b), np.concatenate([values[:0], *crowded])


def _compared(replicas: DataFrame, distance: int) -> DataFrame:
    """(a, b): links found anchor by anchor; b is null where a is one of a crowded anchor."""

    def rows(a: np.ndarray, b: np.ndarray | None = None) -> pa.RecordBatch:
        other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
        return pa.RecordBatch.from_arrays([pa.array(a), other], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int64)
        at, values, crowd = none, none, None
        for batch in _joined(batches):
            at = np.concatenate([at, batch[0]])
            values = np.concatenate([values, batch[1]])
            if crowd is not None:  # an anchor whose fingerprints are already more than one holds
                more = np.searchsorted(at, crowd, side="right")
                yield rows(values[:more])
                at, values = at[more:], values[more:]
            # The last anchor may have more fingerprints to come.
            whole = np.searchsorted(at, at[-1]) if len(at) else 0
            a, b, crowded = anchor_links(at[:whole], values[:whole], distance)
            yield rows(a, b)
            yield rows(crowded)
            at, values = at[whole:], values[whole:]
            if len(at) > ANCHOR_GROUP:
                yield rows(values)
                at, values, crowd = none, none, at[-1]
        a, b, crowded = anchor_links(at, values, distance)
        yield rows(a, b)
        yield rows(crowded)

    dealt = replicas.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(compare, "a long, b long")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of batches, COMPARED_AT_ONCE rows and more at a time."""
    held, rows = [], 0
    for batch in batches:
        held.append([np.asarray(column) for column in batch.columns])
        rows += batch.num_rows
        if rows >= COMPARED_AT_ONCE:
            yield [np.concatenate(column) for column in zip(*held)]
            held, rows = [], 0
    if held:
        yield [np.concatenate(column) for column in zip(*held)]


def links(scratch: Scratch, classes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints; their components are those of all links.

    `classes` is a written table, whose rows are counted from the files' footers. Replicas are
    sorted by anchor, and a task compares those of one anchor after the other. Of an anchor with
    more than ANCHOR_GROUP fingerprints these are dealt to the points within ceil(t / 2) bits of
    each instead, as linked ones have such a point in common; at most a ball's number of
    distinct fingerprints can meet at one.
    """
    if not 0 <= max_distance <= 4:
        raise ValueError("max_distance must be from 0 to 4")
    tasks = max(1, -(-classes.count() // REPLICATED_BY_TASK))
    dealt = classes.select("fingerprint").repartition(tasks, "fingerprint")
    found = scratch.table(_compared(_replicas(dealt, max_distance), max_distance))
    patterns = F.lit([int(x) for x in ball((max_distance + 1) // 2).view(np.int64)])
    midpoints = (
        found.where("b is null")
        .select(F.col("a").alias("fingerprint"))
        .distinct()
        .withColumn("pattern", F.explode(patterns))
        .groupBy(F.col("fingerprint").bitwiseXOR(F.col("pattern")).alias("midpoint"))
        .agg(F.collect_set("fingerprint").alias("members"))
        .where(F.size("members") > 1)
    )
    return found.where("b is not null").union(_group_links(midpoints, max_distance))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    max_distance: int = MAX_DISTANCE,
    name: Column | None = None,
) -> DataFrame:
    """(doc_id, fingerprint, component_id[, name, root]) for each row.

    fingerprint is 16 lowercase hex digits. component_id is the smallest doc_id that links of at
    most `max_distance` bits reach. Texts without a word (null, empty) have fingerprint 0 and
    link like any other. A row without id belongs to its component but never names it; a
    component of only such rows has a null component_id. Repeated rows stay repeated. A bit set
    in just half of the hashes is 0. Very long texts are read whole, some 100,000 shingles at a
    time. Other columns are not read. An empty table gives an empty result.

    With `name`, a string column that stands for a row, that and `root` come too: a long for each
    component, which tells apart those that one doc_id with unlike texts names twice.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.table(fingerprints(docs, id_column, text_column, words, name))
    classes = scratch.table(
        prints.groupBy("fingerprint").agg(
            F.min("doc_id").alias("least"), F.count("*").alias("size")
        )
    )
    roots = components(scratch, links(scratch, classes, max_distance))
    linked = scratch.table(
        classes.join(
            roots.select(F.col("node").alias("fingerprint"), "root"), "fingerprint", "left"
        ).select("fingerprint", "size", "least", F.coalesce("root", "fingerprint").alias("root"))
    )
    named = linked.groupBy("root").agg(
        F.min("least").alias("component_id"), F.sum("size").alias("total")
    )
    # Only fingerprints that share their component with another row need a lookup.
    several = named.where("total > 1").drop("total")
    shared = lookup_join(
        linked, several, "root", "inner", heavy_keys(linked, "root"), ["fingerprint"]
    ).select("fingerprint", "component_id", "root", F.lit(True).alias("shared"))
    root = F.coalesce("root", "fingerprint").alias("root")
    heavy = heavy_keys(prints, "fingerprint")
    return lookup_join(prints, shared, "fingerprint", "left", heavy, ["doc_id"]).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("doc_id")).alias(
            "component_id"
        ),
        *([] if name is None else ["name", root]),
    )
