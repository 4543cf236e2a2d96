"""Removing repeated substrings of many documents by column-wise suffix sorting.

Every byte covered by a string of `LENGTH` bytes that also starts anywhere else goes. The strings
are found by sorting suffixes column by column [Bauer, Cox and Rosone 2013; Cox et al. 2016]: each
round puts one more symbol in front of one suffix of every text, stably sorts the suffixes by it,
and brings the longest common prefixes of neighbours up to date with range minima. The symbols in
the order of the suffixes are the collection's Burrows-Wheeler transform of that column. Where a
neighbour shares LENGTH symbols, the string there is repeated.

Whole documents would take as many rounds as the longest has bytes, over all that the rounds
before have built. So what is sorted is cut down without losing a match. Each string of LENGTH
bytes contains an anchor: its `SEED_LENGTH` bytes of smallest hash, the leftmost of equals. Equal
strings have equal anchors in equal places, so strings are only compared around equal anchors,
and all of a context, from the first string with the anchor to the last, is sorted in a fixed
number of rounds. Contexts that are equal as a whole are counted, not sorted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Scratch, extended, salted_join, table_join

LENGTH = 400
SEED_LENGTH = 64  # a power of two
#: Distinct contexts of one anchor that a task sorts; beyond it their strings are counted.
GROUP = 50_000
#: Contexts that a task sorts together, and bytes in which it looks for anchors at a time.
SORTED_AT_ONCE = 12_000
BYTES_AT_ONCE = 1 << 18

#: How texts are packed for a shuffle.
CODEC, CODEC_LEVEL = "zstd", 1

_PLACE_BITS = 20
_MULTIPLIER = 0x9E3779B97F4A7C15
END_SYMBOL = 256

KEYS = ["id0", "hash"]  # what identifies a text: its doc_id, null as the least long, and its hash
SPANS = "id0 long, hash long, start long, end long"


class Width(NamedTuple):
    """Bytes of the strings, and of what stands before and behind an anchor's first byte."""

    length: int
    before: int

    @classmethod
    def of(cls, length: int) -> Width:
        if length < SEED_LENGTH:
            raise ValueError(f"length must be at least {SEED_LENGTH}")
        return cls(length, length - SEED_LENGTH)

    def around(self, place: int, size: int) -> tuple[int, int]:
        return max(0, place - self.before), min(size, place + self.length)


def _seed_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the SEED_LENGTH bytes from each byte on; a few at the end are no whole ones."""
    table = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)
    hashes, width, power = table[data], 1, _MULTIPLIER
    while width < SEED_LENGTH:
        ahead = np.zeros_like(hashes)
        ahead[:-width] = hashes[width:]
        hashes = hashes * np.uint64(power) + ahead
        width, power = 2 * width, power * power % (1 << 64)
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def _sliding_least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each `window` values; shorter than `values` by window - 1."""
    width = 1
    while 2 * width <= window:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = window - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _anchors_of(data: np.ndarray, ends: np.ndarray, width: Width) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors in texts laid end to end, and their hashes."""
    hashes = _seed_hashes(data)
    places = np.arange(len(data), dtype=np.uint64)
    keys = hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS) | places
    least = _sliding_least(keys, width.before + 1)
    begins = np.concatenate([[0], ends[:-1]])
    until = np.repeat(ends, ends - begins)[: len(least)]
    inside = np.arange(len(least)) + width.length <= until
    found = (least[inside] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    found = found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found
    return found, hashes[found]


def anchors(data: bytes, width: Width) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of one text's anchors; a long text is gone through in stretches."""
    places, hashes = [], []
    for first in range(0, max(1, len(data) - width.length + 1), BYTES_AT_ONCE):
        part = np.frombuffer(data[first : first + BYTES_AT_ONCE + width.length - 1], np.uint8)
        if len(part) >= width.length:
            found, hashed = _anchors_of(part, np.array([len(part)]), width)
            places.append(found + first)
            hashes.append(hashed)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    all_places, first_of = np.unique(np.concatenate(places), return_index=True)
    return all_places, np.concatenate(hashes)[first_of]


def _batches_of_texts(batch: pa.RecordBatch, least: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts of at least `least` bytes and their rows, about BYTES_AT_ONCE at a time."""
    rows, texts, held = [], [], 0
    for row, text in enumerate(batch.column(2)):
        data = text.as_py() or b""
        if len(data) < least:
            continue
        if rows and held + len(data) > BYTES_AT_ONCE:
            yield rows, texts
            rows, texts, held = [], [], 0
        rows.append(row)
        texts.append(data)
        held += len(data)
    if rows:
        yield rows, texts


def _all_anchors(docs: DataFrame, width: Width) -> DataFrame:
    """(id0, hash, place, anchor, context): every anchor, with a hash of its context."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in _batches_of_texts(batch, width.length):
                sizes = np.array([len(text) for text in texts])
                ends = np.cumsum(sizes)
                joined = b"".join(texts)
                if len(texts) == 1:
                    places, hashes = anchors(joined, width)
                else:
                    places, hashes = _anchors_of(np.frombuffer(joined, np.uint8), ends, width)
                owner = np.searchsorted(ends, places, side="right")
                begin = (ends - sizes)[owner]
                left = np.maximum(begin, places - width.before)
                right = np.minimum(ends[owner], places + width.length)
                view, hashed = memoryview(joined), xxhash.xxh64_intdigest
                # The seed is where the anchor stands, as equal contexts agree in that too.
                contexts = np.fromiter(
                    (
                        hashed(view[a:b], seed)
                        for a, b, seed in zip(
                            left.tolist(), right.tolist(), (places - left).tolist()
                        )
                    ),
                    dtype=np.uint64,
                    count=len(places),
                )
                of_row = pa.array(np.array(rows)[owner])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(of_row),
                        batch.column(1).take(of_row),
                        pa.array((places - begin).astype(np.int32)),
                        pa.array(hashes.view(np.int64)),
                        pa.array(contexts.view(np.int64)),
                    ],
                    ["id0", "hash", "place", "anchor", "context"],
                )

    columns = docs.select(*KEYS, "data")
    return columns.mapInArrow(find, "id0 long, hash long, place int, anchor long, context long")


def _packed(texts: DataFrame) -> DataFrame:
    """Texts with `packed` and its whole `bytes` in place of data, so that less is shuffled."""
    names = [name for name in texts.columns if name != "data"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(CODEC, compression_level=CODEC_LEVEL)
        for batch in batches:
            data = [text.as_py() for text in batch.column("data")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in names),
                    pa.array([codec.compress(text, asbytes=True) for text in data], pa.binary()),
                    pa.array([len(text) for text in data], pa.int32()),
                ],
                [*names, "packed", "bytes"],
            )

    columns = texts.select(*names, "data")
    return columns.mapInArrow(
        pack, extended(columns.drop("data").schema, "packed binary, bytes int")
    )


def _unpacked(packed: pa.Array, sizes: pa.Array) -> Iterator[bytes]:
    codec = pa.Codec(CODEC)
    for data, size in zip(packed, sizes):
        yield codec.decompress(data.as_py(), size.as_py(), asbytes=True) if size.as_py() else b""


def _contexts(texts: DataFrame, wanted: DataFrame, width: Width) -> DataFrame:
    """Wanted (id0, hash, place, anchor, context, size, crowded) with `left` and `bytes`."""
    names = ("place", "anchor", "context", "size", "crowded")
    per_text = wanted.groupBy(*KEYS).agg(F.collect_list(F.struct(*names)).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _unpacked(batch.column("packed"), batch.column("bytes"))
            for row, data in enumerate(texts):
                asked = batch.column("wanted")[row].values
                count = len(asked)
                places = asked.field("place").to_pylist()
                around = [width.around(place, len(data)) for place in places]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(name)[row].as_py()] * count, pa.int64())
                        for name in KEYS
                    ]
                    + [asked.field(name) for name in names]
                    + [
                        pa.array([p - a for p, (a, _) in zip(places, around)], pa.int32()),
                        pa.array([data[a:b] for a, b in around], pa.binary()),
                    ],
                    [*KEYS, *names, "left", "bytes"],
                )

    return _packed(texts.select(*KEYS, "data")).join(per_text, KEYS).mapInArrow(
        cut,
        "id0 long, hash long, place int, anchor long, context long, size long, crowded boolean, "
        "left int, bytes binary",
    )


def repeated_strings(
    contexts: list[bytes], left: np.ndarray, groups: np.ndarray, width: Width
) -> tuple[np.ndarray, np.ndarray]:
    """For each context the first and last round that ends a repeated string; -1 without any.

    Contexts of a group stand together. Round r of the last `before` + 1 ends the strings that
    begin r bytes before the anchor. Column-wise: `order` has the contexts of each group by
    their suffixes, `common` the common prefix of each with the one before, at most `length`.
    """
    number, rounds = len(contexts), width.before + width.length
    symbols = np.full((rounds, number), END_SYMBOL, dtype=np.uint16)
    for i, data in enumerate(contexts):
        at = width.before - left[i]
        symbols[at : at + len(data), i] = np.frombuffer(data, dtype=np.uint8)
    order = np.arange(number)
    common = np.zeros(number + 1, dtype=np.int32)  # the last one is for range minima only
    first = np.full(number, -1, dtype=np.int32)
    last = np.full(number, -1, dtype=np.int32)
    begins = np.concatenate([[True], groups[1:] != groups[:-1]]) if number else np.zeros(0, bool)
    group_keys = np.cumsum(begins) * 512
    for column in range(rounds - 1, -1, -1):
        # Groups stay where they are, so that a key's group follows from its place.
        keys = group_keys + symbols[column][order]
        same = keys[1:] == keys[:-1]
        if (keys[1:] >= keys[:-1]).all():
            shared = np.where(same & (keys[1:] % 512 != END_SYMBOL), common[1:-1] + 1, 0)
        else:
            come = np.argsort(keys, kind="stable")
            keys = keys[come]
            same = (keys[1:] == keys[:-1]) & (keys[1:] % 512 != END_SYMBOL)
            shared = np.zeros(number - 1, dtype=np.int32)
            at = np.nonzero(same)[0]
            a, b = come[at], come[at + 1]
            near = b == a + 1
            shared[at[near]] = common[b[near]] + 1
            if not near.all():
                bounds = np.stack([a[~near] + 1, b[~near] + 1], axis=1).ravel()
                shared[at[~near]] = np.minimum.reduceat(common, bounds)[::2] + 1
            order = order[come]
        common[1:-1] = np.minimum(shared, width.length)
        if column <= width.before:
            full = np.nonzero(common[1:-1] == width.length)[0]
            if len(full):
                hit = order[np.concatenate([full, full + 1])]
                last[hit] = width.before - column
                hit = hit[first[hit] < 0]
                first[hit] = width.before - column
    return first, last


def _sorted_spans(contexts: DataFrame, width: Width) -> DataFrame:
    """Spans of repeated strings in contexts that occur once, from sorting by anchor."""
    names = ["id0", "hash", "place", "anchor", "context", "size", "left", "bytes"]

    def spans(rows: dict[str, list]) -> pa.RecordBatch:
        anchor, context = np.array(rows["anchor"]), np.array(rows["context"])
        # A repeated row brings its contexts again.
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])
        keep = np.nonzero(new)[0]
        left = np.array(rows["left"])[keep]
        first, last = repeated_strings(
            [rows["bytes"][i] for i in keep], left, anchor[keep], width
        )
        hit = (first >= 0) & (np.array(rows["size"])[keep] == 1)
        at = keep[hit]
        place = np.array(rows["place"])[at]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(rows["id0"])[at], pa.int64()),
                pa.array(np.array(rows["hash"])[at], pa.int64()),
                pa.array(place - last[hit], pa.int64()),
                pa.array(place - first[hit] + width.length, pa.int64()),
            ],
            ["id0", "hash", "start", "end"],
        )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {name: [] for name in names}
        for batch in batches:
            for name in names:
                held[name] += batch.column(name).to_pylist()
            if len(held["anchor"]) >= SORTED_AT_ONCE:
                # The last anchor may have more contexts to come.
                anchor = held["anchor"]
                cut = len(anchor)
                while cut and anchor[cut - 1] == anchor[-1]:
                    cut -= 1
                if cut:
                    yield spans({name: values[:cut] for name, values in held.items()})
                    held = {name: values[cut:] for name, values in held.items()}
        if held["anchor"]:
            yield spans(held)

    dealt = contexts.select(*names).repartition("anchor")
    return dealt.sortWithinPartitions("anchor", "context").mapInArrow(sort, SPANS)


def _counted_spans(contexts: DataFrame, width: Width) -> DataFrame:
    """Spans from counting the strings themselves, for anchors with very many contexts."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("id0", "hash", "place", "left", "bytes")
            columns = [batch.column(name).to_pylist() for name in names]
            for id0, text, place, left, data in zip(*columns):
                starts = range(len(data) - width.length + 1)
                found = [hashlib.md5(data[i : i + width.length]).digest() for i in starts]
                count = len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([id0] * count, pa.int64()),
                        pa.array([text] * count, pa.int64()),
                        pa.array([place - left + i for i in starts], pa.int64()),
                        pa.array(found, pa.binary()),
                    ],
                    ["id0", "hash", "start", "string"],
                )

    each = contexts.mapInArrow(strings, "id0 long, hash long, start long, string binary")
    each = each.distinct()  # neighbouring anchors share strings
    often = each.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return salted_join(each, often, ["string"], ["id0", "hash", "start"]).select(
        "id0", "hash", "start", (F.col("start") + width.length).alias("end")
    )


def repeated_spans(scratch: Scratch, texts: DataFrame, width: Width) -> DataFrame:
    """(id0, hash, start, end): spans whose union is all that repeated strings cover.

    `texts` has id0, hash and data. Anchors that occur once are dropped first. Contexts that
    occur more than once are spans as a whole; of different contexts of an anchor, one of each
    kind is compared with the others.
    """
    found = scratch.table(_all_anchors(texts, width))
    often = scratch.table(
        found.groupBy("anchor")
        .agg(
            F.count("*").alias("n"),
            (F.min("context") == F.max("context")).alias("alike"),
        )
        .where("n > 1")
        .drop("n")
    )
    repeated = scratch.table(table_join(found, often, ["anchor"], [*KEYS, "place"]))
    # Any one of equal contexts will do; the columns of the first come from one row.
    kinds = scratch.table(
        repeated.where("not alike")
        .groupBy("anchor", "context")
        .agg(F.count("*").alias("size"), *[F.first(c).alias(c) for c in (*KEYS, "place")])
    )
    whole = table_join(
        repeated.where("not alike"),
        scratch.table(kinds.where("size > 1").select("anchor", "context")),
        ["anchor", "context"],
        [*KEYS, "place"],
    )
    start = F.greatest(F.col("place") - width.before, F.lit(0)).cast("long")
    end = (F.col("place") + width.length).cast("long")
    copies = (
        repeated.where("alike")
        .select(*KEYS, "place")
        .union(whole.select(*KEYS, "place"))
        .select(*KEYS, start.alias("start"), end.alias("end"))
    )
    crowds = scratch.table(
        kinds.groupBy("anchor")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > GROUP)
        .select("anchor", F.lit(True).alias("crowded"))
    )
    wanted = table_join(kinds, crowds, ["anchor"], ["context"], "left").withColumn(
        "crowded", F.coalesce("crowded", F.lit(False))
    )
    contexts = _contexts(texts, wanted, width)
    few, many = contexts.where("not crowded"), contexts.where("crowded")
    return copies.union(_sorted_spans(few, width)).union(_counted_spans(many, width))


def _merged(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal runs of a text of `size` bytes."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted((span["start"], min(size, span["end"])) for span in spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((start, end))
    return runs


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    keep_text: bool = False,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of each row.

    Texts are UTF-8 bytes, a null one empty. Every byte covered by a string of `length` bytes
    that starts anywhere else too goes, judged on the texts as given. n_spans counts maximal
    removed runs; kept_sha256 is the hash of the remaining bytes, which are `kept` if
    `keep_text`. Texts shorter than `length` are kept. Repeated rows and rows with a null id are
    texts like any other. Other columns are not read. An empty table gives an empty result.

    Very long texts are cut into contexts that are compared each by itself, and put together
    again in one task, which holds the text and its removed ranges. Equal strings that begin at
    several places all go; there is no first one that stays.
    """
    width = Width.of(length)
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit(""))
    doc_id = F.col(id_column).cast("long")
    texts = docs.select(
        F.coalesce(doc_id, F.lit(-(1 << 63)).cast("long")).alias("id0"),
        F.xxhash64(text).alias("hash"),
        text.cast("binary").alias("data"),
        doc_id.alias("doc_id"),
    )
    spans = (
        repeated_spans(scratch, texts.drop("doc_id"), width)
        .groupBy(*KEYS)
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, runs_of, hashes, kept = [], [], [], [], []
            texts = _unpacked(batch.column("packed"), batch.column("bytes"))
            for data, spans in zip(texts, batch.column("spans")):
                runs = _merged(spans.as_py() or [], len(data))
                at, rest = 0, []
                for start, end in runs:
                    rest.append(data[at:start])
                    at = end
                rest = b"".join([*rest, data[at:]])
                sizes.append(len(data))
                removed.append(len(data) - len(rest))
                runs_of.append(len(runs))
                hashes.append(hashlib.sha256(rest).hexdigest())
                if keep_text:
                    kept.append(rest)
            columns = [
                batch.column("doc_id"),
                *(pa.array(x, pa.int64()) for x in (sizes, removed, runs_of)),
                pa.array(hashes, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(kept, pa.binary())] * keep_text,
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text,
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    joined = _packed(texts).join(spans, KEYS, "left").select("doc_id", "packed", "bytes", "spans")
    return joined.mapInArrow(remove, schema + ", kept binary" * keep_text)
