"""Which tokens of two tokenizers cover the same bytes, by merge-path partitioning.

The ends of A's and B's tokens, as byte offsets, are two ascending lists; merging them gives all
overlaps of tokens, and the offsets where both end cut the tokens into groups. The merge of a
whole portion of documents is cut into pieces of equal work: each diagonal of the merge grid, every
`WORK` steps, is searched in binary for the point where the merge path crosses it [Odeh et al.
2012]. Pieces are independent and advance side by side, one step at a time, in numpy. A piece
emits the overlaps of its steps; groups that run on into the next piece are stitched by counting
the ends in common of the pieces before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Scratch
from marketloom.llm.packing import TOKENIZER, encoder
from marketloom.operators.joins import heavy_keys, lookup_join

MODEL = "piece_bpe_32k.model"
#: Merge steps of a piece.
WORK = 64
#: Characters of documents that are encoded and merged at a time.
CHARS_AT_ONCE = 1 << 20
#: Pairs of ids whose counts are broadcast, at most: 24 bytes each, some 40 MB in all.
BROADCAST_PAIRS = 1_000_000

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Merged(NamedTuple):
    """The overlaps of tokens in order: A's token, B's token, and whether both end there."""

    a: np.ndarray
    b: np.ndarray
    both: np.ndarray
    group: np.ndarray


def diagonals(a_ends: np.ndarray, b_ends: np.ndarray, work: int = WORK) -> np.ndarray:
    """How many of A's ends the merge has taken after 0, `work`, 2 `work`, … steps, and at the end.

    A's end is taken before an equal one of B. All diagonals are searched in binary at once.
    """
    total = len(a_ends) + len(b_ends)
    steps = np.append(np.arange(0, total, work), total)
    low = np.maximum(0, steps - len(b_ends))
    high = np.minimum(steps, len(a_ends))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        # A's end number `middle` is among the first `steps` unless B's end on the diagonal is less.
        taken = np.zeros(len(steps), bool)
        taken[open_] = a_ends[middle[open_]] <= b_ends[steps[open_] - 1 - middle[open_]]
        low = np.where(open_ & taken, middle + 1, low)
        high = np.where(open_ & ~taken, middle, high)
    return low


def merge(a_ends: np.ndarray, b_ends: np.ndarray, work: int = WORK) -> Merged:
    """Merge two strictly ascending lists of ends with one last end, piece by piece."""
    total = len(a_ends) + len(b_ends)
    if not total:
        nothing = np.zeros(0, np.int64)
        return Merged(nothing, nothing, nothing.astype(bool), nothing)
    path = diagonals(a_ends, b_ends, work)
    starts = np.arange(0, total, work)
    at_a, at_b = path[:-1].copy(), starts - path[:-1]
    pieces = len(starts)
    # Sentinels end both lists, so that no piece looks beyond one.
    beyond = np.iinfo(np.int64).max
    a, b = np.append(a_ends, beyond), np.append(b_ends, beyond)
    out_a = np.empty((pieces, work), np.int64)
    out_b = np.empty((pieces, work), np.int64)
    kind = np.empty((pieces, work), np.int8)  # 0 one ends, 1 both end, 2 the second of both
    for step in range(work):
        end_a, end_b = a[at_a], b[at_b]
        takes_a = end_a <= end_b
        out_a[:, step], out_b[:, step] = at_a, at_b
        # The end taken just before may be A's equal one, in this piece or in the one before.
        second = ~takes_a & (at_a > 0) & (a[at_a - 1] == end_b)
        kind[:, step] = np.where(second, 2, end_a == end_b)
        at_a += takes_a
        at_b += ~takes_a
        # A short last piece stays at the end of both lists.
        np.minimum(at_a, len(a_ends), out=at_a)
        np.minimum(at_b, len(b_ends), out=at_b)
    kind.ravel()[total:] = 2
    # Stitching: a piece goes on with the group that the pieces before it have left open.
    both = kind == 1
    before = np.cumsum(both.sum(axis=1)) - both.sum(axis=1)
    group = before[:, None] + np.cumsum(both, axis=1) - both
    emitted = kind < 2
    return Merged(out_a[emitted], out_b[emitted], both[emitted], group[emitted])


def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer.

    Its entries show printable Latin-1 bytes as themselves, and the others, in their order, as
    the characters from U+0100 on.
    """
    from tokenizers import Tokenizer

    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(0x100) if byte not in shown]
    table = {chr(byte): byte for byte in shown}
    table |= {chr(0x100 + n): byte for n, byte in enumerate(hidden)}
    vocabulary = Tokenizer.from_file(path).get_vocab()
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, number in vocabulary.items():
        out[number] = bytes(table[c] for c in entry)
    return out


class Tokenizers:
    """The two tokenizers: ids and bytes of tokens."""

    def __init__(self, a_path: str | None = None, b_path: str | None = None):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        self._a = encoder(a_path, special_as_text=True)
        a_file = a_path or public_tokenizers.path(TOKENIZER)
        self._b = SentencePieceProcessor(model_file=b_path or public_tokenizers.path(MODEL))
        self.a_bytes = byte_level_tokens(a_file)
        self.b_bytes = [self._piece(i) for i in range(self._b.get_piece_size())]
        self.a_sizes = np.array([len(token) for token in self.a_bytes])
        self.b_sizes = np.array([len(token) for token in self.b_bytes])

    def _piece(self, number: int) -> bytes:
        piece = self._b.id_to_piece(number)
        if self._b.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of each text with a space before it; none where bytes differ."""
        some = [i for i, text in enumerate(texts) if text]
        a = self._a.encode([f" {texts[i]}" for i in some])
        b = self._b.encode([texts[i] for i in some], num_threads=1)
        nothing = np.zeros(0, np.int64)
        out = [(nothing, nothing)] * len(texts)
        for i, packed, ids in zip(some, a, b):
            wanted = b" " + texts[i].encode()
            a_ids = np.frombuffer(packed, "<u4").tolist()
            if b"".join([self.a_bytes[t] for t in a_ids]) != wanted:
                continue
            if b"".join([self.b_bytes[t] for t in ids]) != wanted:
                continue
            out[i] = np.array(a_ids, np.int64), np.array(ids, np.int64)
        return out


class Alignment(NamedTuple):
    """Of several documents: ids, each document's first one, overlaps, groups by document."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_firsts: np.ndarray
    b_firsts: np.ndarray
    merged: Merged


def align(tokens: Tokenizers, texts: list[str], work: int = WORK) -> Alignment:
    """Encode texts and merge their tokens' ends, those of all texts in a row."""
    encoded = tokens.encode(texts)
    a_ids = np.concatenate([np.zeros(0, np.int64), *[a for a, _ in encoded]])
    b_ids = np.concatenate([np.zeros(0, np.int64), *[b for _, b in encoded]])
    a_firsts = np.concatenate([[0], np.cumsum([len(a) for a, _ in encoded], dtype=np.int64)])
    b_firsts = np.concatenate([[0], np.cumsum([len(b) for _, b in encoded], dtype=np.int64)])
    # Both tokenizers cover the same bytes of each document, so its end is one in common.
    a_ends = np.cumsum(tokens.a_sizes[a_ids])
    b_ends = np.cumsum(tokens.b_sizes[b_ids])
    return Alignment(a_ids, b_ids, a_firsts, b_firsts, merge(a_ends, b_ends, work))


_TOKENIZERS: dict[tuple[str | None, str | None], Tokenizers] = {}


def tokenizers(a_path: str | None, b_path: str | None) -> Tokenizers:
    """The worker's tokenizers."""
    key = a_path, b_path
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = Tokenizers(*key)
    return _TOKENIZERS[key]


class Digits:
    """Ids as text with what follows them: a comma, a bar or a semicolon."""

    def __init__(self, vocabulary: int):
        self._size = vocabulary
        names = [str(i) for i in range(vocabulary)]
        self._texts = np.array([n + mark for mark in ",|;" for n in names], object)

    def listed(self, found: Alignment) -> list[str]:
        """`a1,a2|b1;a3|b2` of each document: A's and B's ids of each group."""
        cut = np.flatnonzero(found.merged.both)
        a_last, b_last = found.merged.a[cut], found.merged.b[cut]
        marks = np.zeros(len(found.a_ids), np.int64), np.zeros(len(found.b_ids), np.int64)
        marks[0][a_last], marks[1][b_last] = 1, 2
        # Before a token of A come the B tokens of the groups before, and the other way round.
        groups_a = np.diff(np.append(-1, a_last))
        groups_b = np.diff(np.append(-1, b_last))
        before_b = np.append(0, b_last[:-1] + 1) if len(cut) else b_last
        place_a = np.arange(len(found.a_ids)) + np.repeat(before_b, groups_a)
        place_b = np.arange(len(found.b_ids)) + np.repeat(a_last + 1, groups_b)
        texts = np.empty(len(place_a) + len(place_b), object)
        texts[place_a] = self._texts[marks[0] * self._size + found.a_ids]
        texts[place_b] = self._texts[marks[1] * self._size + found.b_ids]
        firsts = (found.a_firsts + found.b_firsts).tolist()
        whole = texts.tolist()
        return ["".join(whole[i:j])[:-1] for i, j in zip(firsts, firsts[1:])]


def aligned(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
    work: int = WORK,
    keep: bool = False,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs[, groups]) of each document.

    `pairs` lists the document's linked pairs of ids and how often it links them, a pair as one
    number: A's id times 2^32 and B's. `groups` is the text that is hashed.
    """
    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    kind += " pairs array<struct<pair: long, n: int>>" + ", groups string" * keep

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizers(a_path, b_path)
        digits = Digits(max(len(tokens.a_bytes), len(tokens.b_bytes)))
        for batch in batches:
            for ids, texts in _portions(batch):
                yield _described(ids, align(tokens, texts, work), digits, keep)

    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return narrow.mapInArrow(scan, kind)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str]]]:
    ids: list[int | None] = []
    texts: list[str] = []
    held = 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        ids.append(doc_id.as_py())
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= CHARS_AT_ONCE:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _described(
    ids: list[int | None], found: Alignment, digits: Digits, keep: bool
) -> pa.RecordBatch:
    listed = digits.listed(found)
    cut = np.flatnonzero(found.merged.both)
    a_last, b_last = found.merged.a[cut], found.merged.b[cut]
    pairs = found.a_ids[a_last] << 32 | found.b_ids[b_last]
    doc = np.searchsorted(found.a_firsts, a_last, side="right") - 1
    # Equal pairs of a document are counted: pairs in order, document by document.
    order = np.lexsort((pairs, doc))
    pairs, doc = pairs[order], doc[order]
    new = np.flatnonzero(np.append(True, (np.diff(pairs) != 0) | (np.diff(doc) != 0))[: len(pairs)])
    n = np.diff(np.append(new, len(pairs)))
    documents = np.arange(len(ids) + 1)
    links = np.diff(np.searchsorted(doc, documents))
    lists = np.searchsorted(doc[new], documents).astype(np.int32)
    struct = pa.StructArray.from_arrays(
        [pa.array(pairs[new], pa.int64()), pa.array(n.astype(np.int32))], ["pair", "n"]
    )
    hashes = [hashlib.sha256(text.encode()).hexdigest() if text else "" for text in listed]
    columns = {
        "doc_id": pa.array(ids, pa.int64()),
        "n_a": pa.array(np.diff(found.a_firsts)),
        "n_b": pa.array(np.diff(found.b_firsts)),
        "n_groups": pa.array(links),
        "n_links": pa.array(links),
        "groups_sha256": pa.array(hashes, pa.string()),
        "pairs": pa.ListArray.from_arrays(pa.array(lists), struct),
    } | ({"groups": pa.array(listed, pa.string())} if keep else {})
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def link_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
) -> DataFrame:
    """How the tokens of two tokenizers align in each document, and how usual its links are.

    A is a byte-level BPE of `tokenizers`, B a `sentencepiece` model; a text is encoded with one
    space before it, without special tokens. A link is a token of A and one of B that end at the
    same byte; a group is what lies between two such ends. Returns a row for each input row:
    (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256). The count of a pair
    of ids is the number of its links in all documents; `count_sum` adds it over the document's
    links, `n_best` counts those whose count is the highest of their B id, ties included.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte (U+2581 in
    them, for one), have no tokens: zeros and an empty hash. Repeated rows count as often as they
    come, rows without a doc_id too. Very long texts are read whole, in one task, about 150 bytes
    of memory a character. An empty table gives no rows. Other columns, whatever their names, are
    not read.
    """
    scratch = Scratch(docs.sparkSession)
    found = aligned(docs, id_column, text_column, a_path, b_path)
    found = scratch.table(found.withColumn("row", F.monotonically_increasing_id()))
    each = found.select("row", F.explode("pairs").alias("p")).select("row", "p.pair", "p.n")
    counts = each.groupBy("pair").agg(F.sum("n").alias("count"))
    highest = counts.groupBy(_b_id("pair").alias("b")).agg(F.max("count").alias("most"))
    usual = scratch.table(
        counts.join(highest, _b_id("pair") == F.col("b")).select(
            "pair", "count", (F.col("count") == F.col("most")).alias("best")
        )
    )
    if usual.count() <= BROADCAST_PAIRS:
        told = each.join(F.broadcast(usual), "pair")
    else:
        told = lookup_join(each, usual, "pair", "inner", heavy_keys(each, "pair"), ["row"])
    sums = told.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return found.drop("pairs").join(sums, "row", "left").select(
        "doc_id",
        *COUNTS,
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )


def _b_id(pair: str):
    return F.col(pair).bitwiseAND(F.lit((1 << 32) - 1))
