"""Packing token sequences by best-fit decreasing, over the histogram of piece lengths.

A document's ids are cut into full windows and one rest. Which window best-fit decreasing gives
a piece depends on nothing but the lengths, so the plan is made from the number of pieces of
each length: at most `capacity` numbers, however many documents there are. Pieces of one length
go to windows of one remaining capacity in runs. A segment tree indexed by remaining capacity
finds the tightest open window. Each piece then finds its window from its rank among the pieces
of its length.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import Scratch, extended, salt

CAPACITY = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Ranks are counted in this many shares of each length.
SHARES = 1024
#: Characters of documents that are encoded at a time.
CHARS_AT_ONCE = 1 << 20

class Encoder:
    """Ids of texts as bytes, four to an id, as the library `tokenizers` gives them.

    With the same vocabulary as a list of ranks too, texts of Latin-1 characters go through
    `tiktoken`, which gives the same ids several times as fast. The two libraries could only
    differ in what they hold for a letter, which for these characters is settled; all other
    texts go through `tokenizers`, and without ranks every text does. So do texts with runs of
    white space of a million characters, which are beyond the stack of `tiktoken`'s pattern.

    Strings of the tokenizer's special tokens are plain text, or with `special_as_text` False
    the tokens themselves, as a tokenizer gives them that is used as its file has it. Texts that
    hold one go through `tokenizers` then.
    """

    def __init__(
        self, tokenizer_path: str, ranks_path: str | None, special_as_text: bool = True
    ):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._tokenizer.encode_special_tokens = special_as_text
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._apart = [t.content for t in added if not (t.special and special_as_text)]
        self._ranks = _ranked(ranks_path) if ranks_path else None

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [self._quick(text) for text in texts]
        slow = [i for i, ids in enumerate(out) if ids is None]
        found = self._tokenizer.encode_batch_fast(
            [texts[i] for i in slow], add_special_tokens=False
        )
        for i, encoding in zip(slow, found):
            out[i] = np.array(encoding.ids, dtype="<u4").tobytes()
        return out

    def _quick(self, text: str) -> bytes | None:
        if self._ranks is None or any(token in text for token in self._apart):
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        try:
            ids = self._ranks.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            return None
        return ids.astype("<u4").tobytes()


def _ranked(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_ENCODERS: dict[tuple[str | None, bool], Encoder] = {}


def encoder(tokenizer_path: str | None, special_as_text: bool = True) -> Encoder:
    """The worker's encoder for a tokenizer file, by default the public one with its ranks."""
    key = tokenizer_path, special_as_text
    if key not in _ENCODERS:
        if tokenizer_path is None:
            import public_tokenizers

            paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)
        else:
            paths = tokenizer_path, None
        _ENCODERS[key] = Encoder(*paths, special_as_text)
    return _ENCODERS[key]


def pieces(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    keep_ids: bool = False,
    special_as_text: bool = True,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): each document's ids in pieces.

    Full windows first, then the rest. The ids are the tokenizer's, then `end_id`; a null text
    counts as empty.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, special_as_text).encode
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for ids, texts in _portions(batch):
                out = defaultdict(list)
                for doc_id, encoded in zip(ids, encode(texts)):
                    tokens = len(encoded := encoded + end) // 4
                    for start in range(0, tokens, capacity):
                        piece = encoded[4 * start : 4 * (start + capacity)]
                        out["doc_id"].append(doc_id)
                        out["start"].append(start)
                        out["length"].append(len(piece) // 4)
                        out["ids_crc32"].append(zlib.crc32(piece))
                        out["doc_tokens"].append(tokens)
                        if keep_ids:
                            out["ids"].append(np.frombuffer(piece, dtype="<u4").astype(np.int32))
                columns = [pa.array(v, pa.int64()) for k, v in out.items() if k != "ids"]
                if keep_ids:
                    columns.append(pa.array(out["ids"], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, list(out))

    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return narrow.mapInArrow(cut, schema + ", ids array<int>" * keep_ids)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """The batch's ids and texts, about CHARS_AT_ONCE characters at a time."""
    ids, texts, chars = [], [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        ids.append(doc_id.as_py())
        texts.append(text.as_py() or "")
        chars += len(texts[-1])
        if chars >= CHARS_AT_ONCE:
            yield ids, texts
            ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


class OpenWindows:
    """Which remaining capacities have an open window: a segment tree over the capacities."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._open = [0] * (2 * self._leaves)

    def add(self, remaining: int, windows: int) -> None:
        at = self._leaves + remaining
        while at:
            self._open[at] += windows
            at //= 2

    def tightest(self, size: int) -> int | None:
        """The smallest remaining capacity of at least `size` with an open window."""
        at = self._leaves + size
        while not self._open[at]:
            while at & 1:  # a right child: nothing to its right below this parent
                at //= 2
            if not at:
                return None
            at += 1
        while at < self._leaves:
            at = 2 * at if self._open[2 * at] else 2 * at + 1
        return at - self._leaves


class Runs(NamedTuple):
    """Pieces in order of falling length and rank; each run's first piece and where it goes.

    Piece k of a run goes to window `window + k // each` at `offset + k % each * length`.
    """

    length_base: np.ndarray  # by length: the number of longer pieces
    first: np.ndarray
    window: np.ndarray
    offset: np.ndarray
    each: np.ndarray
    fill_from: np.ndarray  # first window of a range of windows with equal contents
    fill: np.ndarray  # its number of ids

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """Window, offset in it and ids in it, of pieces by length and rank from 0."""
        at = self.length_base[length] + rank
        run = np.searchsorted(self.first, at, side="right") - 1
        nth = at - self.first[run]
        window = self.window[run] + nth // self.each[run]
        offset = self.offset[run] + nth % self.each[run] * length
        return window, offset, self.fill[np.searchsorted(self.fill_from, window, "right") - 1]


def best_fit_decreasing(sizes: Mapping[int, int], capacity: int) -> Runs:
    """Where best-fit decreasing puts pieces, from the number of pieces of each length.

    A window that just took a piece and still has room for another of its length is the tightest
    for it, so windows of one remaining capacity take as many each as fit, one after the other.
    """
    tree = OpenWindows(capacity)
    ranges: dict[int, deque] = defaultdict(deque)  # by remaining capacity: (first, number)
    length_base = np.zeros(capacity + 1, dtype=np.int64)
    runs, placed, windows = [], 0, 0

    def close(first: int, number: int, remaining: int) -> None:
        if number:
            ranges[remaining].append((first, number))
            tree.add(remaining, number)

    for size in sorted(sizes, reverse=True):
        length_base[size], left = placed, sizes[size]
        while left:
            remaining = tree.tightest(size)
            if remaining is None:
                remaining, each = capacity, capacity // size
                first, number = windows, -(-left // each)
                windows += number
            else:
                each = remaining // size
                first, number = ranges[remaining].popleft()
                tree.add(remaining, -number)
            full = min(number, left // each)
            taken = full * each
            runs.append((placed, first, capacity - remaining, each))
            close(first, full, remaining - each * size)
            some = min(left - taken, each - 1) if full < number else 0
            if some:
                close(first + full, 1, remaining - some * size)
            close(first + full + bool(some), number - full - bool(some), remaining)
            placed += taken + some
            left -= taken + some
    filled = sorted(
        (first, capacity - remaining) for remaining, x in ranges.items() for first, _ in x
    )
    columns = np.array(runs, dtype=np.int64).reshape(-1, 4).T
    fill = np.array(filled, dtype=np.int64).reshape(-1, 2).T
    return Runs(length_base, *columns, *fill)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of up to `capacity` ids with sequence_id, offset, sequence_tokens, padded_tokens.

    `pieces` has doc_id, start, length and ids_crc32, and must not change when it is read again:
    it is a written table. A rank of equal pieces is any order of them.
    """
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    plan = best_fit_decreasing(counts, capacity)
    shares = pieces.withColumn("_share", salt("doc_id", "start", "ids_crc32", salts=SHARES))
    before = Window.partitionBy("length").orderBy("_share")
    bases = (
        shares.groupBy("length", "_share")
        .agg(F.count("*").alias("n"))
        .select(
            "length",
            "_share",
            (F.sum("n").over(before) - F.col("n")).alias("_base"),
        )
    )
    within = Window.partitionBy("length", "_share").orderBy("doc_id", "start", "ids_crc32")
    ranked = shares.withColumn("_rank", F.row_number().over(within)).join(
        bases, ["length", "_share"]
    )
    columns = pieces.columns
    extra = ["sequence_id", "offset", "sequence_tokens", "padded_tokens"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            window, offset, tokens = plan.place(length, rank)
            padded = np.where(tokens & (tokens - 1), capacity, tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [pa.array(x, pa.int64()) for x in (window, offset, tokens, padded)],
                columns + extra,
            )

    ranked = ranked.select(*columns, (F.col("_rank") - 1 + F.col("_base")).alias("_rank"))
    added = ", ".join(f"{name} long" for name in extra)
    return ranked.mapInArrow(assign, extended(pieces.schema, added))


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    keep_ids: bool = False,
    special_as_text: bool = True,
) -> DataFrame:
    """Documents in sequences of at most `capacity` ids, one row per piece.

    doc_id, start, length, ids_crc32, doc_tokens, [ids,] sequence_id, offset, sequence_tokens
    (ids in the sequence) and padded_tokens (its length with padding: `capacity`, but a sequence
    whose length is a power of two stays as it is). Null and empty texts are the end id alone.
    With `special_as_text` False a special token's string in a text is that token.
    Null ids and repeated rows are packed like any other row. Other columns are not read. An
    empty table gives an empty result.

    A very long text is encoded whole, in one task, and cut into full windows. Pieces of one
    length are ranked by share, doc_id, start and checksum; those equal in all are
    interchangeable.
    """
    scratch = Scratch(docs.sparkSession)
    cut = pieces(
        docs, id_column, text_column, capacity, tokenizer_path, end_id, keep_ids, special_as_text
    )
    return place(scratch.table(cut), capacity)


def sequences(packed: DataFrame, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, doc_ids): the padded sequences of a packing that kept its ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return (
        packed.groupBy("sequence_id", "padded_tokens")
        .agg(ordered.alias("pieces"))
        .select(
            "sequence_id",
            F.flatten("pieces.ids").alias("ids"),
            F.col("pieces.doc_id").alias("doc_ids"),
            "padded_tokens",
        )
        .select(
            "sequence_id",
            F.concat(
                "ids",
                F.array_repeat(F.lit(pad_id), F.col("padded_tokens").cast("int") - F.size("ids")),
            ).alias("ids"),
            "doc_ids",
        )
    )
