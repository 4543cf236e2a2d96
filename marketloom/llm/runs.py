"""Periodic runs of words, found with suffix trees, and texts collapsed to their first periods.

A run is a stretch of words with a smallest period that no neighbouring word extends. Every run
holds a Lyndon word as long as its period that begins at each of its starts (its Lyndon root,
under one of the two orders of the words) [Bannai et al. 2017]. So the longest Lyndon word at
each place, under both orders, gives all candidates; each is extended to both sides by longest
common extensions. These come in constant time from Ukkonen's suffix trees of the words and of
their reversal: the depth of the lowest common ancestor of two leaves, found as a minimum over an
Euler tour.

Before trees are built, places that no run can hold are left out: a run of at least 12 words and
two periods repeats a gram of six words one period further on, at as many neighbouring places as
its length tells (`windows`). Equal grams always hash alike, so nothing is lost.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a run, at least. A gram has half as many.
LEAST = 12
#: Of how many ids (by their checksum) one is made periodic first; None: none.
PLANTED = 10
#: Words of documents whose grams are compared at a time.
WORDS_AT_ONCE = 1 << 20

FIELDS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of whole numbers, ended by a symbol below all others.

    Leaves stand for suffixes. Edges out of a node lie in one dictionary by (node, symbol).
    """

    def __init__(self, symbols: list[int]):
        self.symbols = [*symbols, -1]
        self.size = len(self.symbols)
        self._build()
        self._tour()

    def _build(self) -> None:
        symbols, width = self.symbols, max(self.symbols) + 2
        end = self.size  # an open leaf's edge goes to the end of the text
        starts, ends, link = [0], [0], [0]
        child: dict[int, int] = {}
        node = edge = length = waiting = 0
        for place, symbol in enumerate(symbols):
            waiting += 1
            made = 0
            while waiting:
                if not length:
                    edge = place
                key = node * width + symbols[edge] + 1
                below = child.get(key)
                if below is None:
                    child[key] = len(starts)
                    starts.append(place)
                    ends.append(end)
                    link.append(0)
                    if made:
                        link[made] = node
                        made = 0
                else:
                    first = starts[below]
                    span = min(ends[below], place + 1) - first
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    if symbols[first + length] == symbol:
                        length += 1
                        if made:
                            link[made] = node
                        break
                    split = len(starts)
                    starts += [first, place]
                    ends += [first + length, end]
                    link += [0, 0]
                    child[key] = split
                    child[split * width + symbol + 1] = split + 1
                    starts[below] = first + length
                    child[split * width + symbols[first + length] + 1] = below
                    if made:
                        link[made] = split
                    made = split
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = place - waiting + 1
        self._starts = np.array(starts)
        self._ends = np.array(ends)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)
        self._parents = (keys // width)[order]
        self._below = below[order]

    def _tour(self) -> None:
        """Walk around the tree, symbols ascending.

        Of the Euler tour the leaves are kept, in their order, and for two neighbouring leaves
        the depth of the shallowest node visited between them, which is their lowest common
        ancestor. The minimum over a stretch of the tour is a lookup in a sparse table.
        """
        self.order, meets = self._walk(descending=False)
        self.rank = _inverse(self.order)
        table = [np.array(meets, np.int32)]
        while 2 << (len(table) - 1) <= self.size:
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self._table = table

    def ranks_descending(self) -> np.ndarray:
        """Ranks of the suffixes if the order of the symbols, but for the end, were reversed."""
        return _inverse(self._walk(descending=True)[0])

    def _walk(self, descending: bool) -> tuple[np.ndarray, list[int]]:
        first = np.searchsorted(self._parents, np.arange(len(self._starts) + 1)).tolist()
        below = self._below.tolist()
        spans = (self._ends - self._starts).tolist()
        ending = (self._starts == self.size - 1).tolist()  # edges of the end symbol alone
        leaves: list[int] = []
        meets: list[int] = []
        meet = 0
        stack = [(0, 0, -1)]  # node, depth, and its parent's depth where the tour comes back to it
        while stack:
            node, depth, back = stack.pop()
            if back >= 0:
                meet = back
            low, high = first[node], first[node + 1]
            if low == high:
                leaves.append(self.size - depth)
                meets.append(meet)
                continue
            nodes = below[low:high]
            if descending:
                nodes = nodes[1:] + nodes[:1] if ending[nodes[0]] else nodes
            else:
                nodes.reverse()
            stack += [(n, depth + spans[n], depth) for n in nodes[:-1]]
            stack.append((nodes[-1], depth + spans[nodes[-1]], -1))
        return np.array(leaves), meets

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common beginning of the suffixes at a and at b, unlike places."""
        low = np.minimum(self.rank[a], self.rank[b]) + 1
        high = np.maximum(self.rank[a], self.rank[b]) + 1
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self._table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return out


def lyndon_lengths(rank: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word at each place: as far as the next smaller suffix."""
    n = len(rank)
    out = np.empty(n, np.int64)
    stack: list[int] = []
    for i in range(n - 1, -1, -1):
        here = rank[i]
        while stack and rank[stack[-1]] > here:
            stack.pop()
        out[i] = (stack[-1] if stack else n) - i
        stack.append(i)
    return out


def runs(symbols: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence, by start and period.

    Memory and time grow in proportion to the sequence (memory with a logarithm of it), about
    1 KB and 20 microseconds a word.
    """
    n = len(symbols)
    if n < least:
        return []
    ahead, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    found = set()
    for ranks in (ahead.rank, ahead.ranks_descending()):
        period = lyndon_lengths(ranks[:n].tolist())
        at = np.flatnonzero(np.arange(n) + period < n)
        period = period[at]
        right = ahead.common(at, at + period)
        left = np.zeros(len(at), np.int64)
        some = at > 0
        # In the reversal the word before a place i is number n - i.
        left[some] = back.common(n - at[some], n - at[some] - period[some])
        start, length = at - left, left + period + right
        good = length >= np.maximum(least, 2 * period)
        found |= set(zip(start[good].tolist(), length[good].tolist(), period[good].tolist()))
    return sorted(found, key=lambda run: (run[0], run[2]))


def _inverse(order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order))
    return out


def windows(
    symbols: np.ndarray, firsts: np.ndarray, least: int = LEAST
) -> list[tuple[int, int, int]]:
    """(document, start, end): stretches of documents that hold all their runs of `least` words.

    `symbols` holds the words of all documents in a row, `firsts` where each begins, and the
    end. A run of length L and period q has the same gram of least // 2 words at i and i + q for
    L - q - least // 2 + 1 neighbouring places i. So among those places that have the same gram
    further on in their document, a stretch of S neighbours has no run with a period of S plus a
    gram or more, and none that ends further behind it than that and a gram more.
    """
    gram = least // 2
    n = len(symbols) - gram + 1
    if n <= 0:
        return []
    doc = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    random = np.random.default_rng(gram)
    multipliers = random.integers(1, 1 << 63, gram + 1, np.uint64) | np.uint64(1)
    keys = doc[:n].astype(np.uint64) * multipliers[gram]
    for k in range(gram):
        keys += (symbols[k : n + k].astype(np.uint64) + np.uint64(1)) * multipliers[k]
    places = np.flatnonzero(doc[:n] == doc[gram - 1 :])  # grams inside one document
    order = places[np.argsort(keys[places], kind="stable")]
    ahead = np.zeros(n, np.int64)
    same = np.flatnonzero(
        (keys[order[1:]] == keys[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    )
    ahead[order[same]] = order[same + 1] - order[same]
    near = ahead > 0
    while True:
        low, high = _stretches(near, doc)
        size = np.repeat(high - low, high - low)
        at = np.flatnonzero(near)
        far = ahead[at] >= size + gram
        if not far.any():
            break
        near[at[far]] = False
    starts = np.maximum(low - 1, firsts[doc[low]])
    ends = np.minimum(high + (high - low) + 2 * gram, firsts[doc[low] + 1])
    out: list[tuple[int, int, int]] = []
    for d, start, end in zip(doc[low].tolist(), starts.tolist(), ends.tolist()):
        if out and out[-1][0] == d and start <= out[-1][2]:
            out[-1] = d, out[-1][1], max(end, out[-1][2])
        else:
            out.append((d, start, end))
    return out


def _stretches(near: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and ends of the stretches of neighbouring true places of one document."""
    at = np.flatnonzero(near)
    if not len(at):
        return at, at
    cut = np.flatnonzero((np.diff(at) > 1) | (doc[at[1:]] != doc[at[:-1]]))
    return at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + 1


def runs_of(documents: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several documents, given as words."""
    sizes = [len(words) for words in documents]
    firsts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not firsts[-1]:
        return out
    words = np.empty(firsts[-1], object)
    words[:] = [word for each in documents for word in each]
    symbols = pd.factorize(words)[0]
    for d, start, end in windows(symbols, firsts, least):
        whole = firsts[d], firsts[d + 1]
        few = np.unique(symbols[start:end], return_inverse=True)[1].tolist()
        for at, length, period in runs(few, least):
            at += start
            # A run cut off by a window lies wholly in another one.
            if (at > start or start == whole[0]) and (at + length < end or end == whole[1]):
                out[d].append((int(at - whole[0]), length, period))
    return out


def planted(words: list[bytes], doc_id: int | None, one_in: int | None = PLANTED) -> list[bytes]:
    """The words, made periodic from some place on if the checksum of the id says so."""
    n = len(words)
    if doc_id is None or one_in is None or not n:
        return words
    checksum = zlib.crc32(str(doc_id).encode())
    if checksum % one_in:
        return words
    g = checksum // one_in
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]


def collapse_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: int = LEAST,
    one_in: int | None = PLANTED,
    keep: bool = False,
) -> DataFrame:
    """The periodic runs of each document's words, and its text with each run's first period.

    Words are what blanks (space, tab to carriage return) divide, numbered from 0. Of the rows
    with an id of one of `one_in` checksums the words are made periodic first (`planted`; None:
    none are). A run has at least `least` words and two periods.
    Returns a row for each input row: (doc_id, n_runs, start, length, period, exponent_milli,
    runs_sha256, collapsed_sha256[, runs, collapsed]); start to exponent_milli are those of the
    longest run, of ties the one of smallest start and then period, and null without a run.

    A null or empty text has no words; its collapsed text is empty. Repeated rows give repeated
    results. A row without a doc_id is not made periodic. Very long texts are read whole: a
    stretch that may be periodic takes about 1 KB of memory a word in its task, other text its
    own size. An empty table gives no rows. Other columns, whatever their names, are not read.
    """
    added = ", runs array<struct<start: long, length: long, period: long>>, collapsed string"
    kind = FIELDS + (added if keep else "")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            for ids, documents in _portions(batch, one_in):
                rows = [
                    _result(doc_id, words, found, keep)
                    for doc_id, words, found in zip(ids, documents, runs_of(documents, least))
                ]
                schema = schema or _arrow_schema(keep)
                yield pa.RecordBatch.from_pylist(rows, schema)

    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return narrow.mapInArrow(scan, kind)


def _portions(
    batch: pa.RecordBatch, one_in: int | None
) -> Iterator[tuple[list[int | None], list[list[bytes]]]]:
    """Ids and words of a batch's documents, WORDS_AT_ONCE or a document at a time."""
    ids: list[int | None] = []
    documents: list[list[bytes]] = []
    held = 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        number, found = doc_id.as_py(), text.as_py()
        # Splitting bytes divides at exactly these blanks.
        words = planted((found or "").encode().split(), number, one_in)
        if held and held + len(words) > WORDS_AT_ONCE:
            yield ids, documents
            ids, documents, held = [], [], 0
        ids.append(number)
        documents.append(words)
        held += len(words)
    if ids:
        yield ids, documents


def _result(
    doc_id: int | None, words: list[bytes], found: list[tuple[int, int, int]], keep: bool
) -> dict:
    found = sorted(found, key=lambda run: (run[0], run[2]))
    start, length, period = max(
        found, key=lambda run: (run[1], -run[0], -run[2]), default=(None, None, None)
    )
    listed = "".join(f"{run[0]},{run[1]},{run[2]}\n" for run in found)
    text = b" ".join(collapsed(words, found))
    row = {
        "doc_id": doc_id,
        "n_runs": len(found),
        "start": start,
        "length": length,
        "period": period,
        "exponent_milli": length and 1000 * length // period,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(text).hexdigest(),
    }
    if keep:
        row["runs"] = [dict(zip(("start", "length", "period"), run)) for run in found]
        row["collapsed"] = text.decode()
    return row


def _arrow_schema(keep: bool) -> pa.Schema:
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    whole = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")
    fields = [(name, pa.int64()) for name in whole]
    fields += [(name, pa.string()) for name in ("runs_sha256", "collapsed_sha256")]
    kept = [("runs", pa.list_(run)), ("collapsed", pa.string())]
    return pa.schema(fields + (kept if keep else []))
