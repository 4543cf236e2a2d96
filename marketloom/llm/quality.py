"""Document quality from a linear-chain conditional random field over lines.

Each line of a document is labelled good or bad. A line's features describe it and the lines
beside it; the chain's transitions tie neighbouring labels. Only documents have known labels, so
for training every line takes its document's. Forward-backward gives each line's probability of
being good, and a document's quality is their mean, weighted by the lines' lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm import folds

FOLDS, HELD_OUT = 5, 0
#: Predicted good from this score.
THRESHOLD = 0.3
#: Labelled documents to learn from, chains of each and lines of a chain, at most.
FIT_DOCS, FIT_CHAINS, FIT_LINES = 3000, 8, 64
STEPS, RATE, DECAY = 150, 0.05, 1e-3
SEED = 3

#: Bytes of text whose lines are described at a time. Longer lines are wrapped at LINE_BYTES.
BYTES_AT_ONCE = 1 << 20
LINE_BYTES = 1 << 16

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
UPPER, LOWER, DIGIT, SPACE, CONTROL, LEAD, FOLLOW = range(len(PUNCTUATION), len(PUNCTUATION) + 7)
KINDS = FOLLOW + 1
PRIME = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64


def _kinds() -> np.ndarray:
    kinds = np.full(256, CONTROL, dtype=np.int64)
    for i, char in enumerate(PUNCTUATION):
        kinds[char] = i
    for kind, chars in ((UPPER, range(65, 91)), (LOWER, range(97, 123)), (DIGIT, range(48, 58))):
        kinds[list(chars)] = kind
    kinds[[9, 32]] = SPACE
    kinds[192:] = LEAD
    kinds[128:192] = FOLLOW
    return kinds


KIND = _kinds()


def _steps(value: np.ndarray, *limits: float) -> list[np.ndarray]:
    return [value > limit for limit in limits]


def describe(lines: list[bytes]) -> np.ndarray:
    """Features of lines by themselves, one row for each; all in one pass over the bytes."""
    n = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    data = np.frombuffer(b"\n".join(lines) + b"\n", dtype=np.uint8)
    ends = np.cumsum(n + 1)
    owner = np.repeat(np.arange(len(lines)), n + 1)
    kinds = KIND[data]
    counts = np.bincount(owner * KINDS + kinds, minlength=len(lines) * KINDS)
    counts = counts.reshape(-1, KINDS).astype(np.float64)
    counts[:, CONTROL] -= 1  # the line's end
    size = np.maximum(n, 1)
    ratio = counts / size[:, None]
    punctuation = ratio[:, : len(PUNCTUATION)].sum(axis=1)

    space = (kinds == SPACE) | (kinds == CONTROL)
    starts = np.nonzero(~space & np.concatenate([[True], space[:-1]]))[0]
    stops = np.nonzero(space & np.concatenate([[False], ~space[:-1]]))[0]
    of = owner[starts]
    words = np.bincount(of, minlength=len(lines))
    many = np.maximum(words, 1)
    hashes = _word_hashes(data, starts, stops)
    again = np.zeros(len(starts), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    repeated = np.bincount(of, weights=again, minlength=len(lines)) / many
    ends_marked = KIND[data[stops - 1]] < len(PUNCTUATION)
    marked = np.bincount(of, weights=ends_marked, minlength=len(lines)) / many
    length = (stops - starts).astype(np.float64)
    mean = np.bincount(of, weights=length, minlength=len(lines)) / many
    longest = np.zeros(len(lines))
    np.maximum.at(longest, of, length)
    first = np.where(n > 0, kinds[ends - n - 1], CONTROL)
    last = np.where(n > 0, data[ends - 2], 10)
    columns = [
        *np.sqrt(np.maximum(ratio, 0)).T,
        *_steps(punctuation, 0.03, 0.06, 0.1, 0.2, 0.4),
        *_steps(ratio[:, UPPER], 0.1, 0.3, 0.6),
        *_steps(ratio[:, DIGIT], 0.1, 0.3),
        *_steps(words, 0, 2, 5, 12, 40),
        np.log1p(n) / 8,
        mean / 10,
        *_steps(mean, 3, 8, 12),
        *_steps(longest, 20, 40),
        repeated,
        *_steps(repeated, 0.1, 0.3, 0.6),
        marked,
        *_steps(marked, 0.2, 0.35, 0.6),
        np.isin(last, list(b".!?:;\"')")),
        first == UPPER,
        n == 0,
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each word, from running sums of bytes times powers."""
    powers = np.full(len(data) + 1, PRIME)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    # Shifting each word to the same power instead of dividing by its own.
    return (sums[stops] - sums[starts]) * powers[len(data) - starts]


def beside(features: np.ndarray) -> np.ndarray:
    """A document's lines with the features of the line before and the one after."""
    n, width = features.shape
    out = np.zeros((n, 3 * width + 3), dtype=np.float32)
    out[:, :width] = features
    out[1:, width : 2 * width] = features[:-1]
    out[:-1, 2 * width : 3 * width] = features[1:]
    out[0, -3] = out[-1, -2] = out[:, -1] = 1
    return out


def split_lines(text: str | None) -> list[bytes]:
    """The lines of a text in UTF-8; an empty text has one empty line."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    if all(len(line) <= LINE_BYTES for line in lines):
        return lines
    return [
        line[at : at + LINE_BYTES]
        for line in lines
        for at in range(0, max(1, len(line)), LINE_BYTES)
    ]


def described(texts: Iterator[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, line lengths) of each text; the lines of several are described together."""
    waiting: list[tuple[list[bytes], int]] = []
    held = 0
    for text in texts:
        lines = split_lines(text)
        size = sum(map(len, lines))
        if waiting and held + size > BYTES_AT_ONCE:
            yield from _described(waiting)
            waiting, held = [], 0
        waiting.append((lines, size))
        held += size
    yield from _described(waiting)


def _described(waiting: list[tuple[list[bytes], int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if not waiting:
        return
    if len(waiting) == 1:
        lines, parts, part, held = waiting[0][0], [], [], 0
        for line in lines:
            if part and held + len(line) > BYTES_AT_ONCE:
                parts.append(describe(part))
                part, held = [], 0
            part.append(line)
            held += len(line)
        features = np.concatenate([*parts, describe(part)])
    else:
        features = describe([line for lines, _ in waiting for line in lines])
    at = 0
    for lines, _ in waiting:
        part = features[at : at + len(lines)]
        at += len(lines)
        yield beside(part), np.fromiter(map(len, lines), dtype=np.float64, count=len(lines))


class Model(NamedTuple):
    """Weights of a good line's features against a bad one's, and of the label pairs."""

    weights: np.ndarray
    transitions: np.ndarray


class Chains(NamedTuple):
    """Chains by falling length: where each begins among the lines, and how many are so long."""

    starts: np.ndarray
    longer: np.ndarray  # by step: the number of chains with more lines than that

    @classmethod
    def of(cls, lengths: np.ndarray) -> Chains:
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        steps = int(lengths.max(initial=0))
        longer = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(steps), "right")
        return cls(starts, longer)


def forward_backward(
    scores: np.ndarray, transitions: np.ndarray, chains: Chains
) -> tuple[np.ndarray, np.ndarray]:
    """(probability of good by line, expected label pairs)."""
    high = np.maximum(scores, 0)
    potential = np.stack([np.exp(-high), np.exp(scores - high)], axis=1)
    pair = np.exp(transitions)
    forward = np.empty_like(potential)
    scale = np.empty(len(scores))
    for step, number in enumerate(chains.longer):
        at = chains.starts[:number] + step
        now = potential[at] if step == 0 else potential[at] * (forward[at - 1] @ pair)
        scale[at] = now.sum(axis=1)
        forward[at] = now / scale[at, None]
    backward = np.ones_like(potential)
    expected = np.zeros((2, 2))
    for step in range(len(chains.longer) - 1, 0, -1):
        at = chains.starts[: chains.longer[step]] + step
        after = potential[at] * backward[at] / scale[at, None]
        expected += pair * (forward[at - 1].T @ after)
        backward[at - 1] = after @ pair.T
    marginal = forward * backward
    marginal /= marginal.sum(axis=1, keepdims=True)
    return marginal[:, 1], expected


def fit(features: list[np.ndarray], labels: list[int]) -> Model:
    """Weights of most likelihood by Adam; a chain's lines all have its label."""
    if not features:
        return Model(np.zeros(1), np.zeros((2, 2)))
    rows = np.concatenate(features)
    lengths = np.array([len(x) for x in features])
    label = np.repeat(np.array(labels, dtype=np.float64), lengths)
    weight = np.repeat(1 / lengths, lengths)  # a document counts once, however many lines
    chains = Chains.of(lengths)
    inner = lengths - 1
    observed = np.diag([inner[np.array(labels) == y].sum() for y in (0, 1)]).astype(np.float64)
    w, t = np.zeros(rows.shape[1]), np.zeros((2, 2))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, t)]
    for step in range(1, STEPS + 1):
        scores = (rows @ w.astype(np.float32)).astype(np.float64)
        good, expected = forward_backward(scores, t, chains)
        wrong = ((label - good) * weight / len(features)).astype(np.float32)
        slopes = (
            wrong @ rows - DECAY * w,
            (observed - expected) / max(1, inner.sum()) - DECAY * t,
        )
        for value, slope, moment in zip((w, t), slopes, moments):
            moment[0] += 0.1 * (slope - moment[0])
            moment[1] += 0.001 * (slope**2 - moment[1])
            first = moment[0] / (1 - 0.9**step)
            value += RATE * first / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8)
    return Model(w, t)


def score(model: Model, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quality of each document from its lines' (features, lengths)."""
    if not documents:
        return np.zeros(0)
    if len(model.weights) == 1:
        return np.full(len(documents), 0.5)
    lengths = np.array([len(x) for x, _ in documents])
    chains = Chains.of(lengths)
    rows = np.concatenate([x for x, _ in documents])
    scores = (rows @ model.weights.astype(np.float32)).astype(np.float64)
    good, _ = forward_backward(scores, model.transitions, chains)
    weight = np.concatenate([size for _, size in documents])
    begin = np.cumsum(lengths) - lengths
    total = np.add.reduceat(weight, begin)
    weight = np.where(np.repeat(total, lengths) > 0, weight, 1.0)
    return np.add.reduceat(good * weight, begin) / np.add.reduceat(weight, begin)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> Model:
    """A model learned from labelled documents that are not held out.

    From at most FIT_DOCS of them, those with the smallest hashes, and of each at most
    FIT_CHAINS chains of FIT_LINES lines, evenly spread. Labels other than 0 and 1 and documents
    with both do not count. Without any label all scores will be 0.5.
    """
    order = F.xxhash64("doc_id", F.lit(SEED))
    known = (
        labels.select(
            F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).alias("target")
        )
        .where(F.col("target").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~folds.held_out("doc_id", FOLDS, HELD_OUT))
        .groupBy("doc_id")
        .agg(F.min("target").alias("target"), F.max("target").alias("most"))
        .where("target = most")
        .select("doc_id", F.col("target").cast("int").alias("target"))
    )
    some = folds.thinned(known, order, max(1, known.count()), FIT_DOCS)
    chosen = some.orderBy(F.pmod(order, F.lit(1 << 30)), order, "doc_id").limit(FIT_DOCS)

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (text.as_py() for text in batch.column(2))
            for n, (features, _) in enumerate(described(texts)):
                begins = np.arange(0, len(features), FIT_LINES)
                if len(begins) > FIT_CHAINS:
                    begins = begins[np.linspace(0, len(begins) - 1, FIT_CHAINS).astype(int)]
                parts = [features[b : b + FIT_LINES] for b in begins]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[n].as_py()] * len(parts), pa.int64()),
                        pa.array([batch.column(1)[n].as_py()] * len(parts), pa.int32()),
                        pa.array([len(part) for part in parts], pa.int32()),
                        pa.array([part.tobytes() for part in parts], pa.binary()),
                    ],
                    ["doc_id", "target", "lines", "features"],
                )

    sample = folds.sample_texts(docs, chosen, id_column, text_column)
    rows = sample.mapInArrow(
        chains, "doc_id long, target int, lines int, features binary"
    ).collect()
    rows.sort(key=lambda row: (row["doc_id"], row["lines"], bytes(row["features"])))
    return fit(
        [
            np.frombuffer(row["features"], dtype=np.float32).reshape(row["lines"], -1)
            for row in rows
        ],
        [row["target"] for row in rows],
    )


def classify(
    docs: DataFrame,
    model: Model,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: bool = False,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row, or all columns of the row first.

    score is the probability, from 0 to 1, that the document is good, predicted 1 from
    THRESHOLD on. Nothing but the text goes into a score. A null text counts as empty, and an
    empty one has a single empty line. Null ids are not held out. Repeated rows are scored each
    by itself. With `keep` the result is (row, score, predicted), `row` a struct of all columns,
    whatever their names. An empty table gives an empty result.

    Very long texts are read whole; a line of more than LINE_BYTES bytes stands for several
    lines, each with a place of its own in the chain, which its score depends on. A score of just
    THRESHOLD predicts 1.
    """
    columns = [F.col(text_column).alias("text")]
    if keep:
        columns.insert(0, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    else:
        doc_id = F.col(id_column).cast("long")
        columns.insert(0, doc_id.alias("doc_id"))
    narrow = docs.select(*columns)
    first = narrow.columns[0]

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            waiting, lines = [], 0
            for one in described(text.as_py() for text in batch.column(1)):
                waiting.append(one)
                lines += len(one[0])
                if lines >= 1 << 13:
                    found.append(score(model, waiting))
                    waiting, lines = [], 0
            found.append(score(model, waiting))
            value = np.clip(np.concatenate(found), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(value),
                    pa.array((value >= THRESHOLD).astype(np.int32)),
                ],
                [first, "score", "predicted"],
            )

    kind = narrow.schema[first].dataType.simpleString()
    scored = narrow.mapInArrow(scores, f"{first} {kind}, score double, predicted int")
    if keep:
        return scored
    return scored.select(
        "doc_id", folds.held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", "predicted"
    )


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model learned from `labels` (doc_id, quality)."""
    return classify(docs, train(docs, labels))
