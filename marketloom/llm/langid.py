"""Language identification by a bidirectional gated recurrent network over bytes.

One network reads a stretch of a text's UTF-8 bytes forwards, one backwards. From both states
every position gets a probability for each language, and a document's probabilities are the mean
over all its positions. The network is trained here, by backpropagation through time in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm import folds
from marketloom.llm.common import salted_join

FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
HIDDEN = 10
#: Bytes of a stretch, and stretches that are read side by side.
STRETCH, SIDE_BY_SIDE = 128, 4096
#: Documents of each language and in all to learn from, stretches of each and their bytes, at most.
FIT_PER_LANGUAGE, FIT_DOCS, FIT_STRETCHES, FIT_BYTES = 300, 6000, 6, 64
STEPS, BATCH, RATE = 250, 256, 0.02
SEED = 5


class Direction(NamedTuple):
    """Gates reset, update and candidate, one below the other: from a byte and from the state."""

    of_byte: np.ndarray  # (3 * hidden, 256)
    of_state: np.ndarray  # (3 * hidden, hidden)


class Model(NamedTuple):
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # (languages, 2 * hidden + 1), the last column is the bias


def start(languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Model:
    random = np.random.default_rng(seed)

    def direction() -> Direction:
        return Direction(
            random.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32),
            random.normal(0, 0.3, (3 * hidden, hidden)).astype(np.float32),
        )

    out = random.normal(0, 0.3, (len(languages), 2 * hidden + 1)).astype(np.float32)
    return Model(languages, direction(), direction(), out)


def _step(net: Direction, byte: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """One position: the new state, and the gates it was made with."""
    hidden = len(state)
    gates = np.take(net.of_byte, byte, axis=1)
    from_state = net.of_state @ state
    both = gates[: 2 * hidden]
    both += from_state[: 2 * hidden]
    both *= 0.5
    np.tanh(both, out=both)
    both += 1
    both *= 0.5  # the logistic function
    reset, update = both[:hidden], both[hidden:]
    candidate = gates[2 * hidden :]
    candidate += reset * from_state[2 * hidden :]
    np.tanh(candidate, out=candidate)
    return candidate + update * (state - candidate), reset, update, candidate, from_state


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores -= scores.max(axis=0)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=0)
    return scores


def read(model: Model, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Summed probabilities (languages, stretches) over the positions of each stretch.

    `data` has positions by stretches, the longest stretch first; both directions take the
    stretches that are long enough at each position.
    """
    hidden = model.forward.of_state.shape[1]
    steps = int(lengths.max(initial=0))
    reach = len(lengths) - np.searchsorted(lengths[::-1], np.arange(steps), side="right")
    states = []
    state = np.zeros((hidden, len(lengths)), dtype=np.float32)
    for position in range(steps):
        now = data[position, : reach[position]]
        state = _step(model.forward, now, state[:, : reach[position]])[0]
        states.append(state)
    total = np.zeros((len(model.languages), len(lengths)))
    state = np.zeros((hidden, 0), dtype=np.float32)
    ahead, back, bias = model.out[:, :hidden], model.out[:, hidden:-1], model.out[:, -1:]
    for position in range(steps - 1, -1, -1):
        wide = np.zeros((hidden, reach[position]), dtype=np.float32)
        wide[:, : state.shape[1]] = state
        state = _step(model.backward, data[position, : reach[position]], wide)[0]
        scores = ahead @ states.pop() + back @ state + bias
        total[:, : reach[position]] += _softmax(scores)
    return total


def _slopes(model: Model, data: np.ndarray, target: np.ndarray) -> Model:
    """Slopes of the mean cross-entropy over all positions, by backpropagation through time."""
    steps, number = data.shape
    hidden = model.forward.of_state.shape[1]
    order = {"forward": range(steps), "backward": range(steps - 1, -1, -1)}
    kept: dict[str, dict] = {}
    for name, positions in order.items():
        state, kept[name] = np.zeros((hidden, number), dtype=np.float32), {}
        for position in positions:
            before = state
            state, *gates = _step(getattr(model, name), data[position], state)
            kept[name][position] = (before, state, *gates)
    out = np.zeros_like(model.out)
    into = {name: {} for name in order}
    for position in range(steps):
        seen = np.concatenate(
            [kept["forward"][position][1], kept["backward"][position][1], np.ones((1, number))]
        ).astype(np.float32)
        wrong = _softmax(model.out @ seen)
        wrong[target, np.arange(number)] -= 1
        wrong /= steps * number
        out += wrong @ seen.T
        back = model.out[:, :-1].T @ wrong
        into["forward"][position], into["backward"][position] = back[:hidden], back[hidden:]
    found = {}
    for name, positions in order.items():
        net = getattr(model, name)
        of_byte, of_state = np.zeros_like(net.of_byte), np.zeros_like(net.of_state)
        carried = np.zeros((hidden, number), dtype=np.float32)
        for position in reversed(positions):
            before, _, reset, update, candidate, from_state = kept[name][position]
            slope = into[name][position] + carried
            to_candidate = slope * (1 - update) * (1 - candidate**2)
            to_update = slope * (before - candidate) * update * (1 - update)
            to_reset = to_candidate * from_state[2 * hidden :] * reset * (1 - reset)
            gates = np.concatenate([to_reset, to_update, to_candidate])
            inner = np.concatenate([to_reset, to_update, to_candidate * reset])
            of_state += inner @ before.T
            np.add.at(of_byte.T, data[position], gates.T)
            carried = slope * update + net.of_state.T @ inner
        found[name] = Direction(of_byte, of_state)
    return Model(model.languages, found["forward"], found["backward"], out)


def fit(languages: list[str], stretches: np.ndarray, targets: np.ndarray) -> Model:
    """A model from stretches of equal length (stretch by position), by Adam."""
    model = start(languages)
    random = np.random.default_rng(SEED)
    values = [*model.forward, *model.backward, model.out]
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in values]
    for step in range(1, STEPS + 1):
        some = random.integers(0, len(stretches), BATCH)
        found = _slopes(model, stretches[some].T, targets[some])
        for value, slope, moment in zip(
            values, [*found.forward, *found.backward, found.out], moments
        ):
            moment[0][:] += 0.1 * (slope - moment[0])
            moment[1][:] += 0.001 * (slope**2 - moment[1])
            first = moment[0] / (1 - 0.9**step)
            value -= RATE * first / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8)
    return model


def pooled(model: Model, texts: list[bytes]) -> np.ndarray:
    """Probabilities (languages, texts), the mean over all positions of each text."""
    total = np.zeros((len(model.languages), len(texts)))
    stretches: list[bytes] = []
    owners: list[int] = []

    def flush() -> None:
        lengths = np.fromiter(map(len, stretches), dtype=np.int64, count=len(stretches))
        order = np.argsort(-lengths, kind="stable")
        data = np.zeros((len(stretches), STRETCH), dtype=np.uint8)
        whole = np.frombuffer(b"".join(stretches), dtype=np.uint8)
        data[np.arange(STRETCH) < lengths[:, None]] = whole
        found = read(model, np.ascontiguousarray(data[order].T).astype(np.intp), lengths[order])
        np.add.at(total.T, np.array(owners)[order], found.T)
        stretches.clear()
        owners.clear()

    for n, text in enumerate(texts):
        for at in range(0, len(text), STRETCH):
            stretches.append(text[at : at + STRETCH])
            owners.append(n)
            if len(stretches) == SIDE_BY_SIDE:
                flush()
    if stretches:
        flush()
    sums = total.sum(axis=0)
    return total / np.where(sums > 0, sums, 1)


def train(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> Model | None:
    """A model learned from documents with a language that are not held out; None without any.

    From at most FIT_PER_LANGUAGE documents of each language and FIT_DOCS in all, those with the
    smallest hashes, and of each at most FIT_STRETCHES stretches of FIT_BYTES bytes.
    """
    order = F.xxhash64("doc_id", F.lit(SEED))
    known = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(lang_column).alias("target")
    ).where(
        F.col("doc_id").isNotNull()
        & F.col("target").isNotNull()
        & ~folds.held_out("doc_id", FOLDS, HELD_OUT)
    )
    totals = known.groupBy("target").agg(F.count("*").alias("total"))
    some = folds.thinned(
        salted_join(known, totals, ["target"], ["doc_id"]),
        order,
        F.col("total"),
        FIT_PER_LANGUAGE,
    )
    steps = F.pmod(order, F.lit(1 << 30))
    rank = F.row_number().over(Window.partitionBy("target").orderBy(steps, order, "doc_id"))
    chosen = (
        some.select("doc_id", "target", rank.alias("rank"))
        .where(F.col("rank") <= FIT_PER_LANGUAGE)
        .orderBy("rank", order, "doc_id", "target")
        .limit(FIT_DOCS)
        .select("doc_id", "target")
        .distinct()
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            targets, parts = [], []
            for target, text in zip(batch.column(1).to_pylist(), batch.column(2)):
                data = text.as_py().encode("utf-8", "surrogatepass")
                begins = range(0, max(1, len(data) - FIT_BYTES + 1), FIT_BYTES)
                places = np.linspace(0, len(begins) - 1, min(len(begins), FIT_STRETCHES))
                for place in places.astype(int):
                    part = data[begins[place] : begins[place] + FIT_BYTES]
                    if part:
                        targets.append(target)
                        parts.append((part * FIT_BYTES)[:FIT_BYTES])  # a short one is repeated
            yield pa.RecordBatch.from_arrays(
                [pa.array(targets, pa.string()), pa.array(parts, pa.binary())], ["target", "part"]
            )

    sample = folds.sample_texts(docs, chosen, id_column, text_column)
    rows = sample.mapInArrow(cut, "target string, part binary").collect()
    if not rows:
        return None
    rows = sorted((row["target"], bytes(row["part"])) for row in rows)
    languages = sorted({target for target, _ in rows})
    number = {language: n for n, language in enumerate(languages)}
    data = np.frombuffer(b"".join(part for _, part in rows), dtype=np.uint8)
    return fit(
        languages,
        data.reshape(-1, FIT_BYTES).astype(np.intp),
        np.array([number[target] for target, _ in rows]),
    )


def predict(
    docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row.

    score is the pooled probability of lang_pred. Texts without a letter (null, empty, numbers)
    and all texts without a model are `und` with score 0. Nothing but the text goes into a
    prediction. Null ids are not held out, and repeated rows are predicted each by itself. Other
    columns are not read. An empty table gives an empty result.

    Very long texts are read whole, in stretches, whose probabilities are pooled. Of languages
    with equal probabilities the first in the model's order is predicted.
    """
    narrow = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for texts in _portions(batch.column(1)):
                lettered = [any(map(str.isalpha, text)) for text in texts]
                if model is None or not any(lettered):
                    names += [UNKNOWN] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                found = pooled(
                    model,
                    [
                        text.encode("utf-8", "surrogatepass") if has else b""
                        for text, has in zip(texts, lettered)
                    ],
                )
                best = found.argmax(axis=0)
                for n, has in enumerate(lettered):
                    names.append(model.languages[best[n]] if has else UNKNOWN)
                    scores.append(min(1.0, float(found[best[n], n])) if has else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    found = narrow.mapInArrow(label, "doc_id long, lang_pred string, score double")
    return found.select(
        "doc_id", folds.held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score"
    )


def _portions(column: pa.Array) -> Iterator[list[str]]:
    """Texts, about as many characters at a time as are read side by side."""
    texts, held = [], 0
    for text in column:
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= 4 * SIDE_BY_SIDE * STRETCH:
            yield texts
            texts, held = [], 0
    if texts:
        yield texts


def identify(docs: DataFrame) -> DataFrame:
    """Languages of all documents by a model learned from those that are not held out."""
    return predict(docs, train(docs))
