import itertools
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from corpora import AWKWARD, documents, with_clashes

from pyspark.sql import functions as F

from marketloom.llm import folds, langid, quality
from marketloom.llm.queries import queries

SF_DIR = "/root/testdata/sf0.1"


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 4, 3])
    scores, pair = rng.normal(size=8) * 3, rng.normal(size=(2, 2))
    good, expected = quality.forward_backward(scores, pair, quality.Chains.of(lengths))
    want, edges, at = [], np.zeros((2, 2)), 0
    for n in lengths:
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            total = sum(s for s, y in zip(scores[at : at + n], labels) if y)
            weights[labels] = np.exp(total + sum(pair[a, b] for a, b in zip(labels, labels[1:])))
        z = sum(weights.values())
        want += [sum(w for y, w in weights.items() if y[i]) / z for i in range(n)]
        for labels, w in weights.items():
            for a, b in zip(labels, labels[1:]):
                edges[a, b] += w / z
        at += n
    assert np.allclose(good, want) and np.allclose(expected, edges)


def test_lines_are_described_alike_alone_and_together(monkeypatch):
    rng = random.Random(1)
    lines = [
        "".join(rng.choices("ab A1.!é| ", k=rng.randrange(40))).encode() for _ in range(60)
    ]
    together = quality.describe(lines)
    assert np.allclose(together, np.concatenate([quality.describe([line]) for line in lines]), atol=1e-6)
    text = b"\n".join(lines).decode()
    (whole, sizes), = quality.described(iter([text]))
    monkeypatch.setattr(quality, "BYTES_AT_ONCE", 100)
    (parts, _), = quality.described(iter([text]))
    assert np.allclose(whole, parts) and sizes.tolist() == [len(line) for line in lines]


def test_repeated_words_count():
    same, other = quality.describe([b"go go go go", b"go on to be"])
    changed = np.nonzero(same != other)[0]
    assert len(changed) >= 3


def test_long_lines_are_wrapped():
    line = "x" * (2 * quality.LINE_BYTES + 5)
    assert [len(x) for x in quality.split_lines(f"a\n\n{line}")] == [
        1, 0, quality.LINE_BYTES, quality.LINE_BYTES, 5,
    ]
    assert quality.split_lines("") == quality.split_lines(None) == [b""]


def test_quality_of_held_out_documents(spark):
    found = queries()["op9_quality"](spark, SF_DIR).toPandas()
    labels = pq.read_table(f"{SF_DIR}/labels.parquet").to_pandas()
    assert len(found) == pq.read_metadata(f"{SF_DIR}/documents.parquet").num_rows
    assert [fold(i, 5) == 0 for i in found.doc_id] == found.held_out.tolist()
    assert found.score.between(0, 1).all()
    assert ((found.score >= 0.3) == (found.predicted == 1)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.predicted == 1).mean() > 0.98 and (bad.predicted == 0).mean() > 0.9


def labelled(spark):
    good = "This is a clean line of prose, and another one.\nIt goes on like this for a while."
    bad = "BUY!!! NOW!!! $$$\n### ### ###"
    rows = [(i, good if i % 2 else bad) for i in range(100, 160)]
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(100, 160)] + [(None, 1, 0), (7, None, 0), (8, 5, 0), (101, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    return rows, labels


def test_quality_of_awkward_documents(spark):
    rows, labels = labelled(spark)
    docs = with_clashes(documents(spark, [*AWKWARD, *rows]))
    found = quality.quality(docs, labels).collect()
    assert len(found) == len(AWKWARD) + len(rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert {r["held_out"] for r in found if r["doc_id"] is None} == {False}
    by_id = {r["doc_id"]: r["predicted"] for r in found}
    assert all(by_id[i] == i % 2 for i, _ in rows)
    texts = {r["doc_id"]: r["score"] for r in found}
    assert texts[0] == texts[1]  # a null text counts as an empty one


def test_samples_are_thinned_before_they_are_put_in_order(spark):
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"))
    order = F.xxhash64("doc_id")
    some = folds.thinned(rows, order, 40_000, 100)
    assert 400 < some.count() < 600
    assert folds.thinned(rows, order, 40_000, 8000).count() == 40_000
    first = [F.pmod(order, F.lit(1 << 30)), order]
    want = [r[0] for r in rows.orderBy(*first).limit(100).collect()]
    assert [r[0] for r in some.orderBy(*first).limit(100).collect()] == want


def test_quality_without_labels_and_without_documents(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(1, "a"), (2, None)])
    assert {r["score"] for r in quality.quality(docs, labels).collect()} == {0.5}
    assert quality.quality(documents(spark, []), labelled(spark)[1]).collect() == []


def loss(model, data, target):
    steps, number = data.shape
    hidden = model.forward.of_state.shape[1]
    ahead, state = [], np.zeros((hidden, number))
    for position in range(steps):
        state = langid._step(model.forward, data[position], state)[0]
        ahead.append(state)
    total, state = 0.0, np.zeros((hidden, number))
    for position in reversed(range(steps)):
        state = langid._step(model.backward, data[position], state)[0]
        seen = np.concatenate([ahead[position], state, np.ones((1, number))])
        total -= np.log(langid._softmax(model.out @ seen)[target, np.arange(number)]).sum()
    return total / (steps * number)


def doubles(model):
    nets = [langid.Direction(*(x.astype(float) for x in net)) for net in model[1:3]]
    return langid.Model(model.languages, *nets, model.out.astype(float))


def test_slopes_of_the_network():
    rng = np.random.default_rng(3)
    model = doubles(langid.start(["a", "b", "c"], hidden=4))
    data, target = rng.integers(0, 256, (6, 5)), rng.integers(0, 3, 5)
    found = langid._slopes(model, data, target)
    pairs = [*zip(model.forward, found.forward), *zip(model.backward, found.backward)]
    for value, slope in [*pairs, (model.out, found.out)]:
        for place in np.argsort(-np.abs(slope).ravel())[:4]:
            at = np.unravel_index(place, slope.shape)
            before = value[at]
            value[at] = before + 1e-5
            high = loss(model, data, target)
            value[at] = before - 1e-5
            low = loss(model, data, target)
            value[at] = before
            assert abs((high - low) / 2e-5 - slope[at]) < 1e-6


def test_stretches_side_by_side_read_as_alone(monkeypatch):
    rng = np.random.default_rng(5)
    model = langid.start(["a", "b"], hidden=4)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 5, 128, 129, 700, 3)]
    together = langid.pooled(model, texts)
    monkeypatch.setattr(langid, "SIDE_BY_SIDE", 2)
    assert np.allclose(together, langid.pooled(model, texts), atol=1e-6)
    alone = np.concatenate([langid.pooled(model, [text]) for text in texts], axis=1)
    assert np.allclose(together, alone, atol=1e-6)


def test_language_of_held_out_documents(spark):
    found = queries()["op10_langid"](spark, SF_DIR).toPandas()
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pandas()
    assert len(found) == len(docs) and found.score.between(0, 1).all()
    assert [fold(i, 3) == 1 for i in found.doc_id] == found.held_out.tolist()
    held = found[found.held_out].merge(docs, on="doc_id")
    assert (held.lang_pred == held.lang).mean() > 0.97


def test_language_of_awkward_documents(spark):
    rows = [(i, "the and of " * 9, "en", "s", 1) for i in range(100, 130)]
    rows += [(i, "ñoño él qué " * 9, "es", "s", 1) for i in range(130, 160)]
    docs = with_clashes(documents(spark, [*AWKWARD, *rows]))
    found = langid.identify(docs).collect()
    assert len(found) == len(AWKWARD) + len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for row in AWKWARD:
        got = by_id[row[0]]
        if not any(map(str.isalpha, row[1] or "")):
            assert (got["lang_pred"], got["score"]) == ("und", 0.0)
        else:
            assert got["lang_pred"] in {"en", "es", "de", "fr"} and 0 < got["score"] <= 1
    assert by_id[None]["held_out"] is False
    assert all(by_id[i]["lang_pred"] == lang for i, _, lang, _, _ in rows)


@pytest.mark.parametrize("rows", [[], [(1, "a text", None, "s", 1), (2, None, "en", "s", 1)]])
def test_language_without_anything_to_learn(spark, rows):
    found = langid.identify(documents(spark, rows)).collect()
    assert [(r["doc_id"], r["lang_pred"], r["score"]) for r in found] == [
        (row[0], "und", 0.0) for row in rows
    ]
