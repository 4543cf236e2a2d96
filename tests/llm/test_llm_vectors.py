import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import ann, neardup, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, size string, x string, rank string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", "x", "x", "x") for row in rows], SCHEMA)


def fine(v):
    return (
        v is not None
        and all(x is not None and math.isfinite(x) for x in v)
        and any(x != 0 for x in v)
    )


def padded(rows, width):
    return np.array([list(v) + [0.0] * (width - len(v)) for v in rows], np.float32).astype(float)


def slow_links(rows, threshold):
    width = max((len(v) for _, v, _ in rows if v), default=0)
    linked = {n: set() for n in range(len(rows))}
    good = [n for n, (i, v, lab) in enumerate(rows) if fine(v) and lab is not None and i is not None]
    if good:
        m = padded([rows[n][1] for n in good], width)
        m /= np.sqrt((m * m).sum(axis=1))[:, None]
        near = m @ m.T >= threshold
        for a, b in zip(*np.nonzero(near)):
            if a != b and rows[good[a]][2] == rows[good[b]][2]:
                linked[good[a]].add(good[b])
    for n, (i, _, _) in enumerate(rows):
        reach, todo = {n}, [n]
        while todo:
            at = todo.pop()
            same = {m for m in good if at in good and rows[m][0] == rows[at][0]}
            for m in (linked[at] | same) - reach:
                reach.add(m)
                todo.append(m)
        least = min((rows[m][0] for m in reach if rows[m][0] is not None), default=None)
        yield i, len(linked[n]), least, least is not None and i == least


AWKWARD = [
    (1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [1.0, float("nan")], 1),
    (5, [float("inf"), 1.0], 1), (6, [], 1), (7, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
    (8, [1.0, 1.0], 1), (9, [2.0, 2.0], 1), (10, [1.0, 1.0, 0.0], 1), (11, [1.0, 1.0], 2),
    (8, [1.0, 1.0], 1), (12, [-1.0, -1.0], 1), (13, [3e38, 3e38], 1), (14, [1e-38, 1e-38], 1),
    (15, [0.0, -0.0, 5.0], 1), (16, [-0.0, 0.0, 5.0], 1),
]


@pytest.mark.parametrize("tile", [2048, 7])
def test_clusters(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE", tile)
    rng = np.random.default_rng(1)
    rows = []
    for label in (1, 2):
        centres = rng.standard_normal((12, 24))
        for n in range(180):
            noise = rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.14, 0.2])
            rows.append((len(rows), (centres[n % 12] + noise).tolist(), label))
    found = neardup.near_duplicates(table(spark, rows)).collect()
    assert sorted(map(tuple, found)) == sorted(slow_links(rows, 0.98))
    assert sum(row["n_links"] for row in found) > 100


def test_awkward_vectors(spark):
    found = neardup.near_duplicates(table(spark, AWKWARD)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, slow_links(AWKWARD, 0.98)))


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (None, [1.0], 1)]])
def test_nothing_to_compare(spark, rows):
    found = neardup.near_duplicates(table(spark, rows)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, slow_links(rows, 0.98)))
    assert ann.nearest(table(spark, rows), F.lit(True)).collect() == []


def test_pairs_stop_early_but_none_is_lost():
    rng = np.random.default_rng(4)
    base = rng.standard_normal((50, 40))
    rows = np.repeat(base, 4, axis=0) + rng.standard_normal((200, 40)) * 0.12
    axes = neardup.principal_axes(rows.T @ rows)
    got = {
        (int(i), int(j))
        for a, b in neardup.linked_pairs(rows, rows, axes, 0.98, True)
        for i, j in zip(a, b)
    }
    cosine = vectors.unit(rows) @ vectors.unit(rows).T
    assert got == {(i, j) for i, j in zip(*np.nonzero(cosine >= 0.98)) if i < j}


def slow_nearest(rows, k):
    width = max(len(v) for _, v, _ in rows if v)
    good = [(i, v) for i, v, _ in rows if i is not None and fine(v)]
    ids, m = [i for i, _ in good], padded([v for _, v in good], width)
    seen = set()
    for q, query in zip(ids, m):
        if q % 20 or (q, tuple(query)) in seen:
            continue
        seen.add((q, tuple(query)))
        scores = vectors.dot(m, np.broadcast_to(query, m.shape))
        order = sorted((-s, i) for s, i in zip(scores, ids) if i != q)
        yield from ((q, rank, i, -s) for rank, (s, i) in enumerate(order[:k], start=1))


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    rng = np.random.default_rng(2)
    rows = [(n, v.tolist(), 1) for n, v in enumerate(rng.standard_normal((900, 48)))]
    rows += [(1000 + n, rows[n % 7][1], 1) for n in range(60)]  # ties
    found = ann.nearest(table(spark, rows), F.expr("vec_id % 20 = 0"))
    got = {tuple(r) for r in found.collect()}
    want = set(slow_nearest(rows, ann.K))
    assert len(got) == len(want) and len(got & want) >= 0.99 * len(want)


def test_very_large_components_do_not_hide_neighbours(spark):
    rng = np.random.default_rng(9)
    rows = [(n, v.tolist(), 1) for n, v in enumerate(rng.standard_normal((400, 8)))]
    rows += [(1001, [3e38] * 8, 1), (1002, [-3e38] * 8, 1)]
    found = ann.nearest(table(spark, rows), F.expr("vec_id % 20 = 0"))
    assert {tuple(r) for r in found.collect()} == set(slow_nearest(rows, ann.K))


def test_few_and_awkward_candidates(spark):
    rows = [(n if n is None or n != 8 else 20, v, lab) for n, v, lab in AWKWARD] + [(40, [1.0], 1)]
    found = ann.nearest(table(spark, rows), F.expr("vec_id % 20 = 0")).collect()
    assert sorted(map(tuple, found)) == sorted(slow_nearest(rows, ann.K))


def test_error_bounds_hold():
    rng = np.random.default_rng(6)
    rows = rng.standard_normal((3000, 64)) + 0.3
    centre, turn = rows.mean(axis=0), ann.rotation(64)
    queries = rng.standard_normal((50, 64))
    inner, wide, spread = ann.estimate(queries, centre, turn, *ann.encode(rows, centre, turn))
    off = np.abs(inner - queries @ rows.T) > wide[:, None] * spread[None, :]
    assert off.mean() < 2e-3
    assert np.abs(turn @ turn.T - np.eye(64)).max() < 1e-9


@pytest.mark.parametrize("size", [1, 8, 13, 64])
def test_estimates_from_packed_bits(size):
    rng = np.random.default_rng(size)
    rows, queries = rng.standard_normal((300, size)), rng.standard_normal((9, size))
    centre, turn = rows.mean(axis=0), ann.rotation(size)
    codes, length, along = ann.encode(rows, centre, turn)
    inner, _, _ = ann.estimate(queries, centre, turn, codes, length, along)
    for q, query in enumerate(queries):
        for r in range(0, 300, 29):
            towards = (rows[r] - centre) @ turn
            product = sum(x if t > 0 else -x for x, t in zip(query @ turn, towards))
            want = product * length[r] / (along[r] * size**0.5) + query @ centre
            assert abs(inner[q, r] - want) < 1e-4


def test_vectors_at_the_centroid_are_exact():
    rows = np.ones((5, 8))
    index = ann.encode(rows, rows[0], ann.rotation(8))
    inner, _, _ = ann.estimate(np.ones((2, 8)), rows[0], ann.rotation(8), *index)
    assert np.allclose(inner, 8)
