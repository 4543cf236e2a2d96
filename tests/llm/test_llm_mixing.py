import random
from collections import defaultdict
from fractions import Fraction
from hashlib import md5

import pytest
from corpora import AWKWARD, documents, with_clashes
from pyspark.sql import functions as F

from marketloom.llm import mixing

WEIGHTS = {"domain": {"a": 3, "b": 1}, "lang": {"en": 4}, "source": {"s1": 2}}


def share(budget, nodes):
    """Budgets of siblings {name: (capacity, weight)}, filling one after the other."""
    out, open_ = {}, dict(nodes)
    left = budget
    while open_:
        total = sum(w for _, w in open_.values())
        name = min(open_, key=lambda n: (Fraction(open_[n][0], open_[n][1]), n))
        capacity, weight = open_[name]
        if capacity * total > left * weight:
            break
        out[name] = capacity
        left -= capacity
        del open_[name]
    total = sum(w for _, w in open_.values())
    return out | {name: left * w // total for name, (_, w) in open_.items()}


def slow_budgets(leaves, percent, epochs, weights=WEIGHTS):
    leaves = {leaf: n for leaf, n in leaves.items() if n}
    grants = {(): sum(leaves.values()) * percent // 100}
    for depth, level in enumerate(mixing.LEVELS):
        capacity = defaultdict(int)
        for leaf, tokens in leaves.items():
            capacity[leaf[: depth + 1]] += tokens * epochs
        for parent in [g for g in grants if len(g) == depth]:
            nodes = {
                n: (c, weights[level].get(n[-1], 1)) for n, c in capacity.items() if n[:-1] == parent
            }
            grants |= share(grants[parent], nodes)
    return {leaf: (grants[leaf] // n, grants[leaf] % n) for leaf, n in leaves.items()}


@pytest.mark.parametrize("seed", range(6))
def test_budgets(spark, seed):
    rng = random.Random(seed)
    leaves = {
        (d, x, s): rng.choice([0, 1, 7, 100, 10**6, 10**15])
        for d in "ab"
        for x in ("en", "de")
        for s in ("s1", "s2", "s3")
    }
    percent = rng.choice([10, 60, 100, 250, 500])
    rows = [(*leaf, n) for leaf, n in leaves.items()]
    table = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    found = mixing.budgets(table, WEIGHTS, percent, 4).collect()
    got = {tuple(r[:3]): (r["epochs"], r["prefix"]) for r in found}
    assert got == slow_budgets(leaves, percent, 4)


def slow_mix(rows, percent, epochs, weights=WEIGHTS, seed=mixing.SEED):
    """rows: (doc_id, leaf, tokens); how often each document is in the mix."""
    leaves = defaultdict(int)
    for _, leaf, tokens in rows:
        leaves[leaf] += tokens
    out = []
    for leaf, (whole, prefix) in slow_budgets(leaves, percent, epochs, weights).items():
        def order(row, epoch=whole + 1):
            key = f"{seed}:{epoch}" + ("" if row[0] is None else f":{row[0]}")
            return md5(key.encode()).hexdigest(), row[0] is not None, row[0] or 0, row[2]

        so_far = 0
        for row in sorted((r for r in rows if r[1] == leaf), key=order):
            so_far += row[2]
            copies = whole + (so_far <= prefix)
            if copies:
                out.append((str(row[0]), *leaf, row[2], copies))
    return sorted(out)


@pytest.mark.parametrize("percent", [30, 200])
def test_documents_of_the_mix(spark, percent):
    rng = random.Random(percent)
    rows = [
        (i, " ".join(["w"] * rng.randrange(12)), rng.choice(["en", "de"]), f"s{rng.randrange(3)}", 0)
        for i in range(300)
    ]
    docs = documents(spark, rows)
    found = mixing.mix(docs, F.lit("a"), WEIGHTS, percent)
    want = slow_mix([(r[0], ("a", r[2], r[3]), len(r[1].split())) for r in rows], percent, 4)
    names = ["doc_id", *mixing.LEVELS, "n_tokens", "copies"]
    assert sorted((str(r[0]), *r[1:]) for r in found.select(*names).collect()) == want


def test_awkward_documents(spark):
    docs = with_clashes(documents(spark, AWKWARD))
    found = mixing.mix(docs, F.col("source"), WEIGHTS, 100, keep=True).collect()
    none = mixing.MISSING
    rows = [
        (r[0], (r[3] or none, r[2] or none, r[3] or none), len((r[1] or "").split()))
        for r in AWKWARD
    ]
    want = slow_mix(rows, 100, mixing.MAX_EPOCHS)
    assert sorted((str(r[0]), *r[1:5], r["copies"]) for r in found) == want
    for row in found:
        assert row["row"]["doc_id"] == row["doc_id"] and row["row"]["copies"] == "x"


def test_empty_table(spark):
    assert mixing.mix(documents(spark, []), F.lit("a"), WEIGHTS, 50).collect() == []
