import hashlib
import random
from collections import Counter

import pytest
from corpora import AWKWARD, documents, with_clashes
from pyspark.sql import functions as F

from marketloom.llm import lines

UPPER = {c: c + 32 for c in range(65, 91)}


def slow(texts, least_docs, least_chars):
    split = [(text or "").split("\n") for text in texts]
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(UPPER) for line in doc] for doc in split]
    docs = Counter(key for doc in keys for key in set(doc))
    for doc, names in zip(split, keys):
        kept = [
            line
            for line, key in zip(doc, names)
            if len(key) < least_chars or docs[key] < least_docs
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        yield len(doc), len(doc) - len(kept), digest


def check(spark, rows, least_docs=10, least_chars=1, **options):
    found = lines.drop_common_lines(
        with_clashes(documents(spark, rows)),
        least_docs=least_docs,
        least_chars=least_chars,
        keep_text=True,
        **options,
    ).collect()
    for row in found:
        assert hashlib.sha256(row["kept"].encode()).hexdigest() == row["kept_sha256"]
    want = slow([row[1] for row in rows], least_docs, least_chars)
    assert sorted((str(r[0]), *r[1:4]) for r in found) == sorted(
        (str(row[0]), *result) for row, result in zip(rows, want)
    )
    return found


def corpus(seed, n=120):
    rng = random.Random(seed)
    shared = [f"{rng.choice(['Shared', 'ÉTÉ', 'x'])} line {i}" for i in range(12)] + ["", "  ", "a"]
    rows = []
    for i in range(n):
        doc = []
        for _ in range(rng.randrange(7)):
            line = rng.choice(shared) if rng.random() < 0.5 else f"own {rng.randrange(10**6)}"
            pad = rng.choice(["", " ", "\t", "\r", "\x0b", "\xa0", "\x1f"])
            doc.append(pad + (line.upper() if rng.random() < 0.3 else line) + rng.choice(["", pad]))
        rows.append((i if rng.random() < 0.9 else None, "\n".join(doc)))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (7, 3)])
def test_random_documents(spark, seed, batches, fanout):
    found = check(spark, corpus(seed), 10, 1, batches=batches, fanout=fanout)
    assert any(row["n_dropped"] for row in found)


@pytest.mark.parametrize("least_docs, least_chars", [(1, 0), (2, 3), (3, 0), (1000, 1)])
def test_other_limits(spark, least_docs, least_chars):
    check(spark, corpus(9, 40), least_docs, least_chars)


def test_lookups_beyond_a_broadcast(spark, monkeypatch):
    """Dropped lines and rows are found by joins that spread hot lines and hot rows."""
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    hot = [(i, f"hot\n{i}\nhot") for i in range(60)] + [(None, "copy\nhot")] * 60
    check(spark, corpus(5) + hot)


def test_awkward_documents(spark):
    check(spark, AWKWARD * 2, 3)
    check(spark, [(1, "same\n" * 20_000), (2, "same"), (3, "x" * 300_000 + "\nSAME ")], 3)


def test_just_enough_documents(spark):
    rows = [(i, "nine\nten" if i < 9 else "ten") for i in range(10)]
    assert {r["doc_id"]: r["n_dropped"] for r in check(spark, rows)} == {i: 1 for i in range(10)}


def test_empty_table(spark):
    assert check(spark, []) == []


def test_runs_are_sorted_and_levelled(spark):
    """What many batches hold is settled early, and few runs stay open."""
    runs = lines.LineRuns(spark, settled_at=3, fanout=2)
    for n in range(7):
        keys = ["every", f"own{n}", f"pair{n // 2}", "twice" if n in (1, 4) else "odd"]
        runs.add(spark.createDataFrame([(k.encode(),) for k in keys], "key binary"))
    assert [len(level) for level in runs.open] == [1, 1, 1]
    for run in [run for level in runs.open for run in level]:
        files = run.groupBy(F.input_file_name()).agg(F.collect_list("key").alias("keys"))
        keys = [row["keys"] for row in files.collect()]
        assert all(each == sorted(each) for each in keys)
        keys = sum(keys, [])
        assert len(keys) == len(set(map(bytes, keys))) and b"every" not in keys
    assert {bytes(row["key"]) for row in runs.settled().collect()} == {b"every", b"odd"}
