import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from corpora import AWKWARD, documents, with_clashes

from marketloom.llm import runs

SF_DIR = "/root/testdata/sf0.01"


def slow_runs(words, least=12):
    """Every maximal stretch of every period, the smallest period of each stretch."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, 2 * q):
                found.setdefault((start, length), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def slow_words(text, doc_id):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            n = len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def slow(doc_id, text):
    words = slow_words(text, doc_id)
    found = sorted(slow_runs(words), key=lambda r: (r[0], r[2]))
    kept = [
        w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)
    ]
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (
        doc_id, len(found), *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(" ".join(kept).encode()).hexdigest(),
    )


def key(row):
    return tuple(str(value) for value in row)


@pytest.mark.parametrize("seed", range(30))
def test_tree(seed):
    """Ranks and common beginnings against sorting and comparing the suffixes."""
    rng = random.Random(seed)
    n = rng.randrange(1, 60)
    symbols = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(n)]
    tree = runs.SuffixTree(symbols)
    suffixes = sorted(range(n), key=lambda i: symbols[i:])
    assert tree.order.tolist() == [n, *suffixes]
    turned = sorted(range(n), key=lambda i: [-s for s in symbols[i:]])
    assert np.argsort(tree.ranks_descending()).tolist() == [n, *turned]
    pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
    if pairs:
        a, b = np.array(pairs).T
        for i, j, common in zip(a, b, tree.common(a, b)):
            want = 0
            while max(i, j) + want < n and symbols[i + want] == symbols[j + want]:
                want += 1
            assert common == want


@pytest.mark.parametrize("seed", range(200))
def test_runs(seed):
    rng = random.Random(seed)
    symbols = []
    while len(symbols) < rng.choice([5, 40, 120]):
        part = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(1, 9))]
        symbols += part * rng.choice([1, 1, 2, 4])
    for least in (2, 4, 12):
        want = sorted(slow_runs(symbols, least), key=lambda r: (r[0], r[2]))
        assert runs.runs(symbols, least) == want


@pytest.mark.parametrize("seed", range(60))
def test_windows_lose_no_run(seed):
    """Documents side by side, many words repeated at many distances."""
    rng = random.Random(seed)
    documents = []
    for _ in range(12):
        words, size = [], rng.choice([0, 3, 11, 12, 60, 300])
        while len(words) < size:
            part = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 9, 400])) for _ in range(rng.randrange(1, 60))]
            words += part * rng.choice([1, 1, 1, 2, 3])
            if rng.random() < 0.4 and words:
                at = rng.randrange(len(words))
                words += words[at : at + rng.randrange(1, 50)]
        documents.append(words)
    found = runs.runs_of(documents)
    assert [sorted(each) for each in found] == [slow_runs(words) for words in documents]


def test_text_without_repeats_has_no_window():
    words = [[b"%d" % (i * j % 50_021) for i in range(1, 3000)] for j in (1, 7)]
    symbols = np.array([int(w) for each in words for w in each])
    assert runs.windows(symbols, np.array([0, 2999, 5998])) == []


def test_documents(spark):
    rows = [
        (r["doc_id"], r["text"])
        for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
        if len(r["text"] or "") < 6000
    ]
    rows += [(i, "a b c d e f g " * (i % 9)) for i in range(2000, 2060)]
    found = runs.collapse_runs(with_clashes(documents(spark, rows)), keep=True).collect()
    assert sorted((tuple(r[:8]) for r in found), key=key) == sorted(
        (slow(*row) for row in rows), key=key
    )
    assert sum(r["n_runs"] > 0 for r in found) > 60
    for row in found:
        assert hashlib.sha256(row["collapsed"].encode()).hexdigest() == row["collapsed_sha256"]
        assert len(row["runs"]) == row["n_runs"]


def test_awkward_documents(spark):
    long = [(7, "long " * 30_000, "en", "src0", 150_000)]
    rows = [row for row in AWKWARD if row not in long]
    found = runs.collapse_runs(with_clashes(documents(spark, rows * 2))).collect()
    want = [slow(*row[:2]) for row in rows * 2]
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    (row,) = runs.collapse_runs(documents(spark, long), one_in=None).collect()
    assert tuple(row[1:6]) == (1, 0, 30_000, 1, 30_000_000)
    assert row["collapsed_sha256"] == hashlib.sha256(b"long").hexdigest()


def test_ties(spark):
    """Of runs of one length the first counts."""
    text = "a b " * 6 + "x " + "c d " * 6
    (row,) = runs.collapse_runs(documents(spark, [(None, text)])).collect()
    assert tuple(row[:6]) == (None, 2, 0, 12, 2, 6000)


def test_empty_table(spark):
    assert runs.collapse_runs(documents(spark, [])).collect() == []
