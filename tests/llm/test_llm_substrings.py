import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from corpora import AWKWARD, documents, with_clashes

from marketloom.llm import substrings


def slow(texts, length):
    places = defaultdict(list)
    for n, text in enumerate(texts):
        for i in range(len(text) - length + 1):
            places[text[i : i + length]].append((n, i))
    covered = [np.zeros(len(text), dtype=bool) for text in texts]
    for found in places.values():
        if len(found) > 1:
            for n, i in found:
                covered[n][i : i + length] = True
    for text, gone in zip(texts, covered):
        edges = np.diff(np.concatenate([[0], gone.astype(int)])) if len(gone) else np.zeros(0)
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        yield len(text), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()


def check(spark, rows, length):
    found = substrings.remove_repeats(
        with_clashes(documents(spark, rows)), length=length, keep_text=True
    ).collect()
    for row in found:
        assert hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"]
        assert len(row["kept"]) == row["n_bytes"] - row["n_removed"]
    got = sorted((str(r[0]), *r[1:5]) for r in found)
    results = slow([(row[1] or "").encode() for row in rows], length)
    assert got == sorted((str(row[0]), *x) for row, x in zip(rows, results))


@pytest.mark.parametrize("seed", range(6))
def test_random_documents(spark, monkeypatch, seed):
    """With anchors sorted in tasks, and for odd seeds mostly counted."""
    if seed % 2:
        monkeypatch.setattr(substrings, "GROUP", 2)
    rng = random.Random(seed)
    letters = rng.choice(["ab", "abcdefgh ", "a"])
    passages = ["".join(rng.choices(letters, k=rng.randrange(20, 400))) for _ in range(4)]
    rows = []
    for n in range(30):
        parts = [
            rng.choice(passages)
            if rng.random() < 0.6
            else "".join(rng.choices("abcdefgh é", k=rng.randrange(150)))
            for _ in range(rng.randrange(5))
        ]
        rows.append((n if rng.random() < 0.9 else None, "".join(parts)))
    check(spark, rows + rows[:2], rng.choice([64, 65, 80, 100]))


def test_awkward_documents(spark):
    rows = [row[:2] for row in AWKWARD if row[1] is None or len(row[1]) < 5000]
    check(spark, rows, 70)


def test_long_texts(spark):
    """Texts longer than what is searched for anchors at a time; all of one byte, or random."""
    rng = random.Random(9)
    size = substrings.BYTES_AT_ONCE + 5000
    noise = "".join(rng.choices("abcdefghijklmnop ", k=size))
    rows = [(1, noise), (2, noise[1000:1800] + "z" + noise[-900:]), (3, "q" * 3000), (4, "q" * 399)]
    check(spark, rows, 400)


def test_columns_sort_a_collection():
    """Rounds over one group agree with sorting all its strings."""
    rng = random.Random(2)
    width = substrings.Width.of(72)
    seed = b"x" * substrings.SEED_LENGTH
    texts = [
        bytes(rng.choices(b"ab", k=30)) + seed + bytes(rng.choices(b"ab", k=9)) for _ in range(40)
    ]
    texts += [texts[0][5:], b"b" + texts[1][1:], texts[2][:-3]]
    left = np.array([t.index(seed) for t in texts])
    trimmed = [t[max(0, at - width.before) : at + width.length] for t, at in zip(texts, left)]
    left = np.minimum(left, width.before)
    first, last = substrings.repeated_strings(trimmed, left, np.zeros(len(texts), int), width)
    seen = defaultdict(set)
    for n, (text, at) in enumerate(zip(trimmed, left)):
        for before in range(min(at, width.before) + 1):
            string = text[at - before : at - before + width.length]
            if len(string) == width.length:
                seen[(before, string)].add(n)
    for n in range(len(texts)):
        rounds = [before for (before, _), who in seen.items() if n in who and len(who) > 1]
        assert (first[n], last[n]) == ((min(rounds), max(rounds)) if rounds else (-1, -1))


def test_empty_table_and_short_length(spark):
    assert substrings.remove_repeats(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        substrings.remove_repeats(documents(spark, []), length=63)
