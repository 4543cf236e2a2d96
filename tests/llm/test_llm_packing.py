import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpora import AWKWARD, documents, with_clashes
from tokenizers import Tokenizer

import corpus_pipeline
from marketloom.llm import packing, queries


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def best_fit(sizes, capacity):
    """Remaining capacities after best-fit decreasing, piece by piece."""
    left = []
    for size in sorted(sizes, reverse=True):
        at = bisect.bisect_left(left, size)
        bisect.insort(left, (left.pop(at) if at < len(left) else capacity) - size)
    return left


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 5, 16, 97, 2048])
    sizes = [rng.randint(1, rng.choice([capacity, max(1, capacity // 5)])) for _ in range(200)]
    counts = Counter(sizes)
    plan = packing.best_fit_decreasing(counts, capacity)
    length = np.array([s for s, n in counts.items() for _ in range(n)])
    rank = np.array([r for n in counts.values() for r in range(n)])
    window, offset, fill = plan.place(length, rank)
    used = defaultdict(int)
    for w, o, size in sorted(zip(window, offset, length)):
        assert used[w] == o
        used[w] += size
    assert all(used[w] == f for w, f in zip(window, fill))
    assert sorted(used) == list(range(len(used)))
    assert sorted(capacity - n for n in used.values()) == best_fit(sizes, capacity)


def test_tightest_open_window():
    tree = packing.OpenWindows(10)
    assert tree.tightest(0) is None
    for remaining in (0, 4, 7, 10):
        tree.add(remaining, 2)
    assert [tree.tightest(n) for n in (0, 1, 4, 5, 8, 10)] == [0, 4, 4, 7, 10, 10]
    tree.add(10, -2)
    assert tree.tightest(8) is None


def test_both_libraries_give_the_same_ids(tokenizer):
    rng = random.Random(3)
    parts = ["a", "B", "word", " ", "  ", "\n", "\t", "1", "'s", "!", "_", "漢", "\U0001f642"]
    texts = ["", " ", "x<|endoftext|> y", "a" * 5000]
    for _ in range(2000):
        some = [rng.choice([*parts, chr(rng.randrange(256))]) for _ in range(rng.randrange(25))]
        texts.append("".join(some))
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    for encoder in (packing.encoder(None), packing.encoder(public_tokenizers.path(packing.TOKENIZER))):
        for text, ids, encoding in zip(texts, encoder.encode(texts), want):
            assert np.frombuffer(ids, "<u4").tolist() == encoding.ids, text


@pytest.mark.parametrize("space", [" ", "\n"])
def test_very_long_white_space(tokenizer, space):
    texts = ["before", "word" + space * 1_200_000 + "x", "after"]
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    found = packing.encoder(None).encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [e.ids for e in want]


def test_special_tokens_as_the_file_has_them(spark, tmp_path):
    plain = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = ["a <|endoftext|> b", "<|endoftext|>" * 3, "漢 <|endoftext|>", "no <|endoftext", ""]
    want = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert want[0] == [64, 220, 50256, 275]
    for path in (None, public_tokenizers.path(packing.TOKENIZER)):
        found = packing.encoder(path, special_as_text=False).encode(texts)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == want
    documents(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    crcs = {i: zlib.crc32(np.array([*ids, 1], "<u4").tobytes()) for i, ids in enumerate(want)}
    packed = queries.queries()["op7_packing"](spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for rows in (packed, corpus_pipeline.pack(spark, docs, str(tmp_path))):
        assert {r["doc_id"]: r["ids_crc32"] for r in rows.collect()} == crcs


def expected_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("capacity", [2048, 7])
def test_pieces_and_sequences(spark, tokenizer, capacity):
    docs = with_clashes(documents(spark, AWKWARD))
    packed = packing.pack(docs, capacity=capacity, keep_ids=True).cache()
    rows = packed.collect()
    want = Counter()
    for row in AWKWARD:
        ids = expected_ids(tokenizer, row[1])
        for start in range(0, len(ids), capacity):
            want[(row[0], start, tuple(ids[start : start + capacity]), len(ids))] += 1
    assert want == Counter(
        (r["doc_id"], r["start"], tuple(r["ids"]), r["doc_tokens"]) for r in rows
    )
    sequences = defaultdict(dict)
    for row in rows:
        data = np.array(row["ids"], "<u4").tobytes()
        assert row["ids_crc32"] == zlib.crc32(data) and row["length"] == len(row["ids"])
        sequences[row["sequence_id"]][row["offset"]] = row
    for pieces in sequences.values():
        at = 0
        for offset in sorted(pieces):
            assert offset == at
            at += pieces[offset]["length"]
        assert at <= capacity
        for row in pieces.values():
            assert row["sequence_tokens"] == at
            assert row["padded_tokens"] == (at if at.bit_count() == 1 else capacity)
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert whole.keys() == sequences.keys()
    for key, pieces in sequences.items():
        ids = [i for offset in sorted(pieces) for i in pieces[offset]["ids"]]
        padded = next(iter(pieces.values()))["padded_tokens"]
        assert whole[key]["ids"] == ids + [0] * (padded - len(ids))


def test_empty_table(spark):
    assert packing.pack(documents(spark, [])).collect() == []
