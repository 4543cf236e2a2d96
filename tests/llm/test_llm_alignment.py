import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from corpora import AWKWARD, documents, with_clashes
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from marketloom.llm import alignment

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed", range(60))
@pytest.mark.parametrize("work", [1, 2, 3, 7, 64])
def test_merge(seed, work):
    """Overlaps and groups against comparing all tokens with all tokens."""
    rng = random.Random(seed)
    size = rng.choice([1, 2, 10, 150])
    ends = [
        np.array(sorted({*rng.sample(range(1, size), rng.randrange(size)), size}), dtype=np.int64)
        for _ in "ab"
    ]
    found = alignment.merge(*ends, work)
    spans = [list(zip([0, *e[:-1].tolist()], e.tolist())) for e in ends]
    overlaps = [
        (i, j, a[1] == b[1])
        for i, a in enumerate(spans[0])
        for j, b in enumerate(spans[1])
        if max(a[0], b[0]) < min(a[1], b[1])
    ]
    assert list(zip(found.a.tolist(), found.b.tolist(), found.both.tolist())) == overlaps
    cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    starts = [max(spans[0][i][0], spans[1][j][0]) for i, j, _ in overlaps]
    assert found.group.tolist() == [sum(c <= start for c in cuts) for start in starts]


def test_pieces_are_of_equal_work():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(1, 10**6, 5000))
    b = np.unique(rng.integers(1, 10**6, 3000))
    taken = alignment.diagonals(a, b, 64)
    merged = np.lexsort((np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b])))
    want = [int((merged[:step] < len(a)).sum()) for step in range(0, len(merged), 64)]
    assert taken.tolist() == [*want, len(a)]


def tokens_of(texts):
    a_file = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_file.encode_special_tokens = True
    b_file = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_bytes = alignment.byte_level_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    for text in texts:
        if not text:
            yield [], []
            continue
        a = [(i, a_bytes[i]) for i in a_file.encode(f" {text}", add_special_tokens=False).ids]
        pieces = b_file.encode(text, out_type=str)
        b = []
        for number, piece in zip(b_file.encode(text), pieces):
            if piece.startswith("<0x") and b_file.is_byte(number):
                b.append((number, bytes.fromhex(piece[3:5])))
            else:
                b.append((number, piece.replace("▁", " ").encode()))
        whole = f" {text}".encode()
        same = all(b"".join(p for _, p in side) == whole for side in (a, b))
        yield (a, b) if same else ([], [])


def slow(rows):
    documents_, counts = [], Counter()
    for a, b in tokens_of([row[1] for row in rows]):
        groups, links, held = [], [], ([], [])
        a_end = b_end = 0
        i = j = 0
        while i < len(a) or j < len(b):
            if a_end <= b_end and i < len(a):
                a_end += len(a[i][1])
                held[0].append(a[i][0])
                i += 1
            else:
                b_end += len(b[j][1])
                held[1].append(b[j][0])
                j += 1
            if a_end == b_end:
                groups.append(held)
                links.append((held[0][-1], held[1][-1]))
                held = ([], [])
        counts.update(links)
        documents_.append((len(a), len(b), groups, links))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for row, (n_a, n_b, groups, links) in zip(rows, documents_):
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        yield (
            row[0], n_a, n_b, len(groups), len(links),
            sum(counts[pair] == most[pair[1]] for pair in links),
            sum(counts[pair] for pair in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        )


def key(row):
    return tuple(str(value) for value in row)


def check(spark, rows, docs=None):
    docs = with_clashes(documents(spark, rows)) if docs is None else docs
    found = [tuple(r) for r in alignment.link_counts(docs).collect()]
    assert sorted(found, key=key) == sorted(slow(rows), key=key)
    return found


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = check(spark, rows, docs)
    assert all(row[3] for row in found) and any(row[5] < row[4] for row in found)


ODD = [
    (20, "a <|endoftext|> b <s> </s> <unk> <0x41>"),
    (21, "▁ has no tokens"),
    (22, "tabs\tand\r\nlines\n\n  and   spaces  "),
    (23, "\U0001f642\U0001f642 漢字かな ｆｕｌｌ ﬁ ﬀ é é"),
    (24, "\x00 zero and \x1f \x7f \xa0 others"),
    (25, "def f(x):\n    return x ** 2  # 12345"),
    (None, "no id"),
    (26, " "),
    (27, "\n"),
]


def test_awkward_documents(spark):
    found = check(spark, AWKWARD + ODD + ODD[:2])
    told = {row[0]: row for row in found}
    assert told[21][1:] == (0, 0, 0, 0, 0, 0, "") and told[20][1] > 0


def test_counts_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 0)
    check(spark, [(i, f"the same words, then {i}") for i in range(60)] + ODD)


def test_pieces_and_portions_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHARS_AT_ONCE", 10)
    docs = documents(spark, AWKWARD + ODD)
    rows = [
        sorted(map(str, alignment.aligned(docs, work=work, keep=True).collect()))
        for work in (1, 5, 64)
    ]
    assert rows[0] == rows[1] == rows[2]


def test_empty_table(spark):
    assert alignment.link_counts(documents(spark, [])).collect() == []


def test_bytes_of_tokens():
    a = alignment.byte_level_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(a) == 50_257 and all(a) and {bytes([i]) for i in range(256)} <= set(a)
