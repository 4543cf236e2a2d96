"""Approximate nearest neighbours by randomly rotated one-bit codes [Gao and Long 2024].

A vector's difference from the centroid is turned by a random rotation, and the signs of its
components are its code: one bit each. With two correction scalars, its length and how far the
code points in its direction, the code gives an unbiased estimate of the inner product with any
query, and a bound on its error. A query reads the codes of all vectors. The best estimates are
reranked first, on the vectors themselves; then only vectors whose estimate plus error bound
reaches the worst of the best found so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm import vectors
from marketloom.llm.common import Scratch, extended, salt

K = 20
SEED = 7
#: Standard deviations of the estimate that its error bound spans.
DEVIATIONS = 3.5
#: Vectors and queries of one task, at most about so many.
BLOCK = 16384
QUERIES = 2048
#: Queries estimated at a time, and the estimates reranked before the bounds are used.
QUERIES_AT_ONCE = 128
FIRST = 10

RESULT = "query_id long, hash long, vec_id long, score double"


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.where(np.diag(r) < 0, -1, 1)


def encode(
    rows: np.ndarray, centroid: np.ndarray, turn: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distances from the centroid, and cosines of code and direction."""
    from_centre = (rows - centroid) @ turn
    length = np.sqrt((from_centre**2).sum(axis=1))
    bits = from_centre > 0
    safe = np.where(length > 0, length, 1)
    along = np.abs(from_centre).sum(axis=1) / (safe * math.sqrt(rows.shape[1]))
    return np.packbits(bits, axis=1), length, np.where(length > 0, along, 1.0)


def byte_tables(turned: np.ndarray) -> np.ndarray:
    """For each byte of a code its 256 values' inner products with each query: byte, query, value.

    A query's components are those of the byte's bits, the highest bit first, a set bit counting
    as plus and a clear one as minus; bits behind the last component count nothing.
    """
    number, size = turned.shape
    filled = np.zeros((number, -(-size // 8) * 8))
    filled[:, :size] = turned
    values = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1
    eights = filled.reshape(number, -1, 8).transpose(1, 0, 2)
    return (eights @ values.T).astype(np.float32)


def estimate(
    queries: np.ndarray,
    centroid: np.ndarray,
    turn: np.ndarray,
    codes: np.ndarray,
    length: np.ndarray,
    along: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimated inner products, queries by vectors, and the error bound as two factors.

    Codes are read as they are packed: each byte looks up its eight signs' part of the product.
    """
    size = queries.shape[1]
    scale = (length / (along * math.sqrt(size))).astype(np.float32)
    with np.errstate(over="ignore", invalid="ignore"):
        inner = np.zeros((len(queries), len(codes)), np.float32)
        for table, byte in zip(byte_tables(queries @ turn), codes.T):
            inner += np.take(table, byte, axis=1)
        inner = inner * scale + (queries @ centroid).astype(np.float32)[:, None]
    spread = np.sqrt(np.maximum(0, 1 - along**2)) / along / math.sqrt(max(1, size - 1))
    norms = np.sqrt((queries**2).sum(axis=1))
    return inner, DEVIATIONS * norms + 1e-6 * norms, length * spread + 1e-6 * (length + 1)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def search_block(
    queries: np.ndarray,
    query_ids: np.ndarray,
    ids: np.ndarray,
    rows: np.ndarray,
    index: tuple[np.ndarray, np.ndarray, np.ndarray],
    centroid: np.ndarray,
    turn: np.ndarray,
    k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its number, and places and scores of its k best in the block."""
    first = min(len(ids), FIRST * k)
    for begin in range(0, len(queries), QUERIES_AT_ONCE):
        part = queries[begin : begin + QUERIES_AT_ONCE]
        inner, wide, spread = estimate(part, centroid, turn, *index)
        own = query_ids[begin : begin + QUERIES_AT_ONCE, None] == ids[None, :]
        inner[own] = -np.inf
        ahead = np.argpartition(inner, len(ids) - first, axis=1)[:, len(ids) - first :]
        reach = inner + wide[:, None] * spread[None, :]
        reach[~np.isfinite(inner)] = np.inf  # an estimate that overflowed says nothing
        for n, query in enumerate(part):
            start = rows[ahead[n]] @ query
            start[own[n, ahead[n]]] = -np.inf
            worst = np.partition(start, first - k)[first - k] if first > k else -np.inf
            slack = 1e-9 * (abs(worst) + 1) if np.isfinite(worst) else 0.0
            near = np.nonzero((reach[n] >= worst - slack) & ~own[n])[0]
            rough = rows[near] @ query
            if len(near) > k:
                least = np.partition(rough, len(near) - k)[len(near) - k]
                near = near[rough >= least - 1e-9 * (abs(least) + 1)]
            scores = vectors.dot(rows[near], np.broadcast_to(query, (len(near), len(query))))
            best = _best(ids[near], scores, k)
            yield begin + n, near[best], scores[best]


def _search(
    queries: pa.Table, block: pa.Table, centroid: np.ndarray, turn: np.ndarray, k: int
) -> pa.Table:
    size, out = len(centroid), []
    if queries.num_rows and block.num_rows:
        asked = vectors.matrix(queries.column("embedding"), size)
        rows = vectors.matrix(block.column("embedding"), size)
        packed = block.column("code").combine_chunks()
        codes = np.array([np.frombuffer(x.as_py(), np.uint8) for x in packed])
        index = (codes, block.column("length").to_numpy(), block.column("along").to_numpy())
        ids = block.column("vec_id").to_numpy()
        query_ids = queries.column("query_id").to_numpy()
        hashes = queries.column("hash").to_numpy()
        for n, places, scores in search_block(
            asked, query_ids, ids, rows, index, centroid, turn, k
        ):
            out.append((np.full(len(places), n), ids[places], scores))
    if not out:
        empty = [pa.array([], pa.int64())] * 3 + [pa.array([], pa.float64())]
        return pa.table(empty, ["query_id", "hash", "vec_id", "score"])
    n, found, scores = map(np.concatenate, zip(*out))
    return pa.table(
        {"query_id": query_ids[n], "hash": hashes[n], "vec_id": found, "score": scores}
    )


def build_index(
    scratch: Scratch, valid: DataFrame, seed: int = SEED
) -> tuple[DataFrame, np.ndarray, np.ndarray, int]:
    """The codes of all vectors in a table, by block, with centroid, rotation and blocks."""
    size = vectors.width(valid, "embedding")
    total = vectors.summed(
        valid,
        "embedding",
        size,
        lambda rows: np.append(rows.sum(axis=0), len(rows)),
        (size + 1,),
    )
    number = int(total[-1])
    centroid, turn = total[:-1] / max(1, number), rotation(size, seed)
    blocks = max(1, -(-number // BLOCK))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = vectors.matrix(batch.column("embedding"), size)
                codes, length, along = encode(rows, centroid, turn)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array([x.tobytes() for x in codes], pa.binary()),
                        pa.array(length),
                        pa.array(along),
                    ],
                    [*batch.schema.names, "code", "length", "along"],
                )

    block = salt("vec_id", "embedding", salts=blocks).alias("block")
    columns = valid.select("vec_id", "embedding", block)
    schema = extended(columns.schema, "code binary, length double, along double")
    return scratch.table(columns.mapInArrow(code, schema)), centroid, turn, blocks


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product for each query.

    `is_query` is a condition on vec_id. Candidates are all rows but those with the query's id.
    Scores are inner products of the vectors as given, in double precision; ties go to the
    smaller vec_id. Null, zero and partly null or non-finite vectors and rows without an id take
    no part; shorter vectors are filled up with zeros. A repeated row is a candidate each time,
    but a repeated query is answered once. Other columns are not read. An empty table gives an
    empty result.
    """
    scratch = Scratch(embeddings.sparkSession)
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("embedding")
    )
    valid = rows.where(F.col("vec_id").isNotNull() & vectors.usable(F.col("embedding")))
    index, centroid, turn, blocks = build_index(scratch, valid, seed)
    asked = (
        index.where(is_query)
        .select(F.col("vec_id").alias("query_id"), "embedding")
        .withColumn("hash", F.xxhash64("embedding"))
    )
    asked = scratch.table(asked.dropDuplicates(["query_id", "hash"]))
    groups = max(1, -(-asked.count() // QUERIES))
    asked = asked.withColumn("group", salt("query_id", "hash", salts=groups)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    held = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = (
        asked.groupBy("block", "group")
        .cogroup(held.groupBy("block", "group"))
        .applyInArrow(
            lambda queries, block: _search(queries, block, centroid, turn, k), RESULT
        )
    )
    order = Window.partitionBy("query_id", "hash").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
