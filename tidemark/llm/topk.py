"""Exact top-k inner products by tiled matrix products.

Queries are dealt into blocks and candidates into shards of bounded size. Each
pair of a block and a shard is one tile: one matrix product, and the k best per
query of the tile. The lists of a query are merged up a tree.

Components become floor(scale * x), so scores are whole numbers and exact:
float products where all partial sums stay below 2^53, Python integers beyond.

Defined results: rows without an id, with a null vector or with null or
non-finite components take no part. A query meets candidates with as many
components as it has and another id; equal scores go to the smaller id. Rows
repeated under one id are candidates each; as queries they share one list. Scores
beyond 64 bits are cut to the nearest 64-bit number. Fewer candidates than k give a shorter
list, none give no rows. Extra columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts_for
from tidemark.llm.vectors import best_lists, first_of_rows, matrices, usable

#: Vectors in a block of queries and in a shard; they bound a task's memory.
BLOCK, SHARD = 4096, 8192
#: Queries multiplied and selected at once.
ROWS = 256
EXACT = float(2**53)
_SCHEMA = "query_id long, shard int, vec_id long, score long"
_ARROW = pa.schema([("query_id", pa.int64()), ("shard", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _whole(vectors: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(vectors * scale)


def _products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * max(1, shard.shape[1])
    if bound < EXACT:
        return (queries @ shard.T).astype(np.int64)
    integers = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], dtype=object).reshape(m.shape)
    return integers(queries).dot(integers(shard).T)


def tile(queries: tuple[np.ndarray, np.ndarray], shard: tuple[np.ndarray, np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, candidate ids, scores) of the k best of the shard for each query; the shard is by ascending id."""
    (query_ids, q), (ids, s) = queries, shard
    out = []
    for at in range(0, len(q), ROWS):
        own, scores = query_ids[at : at + ROWS], _products(q[at : at + ROWS], s)
        other = own[:, None] != ids[None, :]
        if scores.dtype == object or np.abs(scores).max(initial=0) > (1 << 62) // (len(ids) + 1):
            for i, row in enumerate(scores.tolist()):
                first = sorted(np.flatnonzero(other[i]).tolist(), key=lambda j: (-row[j], j))[:k]
                cut = [max(-(1 << 63), min((1 << 63) - 1, row[j])) for j in first]
                out.append((np.full(len(first), own[i]), ids[first], np.array(cut, np.int64)))
            continue
        keys = -scores * len(ids) + np.arange(len(ids))
        keys[~other] = np.iinfo(np.int64).max - np.flatnonzero(~other) % max(1, len(ids)) if (~other).any() else 0
        first = first_of_rows(keys, k)
        valid = np.take_along_axis(other, first, 1)
        out.append((np.repeat(own, valid.sum(1)), ids[first][valid], np.take_along_axis(scores, first, 1)[valid]))
    return out


def search(candidates: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """The k candidates of largest inner product for each query: query_id, rank, vec_id, score."""
    own = candidates.where(usable(vector, key)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    asked = queries.where(usable(vector, key)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    shards, blocks = parts_for(own.count(), SHARD), parts_for(asked.count(), BLOCK)
    deal = lambda n, seed: F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("block", deal(blocks, 1)).withColumn("shard", every(shards))
    right = own.withColumn("shard", deal(shards, 2)).withColumn("block", every(blocks))

    def multiply(asked: pa.Table, own: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows and own.num_rows:
            shard, q = matrices(own["id"], own["v"]), matrices(asked["id"], asked["v"])
            for size in q.keys() & shard.keys():
                whole = [(ids, _whole(v, scale)) for ids, v in (q[size], shard[size])]
                found += tile(*whole, k)
        if not found:
            return _ARROW.empty_table()
        query_id, vec_id, score = map(np.concatenate, zip(*found))
        return pa.table([query_id, np.full(len(score), own["shard"][0].as_py(), np.int32), vec_id, score], schema=_ARROW)

    tiles = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(multiply, _SCHEMA)
    best = best_lists(tiles, "query_id", [F.desc("score"), F.asc("vec_id")], k, "shard", shards)
    return best.select("query_id", "rank", "vec_id", "score")
