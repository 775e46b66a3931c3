"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, each quantised with a codebook of its own; the
pair of nearest centroids is the cell. A query visits cells by ascending sum of
its two distances, with a heap, until they hold ``share`` of all vectors, and all
their entries are ranked by exact distance. Codebooks are fitted on a bounded
sample; every vector is indexed.

Distances between vectors without cluster structure differ little, so a fixed
number of entries would lose recall as data grow; a share keeps it.

Work is dealt by cell. A cell with many vectors is cut into parts and each query
that visits it is sent to all of them; many queries are cut into blocks too.

Defined results: rows without an id, and vectors null, zero, or with null or
non-finite components take no part; nor do vectors whose number of components is
not the most frequent one (of equals the larger). A query meets every id but its
own; equal distances go to the smaller id. Rows repeated under one id are
candidates each; as queries they share one list. Fewer candidates than k give a
shorter list, with one component or few vectors too. Extra columns are not carried.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts_for
from tidemark.llm.vectors import best_lists, matrices, usable
from tidemark.sinks.scratch import materialize

#: Vectors the codebooks are fitted on, centroids per half, and rounds of fitting.
SAMPLE, CENTROIDS, ROUNDS = 10_000, 32, 12
#: Part of all vectors that a query's cells hold at least.
SHARE = 0.55
#: Vectors in a part of a cell, and queries in a block of those that visit it.
PART, BLOCK = 4096, 2048
_ARROW = pa.schema([("query_id", pa.int64()), ("piece", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


def fit_codebook(sample: np.ndarray, centroids: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's algorithm from a spread start; never more centroids than distinct vectors."""
    distinct = np.unique(sample, axis=0)
    if len(distinct) <= centroids:
        return distinct
    chosen = [0]
    nearest = _squares(distinct, distinct[:1])[:, 0]
    draw = np.random.default_rng(5)
    while len(chosen) < centroids:
        at = int(draw.choice(len(distinct), p=nearest / nearest.sum())) if nearest.sum() > 0 else len(chosen)
        chosen.append(at)
        nearest = np.minimum(nearest, _squares(distinct, distinct[at : at + 1])[:, 0])
    book = distinct[chosen]
    for _ in range(rounds):
        own = _squares(sample, book).argmin(1)
        for c in range(len(book)):
            if (members := sample[own == c]).size:
                book[c] = members.mean(0)
    return book


def visit(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: float) -> list[int]:
    """Cells by ascending left[i] + right[j] until they hold ``wanted`` vectors; empty cells are passed over."""
    by_left, by_right = left.argsort(kind="stable"), right.argsort(kind="stable")
    heap = [(left[by_left[0]] + right[by_right[0]], 0, 0)]
    seen, cells, held = {(0, 0)}, [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(by_left[i] * len(right) + by_right[j])
        if counts[cell]:
            cells.append(cell)
            held += int(counts[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(left) and b < len(right) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (left[by_left[a]] + right[by_right[b]], a, b))
    return cells


def search(candidates: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS, share: float = SHARE) -> DataFrame:
    """The k nearest candidates found for each query: query_id, rank, vec_id, score (distance)."""
    spark = candidates.sparkSession
    own = candidates.where(usable(vector, key, True)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    asked = queries.where(usable(vector, key, True)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    common = own.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = common["n"]
    own, asked = own.where(F.size("v") == size), asked.where(F.size("v") == size)
    sample = np.array([r["v"] for r in own.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()], float)
    half = max(1, size // 2)
    books = fit_codebook(sample[:, :half], centroids), fit_codebook(sample[:, half:], centroids)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v in matrices(batch.column("id"), batch.column("v")).values():
                first, second = _squares(v[:, :half], books[0]).argmin(1), _squares(v[:, half:], books[1]).argmin(1)
                vectors = pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), size).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(ids), vectors, pa.array(first * len(books[1]) + second)], names=["id", "v", "cell"])

    entries = materialize(spark, own.mapInArrow(index, "id long, v array<double>, cell long"), "multi-index")
    counts = np.zeros(len(books[0]) * len(books[1]), np.int64)
    for r in entries.groupBy("cell").count().collect():  # a row for each cell at most
        counts[r["cell"]] = r["count"]
    wanted = max(share * counts.sum(), k + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v in matrices(batch.column("id"), batch.column("v")).values():
                left, right = _squares(v[:, :half], books[0]), _squares(v[:, half:], books[1])
                cells = [visit(a, b, counts, wanted) for a, b in zip(left, right)]
                row = np.repeat(np.arange(len(ids)), list(map(len, cells)))
                vectors = pa.FixedSizeListArray.from_arrays(pa.array(v[row].ravel()), size).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), vectors, pa.array(np.array([c for x in cells for c in x], np.int64))], names=["id", "v", "cell"])

    blocks = parts_for(asked.count(), BLOCK)
    parts = F.element_at(F.array(*(F.lit(parts_for(int(n), PART)) for n in counts)), F.col("cell").cast("int") + 1)
    deal = lambda n, seed: F.pmod(F.xxhash64("id", "v", F.lit(seed)), n).cast("int")
    left = asked.mapInArrow(probe, "id long, v array<double>, cell long").withColumn("block", deal(F.lit(blocks), 1)).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    right = entries.withColumn("part", deal(parts, 2)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def rank(asked: pa.Table, own: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows and own.num_rows:
            (ids, vectors), (query_ids, q) = matrices(own["id"], own["v"])[size], matrices(asked["id"], asked["v"])[size]
            for one, x in zip(query_ids, q):
                distance = np.sqrt(((vectors - x) ** 2).sum(1))
                others = np.flatnonzero(ids != one)
                if len(others) > 4 * k:  # all that are no farther than the k-th
                    near = distance[others]
                    others = others[near <= np.partition(near, k - 1)[k - 1]]
                first = others[np.argsort(distance[others], kind="stable")][:k]
                found.append((np.full(len(first), one), ids[first], distance[first]))
        if not found:
            return _ARROW.empty_table()
        query_id, vec_id, score = map(np.concatenate, zip(*found))
        piece = own["cell"][0].as_py() * 1_000_003 + own["part"][0].as_py()
        return pa.table([query_id, np.full(len(score), piece), vec_id, score], schema=_ARROW)

    keys = ["cell", "part", "block"]
    tiles = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rank, "query_id long, piece long, vec_id long, score double")
    best = best_lists(tiles, "query_id", [F.asc("score"), F.asc("vec_id")], k, "piece", 1)
    return best.select("query_id", "rank", "vec_id", "score")
