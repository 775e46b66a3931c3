"""Near-duplicate groups by MinHash with fast similarity sketching.

Sketch: in round after round every shingle is hashed to one bin and a value that
grows with the round; a bin keeps its smallest value. After as many rounds as
there are bins, each further round sends all shingles to one given bin, so every
bin fills. Large sets are done after a few rounds.

Texts with one set are one node, named by their smallest id. Nodes that agree in
a band of the sketch share a bucket; inside it, nodes whose sketches agree
in enough bins are joined into candidate groups. Every pair of different sets of
a candidate group is then compared on full sets, and links make the components.

Buckets and candidate groups of any size are cut into chunks; each pair of
chunks is a tile of bounded size, and a tile gives out a spanning forest, never
all its pairs. At a similarity of 0.8 a pair escapes all bands with probability
under 1e-8, and the agreement needed is over six deviations below what it has.

Defined results: words are split at white space and A-Z lower-cased; a text of
fewer words than a shingle has is one shingle, a null text or one without words has an empty
set and is linked with nothing. Rows under one id are one node. A row without an
id is linked with nothing, has a null component and is kept. An empty table gives
an empty one. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, as_bytes, hash_slices, lean, mix, runs, slices, words
from tidemark.llm.graph import components
from tidemark.sinks.scratch import materialize

BANDS, ROWS = 48, 5
BINS = BANDS * ROWS
#: Bins in which candidates agree at least; four bits of a bin are kept, so others agree in one of sixteen by chance.
AGREE = int(0.65 * BINS)
#: Members of a chunk of a bucket; members and shingles of a chunk of a candidate group.
BUCKET_CHUNK, GROUP_CHUNK, GROUP_SHINGLES = 2048, 512, 400_000
BATCH_BYTES = 1_000_000
COLUMNS = 4096
_NO = np.uint64(2**64 - 1)


def shingle_sets(texts: pa.Array, width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) pairs of all texts, distinct and ascending; shingles are 64-bit hashes."""
    data, ends = as_bytes(texts)
    start, stop, row = words(data, ends)
    word = hash_slices(LOWER[data], start, stop)
    n = len(word) - width + 1
    whole = np.flatnonzero(row[: max(n, 0)] == row[width - 1 :]) if n > 0 else np.zeros(0, np.int64)
    value = np.full(len(whole), width, np.uint64)
    for i in range(width):
        value = mix(value + word[whole + i])
    counts = np.bincount(row, minlength=len(ends)) if len(row) else np.zeros(len(ends), int)
    short = np.flatnonzero((counts > 0) & (counts < width))
    first = np.cumsum(counts) - counts
    few = counts[short].astype(np.uint64)
    for i in range(width - 1):
        on = counts[short] > i
        few[on] = mix(few[on] + word[first[short[on]] + i])
    rows, values = np.concatenate((row[whole], short)), np.concatenate((value, few))
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[fresh], values[fresh]


def sketch(rows: np.ndarray, values: np.ndarray, n: int, bins: int = BINS) -> np.ndarray:
    """The bins of each of n sets; rows of an empty set stay unfilled."""
    out = np.full(n * bins, _NO)
    for turn in range(2 * bins):
        if turn < bins:
            x = mix(values + np.uint64((turn * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1)))
            at = rows * bins + ((x >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        else:
            x = mix(values + np.uint64((turn * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1)))
            at = rows * bins + (turn - bins)
        np.minimum.at(out, at, (x >> np.uint64(10)) | np.uint64(turn << 54))
        open_rows = (out.reshape(n, bins) == _NO).any(1)
        left = open_rows[rows]
        rows, values = rows[left], values[left]
        if not len(rows):
            break
    return out.reshape(n, bins)


def _sketches(documents: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, 4 bits of every bin, and band keys; null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                n = part.num_rows
                rows, values = shingle_sets(part.column("text"), width)
                counts = np.bincount(rows, minlength=n) if len(rows) else np.zeros(n, int)
                full = sketch(rows, values, n)
                digest = np.zeros((n, 2), np.uint64)
                for i, seed in enumerate((3, 5)):
                    np.add.at(digest[:, i], rows, mix(values + np.uint64(seed)))
                banded = full.reshape(n, BANDS, ROWS)
                keys = np.tile(np.arange(BANDS, dtype=np.uint64), (n, 1))
                for i in range(ROWS):
                    keys = mix(keys + banded[:, :, i])
                bits = (mix(full) & np.uint64(0xF)).astype(np.uint8)
                bits = bits[:, ::2] << 4 | bits[:, 1::2]
                some = counts > 0
                binary = lambda m: pa.array([x.tobytes() if s else None for x, s in zip(m, some)], pa.binary())  # noqa: E731, B023
                lists = pa.array([x if s else None for x, s in zip(keys.view(np.int64), some)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), binary(digest), binary(bits), lists],
                    names=["doc_id", "n_shingles", "digest", "bits", "bands"],
                )

    given = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(lean(run), "doc_id long, n_shingles long, digest binary, bits binary, bands array<long>")


def _tiles(rows: DataFrame, key: str, member: str, chunks: Column) -> DataFrame:
    """Rows sent to the tiles of their chunk with each chunk of their group, sorted by (key, tile)."""
    own = F.pmod(F.xxhash64(member, F.lit(7)), F.col("_chunks"))
    pair = F.least("_own", "_other") * F.col("_chunks") + F.greatest("_own", "_other")
    dealt = rows.withColumn("_chunks", chunks.cast("long")).withColumn("_own", own)
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1))).withColumn("tile", pair)
    return dealt.drop("_chunks", "_own", "_other").repartition(key, "tile").sortWithinPartitions(key, "tile")


def _forest(n: int, linked) -> list[tuple[int, int]]:
    """Edges that join all of n members which chains of links join; linked(i, rest) tells which of the rest i links to."""
    rest, edges = np.arange(n), []
    while len(rest) > 1:
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            one = todo.pop()
            hit = linked(one, rest)
            edges += [(one, int(x)) for x in rest[hit]]
            todo += rest[hit].tolist()
            rest = rest[~hit]
    return edges


def _edges(pairs: list[np.ndarray]) -> pa.RecordBatch:
    both = np.concatenate([*pairs, np.zeros((0, 2), np.int64)]).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])


#: Of the two bins in a byte, how many agree, by the exclusive or of two bytes.
_AGREEING = np.array([(x >> 4 == 0) + (x & 15 == 0) for x in range(256)], np.uint8)


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bins in which rows of packed sketches agree."""
    return _AGREEING[a ^ b].sum(1, dtype=np.int64)


def _similar_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, cuts in runs(batches, ["bucket", "tile"]):
        node = table["node"].to_numpy()
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint8).reshape(-1, BINS // 2)
        sizes, found = np.diff(cuts), []
        two = cuts[:-1][sizes == 2]
        two = two[_agreeing(bits[two], bits[two + 1]) >= AGREE]
        found.append(np.stack((node[two], node[two + 1]), 1))
        for a, b in zip(cuts[:-1][sizes > 2].tolist(), cuts[1:][sizes > 2].tolist()):
            own = bits[a:b]
            edges = _forest(b - a, lambda i, rest: _agreeing(own[rest], own[i]) >= AGREE)  # noqa: B023
            found.append(node[a:b][np.array(edges, np.int64).reshape(-1, 2)])
        yield _edges(found)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of incidence matrices over the shingles that two sets have."""
    every, member = np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))
    order = np.argsort(every, kind="stable")
    every, member = every[order], member[order]
    first = np.concatenate(([True], every[1:] != every[:-1]))
    column = np.cumsum(first) - 1
    common = np.bincount(column) > 1
    member, column = member[common[column]], (np.cumsum(common) - 1)[column[common[column]]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[member[a:b], column[a:b] - at] = 1
        out += block @ block.T
    return out.astype(np.int64)


def _linked_sets(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in runs(batches, ["group", "tile"], rows=2000):
            node, values, found = table["node"].to_numpy(), table["shingles"].to_pylist(), []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                sets = [np.frombuffer(x, np.uint64) for x in values[a:b]]
                common, sizes = _shared(sets), np.array(list(map(len, sets)))
                link = 100 * common >= share * (sizes[:, None] + sizes - common)
                edges = _forest(b - a, lambda i, rest: link[i, rest])  # noqa: B023
                found.append(node[a:b][np.array(edges, np.int64).reshape(-1, 2)])
            yield _edges(found)

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                rows, values = shingle_sets(part.column("text"), width)
                cuts = np.searchsorted(rows, np.arange(part.num_rows + 1))
                sets = [values[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("group"), pa.array(sets, pa.binary())], names=["node", "group", "shingles"])

    return run


def groups(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, share: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document; links are sets of shingles of ``width`` words that share ``share`` percent."""
    if share < 80:
        raise ValueError("below 80 percent, more bands are needed than are set here")
    spark = documents.sparkSession
    found = materialize(spark, _sketches(documents, key, text, width), "sketches")
    some = found.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    nodes = some.groupBy("digest").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n"), F.min_by(F.struct("bits", "bands"), "doc_id").alias("s"))
    nodes = materialize(spark, nodes.select("digest", "node", "n", "s.bits", "s.bands"), "nodes")
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    placed = entries.join(buckets, "bucket").join(nodes.select("node", "bits"), "node")
    tiles = _tiles(placed, "bucket", "node", F.ceil(F.col("size") / BUCKET_CHUNK)).select("bucket", "tile", "node", "bits")
    close = components(tiles.mapInArrow(lean(_similar_sketches), "a long, b long"))
    close = materialize(spark, close.select("node", F.col("root").alias("group")), "candidates")

    sizes = close.join(nodes.select("node", "n"), "node").groupBy("group").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
    texts = documents.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).where(F.col("node").isNotNull())
    # The same plan at every size; texts are dealt by id once.
    sets = texts.join(close.hint("merge"), "node").select("node", "group", "text").mapInArrow(lean(_full_sets(width)), "node long, group long, shingles binary")
    chunks = F.ceil(F.greatest(F.col("size") / GROUP_CHUNK, F.col("total") / GROUP_SHINGLES))
    tiles = _tiles(sets.join(sizes, "group"), "group", "node", chunks).select("group", "tile", "node", "shingles")
    linked = components(tiles.mapInArrow(lean(_linked_sets(share)), "a long, b long"))

    named = nodes.select("digest", "node").join(linked, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    # Rows under one id may have several sets, all one node.
    least = found.join(named, "digest", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
    return least.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
