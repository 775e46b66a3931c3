"""How far each source's words are from those of the other sources of its language.

The counts of kept terms by group (lang, source) are a sparse matrix per
language. Its columns are dealt into blocks by the hash of the term, its rows
into tiles, so a task holds two tiles of rows and one block of columns, whatever
the corpus. There the cells become a quadtree that halves rows and columns: a
quadrant is marked if it holds a count. The trees of all pairs of rows are walked
jointly from the root. Where the quadrants of both sides are empty every column
costs the same, so the quadrant is priced by its number of columns, counted per
pair of row quadrants and handed down to their rows in the end; other quadrants
are opened, down to the leaves, where the exact value of the pair is computed.
The blocks' sums are added up by Spark.

Probabilities are whole numbers, ``1 + floor(1e9 (count + 1) / (N + V))``, and a
term's share of the divergence is ``floor((p - q)^2 / q)``; all sums are exact.

Hot groups: counts are combined in the tasks that read the texts and again
before the shuffle; a term of a language has one row per source. Ranks of terms
are cut to the limit on both sides of the shuffle.

Defined results: null text, lang and source are ''. Every row is a document, rows
repeated or without an id too. A group without kept terms has pairs but no terms;
a language with one source has no pairs. Ties are broken by the item's bytes.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.sinks.scratch import materialize

MIN_DOCUMENTS, TOP_TERMS = 3, 200
SCALE = 1_000_000_000
#: Rows of a tile and columns of a block, about.
TILE, BLOCK = 64, 4096
#: Terms a task counts before it sends them on, and text bytes it takes at once.
HELD_TERMS, SLICE_BYTES = 200_000, 4_000_000
#: Quadrant pairs opened at once; bounds memory only.
OPEN = 1 << 16
_HALVES = np.arange(8)

#: Bytes of a term stay, A-Z lowered; what parts terms becomes a space. Bytes over 0x7F are parts of other characters.
_TERM_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c > 0x7F else 0x20 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM_BYTES).split()


def term_counts(rows: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), d (documents); term '' marks a group that is there."""
    read = rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))))
    names = ["lang", "source", "term", "n", "d"]

    def sent(held: dict) -> Iterator[pa.RecordBatch]:
        for (of_lang, of_source), (n, d) in held.items():
            terms = [b"", *n]
            columns = [
                pa.array([of_lang] * len(terms), pa.string()), pa.array([of_source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(d.__getitem__, n)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                for t, *group in zip(*(part.column(c).to_pylist() for c in ("text", "lang", "source"))):
                    n, d = held.setdefault(tuple(group), (Counter(), Counter()))
                    terms = terms_of(t)
                    n.update(terms)
                    d.update(set(terms))
                if sum(len(n) + 1 for n, _ in held.values()) > HELD_TERMS:
                    yield from sent(held)
                    held = {}
        yield from sent(held)

    found = read.mapInArrow(run, "lang string, source string, term string, n long, d long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


class Quadtree:
    """The cells of up to TILE rows by the columns of a block: values, and marks of quadrants that hold any."""

    def __init__(self, p: np.ndarray, there: np.ndarray):
        """``p``: probability of each cell, 0 where there is none."""
        self.rows, self.columns = p.shape
        self.p, self.levels = p, [there]
        while max(self.levels[-1].shape) > 1:
            at = self.levels[-1]
            at = np.pad(at, [(0, n % 2 if n > 1 else 0) for n in at.shape])
            if at.shape[0] > 1:
                at = at[::2] | at[1::2]
            if at.shape[1] > 1:
                at = at[:, ::2] | at[:, 1::2]
            self.levels.append(at)

    def raised(self, height: int) -> None:
        """Makes the tree as high as another one."""
        self.levels += [self.levels[-1]] * (height - len(self.levels))


def divergences(a: Quadtree, b: Quadtree, zero_a: np.ndarray, zero_b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all columns of the shares of every row of ``a`` against every row of ``b``, and the other way round.

    ``zero_*``: the probability a row gives a term it lacks. ``same``: both are
    one tile, of which only pairs of a row and a later one are wanted.
    """
    height = max(len(a.levels), len(b.levels))
    a.raised(height)
    b.raised(height)
    forth = np.zeros((a.rows, b.rows), np.int64)
    back = np.zeros((a.rows, b.rows), np.int64)
    #: By level, columns at which both sides are empty, for each pair of row quadrants.
    empty = [np.zeros((x.shape[0], y.shape[0]), np.int64) for x, y in zip(a.levels, b.levels)]
    start = np.zeros(1, np.int64)
    stack = [(height - 1, start, start, start)] if a.rows and b.rows and a.columns else []
    while stack:
        level, i, j, c = stack.pop()
        if len(i) > OPEN:
            stack += [(level, i[k : k + OPEN], j[k : k + OPEN], c[k : k + OPEN]) for k in range(0, len(i), OPEN)]
            continue
        marked = a.levels[level][i, c] | b.levels[level][j, c]
        wide = np.minimum((c + 1) << level, a.columns) - (c << level)
        np.add.at(empty[level], (i[~marked], j[~marked]), wide[~marked])
        i, j, c = i[marked], j[marked], c[marked]
        if level == 0:
            p, q = a.p[i, c], b.p[j, c]
            p, q = np.where(p > 0, p, zero_a[i]), np.where(q > 0, q, zero_b[j])
            square = (p - q) ** 2
            np.add.at(forth, (i, j), square // q)
            np.add.at(back, (i, j), square // p)
            continue
        below = level - 1
        # All eight halves together: one frontier a level, cut only where it is too long.
        x, y, z = (np.add.outer(n << 1, _HALVES >> k & 1).reshape(-1) for k, n in enumerate((i, j, c)))
        on = (x < a.levels[below].shape[0]) & (y < b.levels[below].shape[0]) & (z < a.levels[below].shape[1])
        if same:
            on &= x <= y if below else x < y
        if on.any():
            stack.append((below, x[on], y[on], z[on]))
    for level in range(height - 1, 0, -1):
        below = empty[level - 1]
        below += np.repeat(np.repeat(empty[level], 2, 0), 2, 1)[: below.shape[0], : below.shape[1]]
    square = (zero_a[:, None] - zero_b[None, :]) ** 2
    return forth + empty[0] * (square // zero_b[None, :]), back + empty[0] * (square // zero_a[:, None])


def _probabilities(n: np.ndarray, size: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(SCALE (n + 1) / (size + kept)); counts too great for 64 bits go through whole numbers of any size."""
    wide = n.astype(object) if len(n) and int(n.max()) > 9_000_000_000 else n
    return (1 + SCALE * (wide + 1) // np.maximum(size + kept, 1)).astype(np.int64)


def _tile(sizes: np.ndarray, kept: int, width: int, cells) -> tuple[Quadtree, np.ndarray]:
    p = np.zeros((len(sizes), width), np.int64)
    if cells.is_valid:
        row, column, n = (cells.values.field(k).to_numpy().astype(np.int64) for k in ("at", "column", "n"))
        p[row, column] = _probabilities(n, sizes[row], kept)
    return Quadtree(p, p > 0), _probabilities(np.zeros(len(sizes), np.int64), sizes, kept)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            lang, kept, width, same = (batch.column(c)[row].as_py() for c in ("lang", "kept", "width", "same"))
            sides = []
            for members, cells in (("left", "left_cells"), ("right", "right_cells")):
                found = batch.column(members)[row].values
                sizes = found.field("size").to_numpy().astype(np.int64)
                sides.append((found.field("source").to_pylist(), *_tile(sizes, kept, width, batch.column(cells)[row])))
            (names_a, a, zero_a), (names_b, b, zero_b) = sides
            forth, back = divergences(a, b, zero_a, zero_b, same)
            i, j = np.nonzero(np.arange(a.rows)[:, None] < np.arange(b.rows)[None, :]) if same else np.indices(forth.shape).reshape(2, -1)
            first, second = [names_a[k] for k in i], [names_b[k] for k in j]
            columns = [[lang] * (2 * len(i)), first + second, second + first]
            value = np.concatenate((forth[i, j], back[i, j]))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(value)], names=["lang", "source", "item", "value"])


def audit(rows: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    spark = rows.sparkSession
    cells = materialize(spark, term_counts(rows, text, lang, source), "cells")
    counted = cells.where("term <> ''")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("d").alias("d")).where(F.col("d") >= min_documents).drop("d")
    kept = materialize(spark, kept, "kept-terms")
    groups = cells.where("term = ''").select("lang", "source")
    # One row per language; written, so Spark broadcasts it only if it is small and splits a large language otherwise.
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_size"))
    langs = groups.select("lang").distinct().join(langs, "lang", "left").fillna(0, ["kept", "lang_size"])
    langs = materialize(spark, langs, "langs")
    block = F.expr(f"CAST(pmod(xxhash64(term), CAST(ceil(kept / {BLOCK}) AS bigint)) AS int)")
    columns = kept.join(langs, "lang").withColumn("block", block).groupBy("lang", "block").agg(F.sort_array(F.collect_list(F.struct("term", "total"))).alias("terms"))
    columns = materialize(spark, columns.select("lang", "block", F.posexplode("terms").alias("column", "t")).select("lang", "block", "column", "t.term", "t.total"), "columns")
    matrix = materialize(spark, counted.drop("d").join(columns, ["lang", "term"]), "matrix")

    sizes = matrix.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = groups.join(sizes, ["lang", "source"], "left").fillna(0, ["size"]).join(langs, "lang")
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("tile", F.floor(number / TILE).cast("int")).withColumn("at", number % TILE)
    groups = materialize(spark, groups, "groups")
    matrix = matrix.join(groups.drop("kept", "lang_size"), ["lang", "source"])
    return _pairs(matrix, columns, groups, langs).unionByName(_terms(matrix, langs, top_terms))


def _ranked(values: DataFrame, part: str, most: int | None = None) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = values.withColumn("rank", rank)
    ranked = ranked if most is None else ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(matrix: DataFrame, langs: DataFrame, most: int) -> DataFrame:
    """The terms a group has more of than its language, by their shares."""
    # Exact at any size: whole-number division of decimals.
    probability = "1 + (CAST({n} + 1 AS decimal(20,0)) * CAST(%d AS decimal(10,0))) div CAST({size} + kept AS decimal(20,0))" % SCALE
    found = matrix.join(langs, "lang").select(
        "lang", "source", F.col("term").alias("item"), F.expr(probability.format(n="n", size="size")).alias("p"), F.expr(probability.format(n="total", size="lang_size")).alias("q")
    )
    return _ranked(found.where("p > q").withColumn("value", F.expr("((p - q) * (p - q)) div q")), "term", most)


def _pairs(matrix: DataFrame, columns: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language."""
    tiles = groups.groupBy("lang", "tile").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "source", "size"))), lambda x: F.struct(x["source"], x["size"])).alias("members"))
    left, right = (tiles.select("lang", F.col("tile").alias(f"{s}_tile"), F.col("members").alias(s)) for s in ("left", "right"))
    blocks = columns.groupBy("lang", "block").agg(F.count("*").cast("int").alias("width"))
    # A block without columns: pairs of languages that keep no term are there too.
    blocks = blocks.unionByName(langs.select("lang", F.lit(-1).alias("block"), F.lit(0).alias("width")))
    todo = left.join(right, "lang").where("left_tile <= right_tile").join(blocks, "lang").join(langs, "lang")
    cells = matrix.groupBy("lang", "tile", "block").agg(F.collect_list(F.struct("at", "column", "n")).alias("cells"))
    for side in ("left", "right"):
        todo = todo.join(cells.select("lang", F.col("tile").alias(f"{side}_tile"), "block", F.col("cells").alias(f"{side}_cells")), ["lang", f"{side}_tile", "block"], "left")
    todo = todo.select("lang", "kept", "width", F.expr("left_tile = right_tile").alias("same"), "left", "right", "left_cells", "right_cells")
    values = todo.mapInArrow(_compare, "lang string, source string, item string, value long")
    return _ranked(values.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pair")
