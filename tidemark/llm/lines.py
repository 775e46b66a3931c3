"""Frequent lines, removed from all documents but one, over levelled sorted runs of line hashes.

Documents come in batches, from the largest ids down. A batch's distinct lines,
as 128-bit hashes, become a run: a table sorted by hash within buckets, with the
number of documents that hold each line. The new run is merge-anti-joined with
the runs before it; what is left are lines not seen so far, whose holder with the
largest id in this batch is the one that keeps them. Every other (line, document)
pair is a repeat and is written aside. When a level has ``fanout`` runs they are
compacted into one of the next level, counts added. Buckets are those of the
join, so a run is written once and never shuffled again. In the end the runs'
counts say which repeats are lost, so lines that occur once, which most do, are
out of the way early.

Hot lines: counts are combined before every shuffle; pairs are dealt by line and
document together. Lines that hold a thousandth of all pairs or more, a thousand
at most, are looked up by broadcast, so no line fills a task.

Defined results: null and empty text are one empty line. Lines are cut at \\n
only; a line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lowered. Rows that share an id are one document. Rows without an id are together
one document, smaller than all others. Ids are numbers. A very long text is a
batch of its own in its task. Other columns pass through; one with the name of a
result is replaced. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import lean, slices, unused
from tidemark.session import scratch_path
from tidemark.sinks.scratch import materialize

MIN_CHARS, MIN_DOCUMENTS = 40, 5
BATCHES, FANOUT = 4, 2
#: A line is hot if it has at least this share of all pairs, so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
SLICE_BYTES = 4_000_000
HASH = ["hi", "lo"]

_BLANKS = " \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def line_keys(text: str | None, min_chars: int) -> tuple[list[str], list[bytes | None]]:
    """The lines of a text and the 128-bit hashes of their keys; None for keys that are too short."""
    lines = (text or "").split("\n")
    keys = (line.strip(_BLANKS) for line in lines)
    return lines, [xxhash.xxh3_128_digest(k.encode().translate(_LOWER)) if len(k) >= min_chars else None for k in keys]


def _pairs(rows: DataFrame, text: str, doc_id: str, min_chars: int) -> DataFrame:
    """(doc, hi, lo) of every line long enough, once per row."""
    source = rows.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    kind = source.schema["doc"].dataType
    schema = T.StructType([T.StructField("doc", kind), *(T.StructField(h, T.LongType()) for h in HASH)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = [{k for k in line_keys(t, min_chars)[1] if k} for t in part.column("text").to_pylist()]
                at = np.repeat(np.arange(len(found)), [len(x) for x in found])
                hashes = np.frombuffer(b"".join(k for x in found for k in x), "<i8").reshape(-1, 2)
                docs = part.column("doc").take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([docs, *(pa.array(np.ascontiguousarray(h)) for h in hashes.T)], names=["doc", *HASH])

    return source.mapInArrow(lean(run), schema)


class Runs:
    """Levels of sorted runs: hi, lo, n and the largest document of the batch a run is from."""

    def __init__(self, spark, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    def _written(self, rows: DataFrame) -> DataFrame:
        """One sorted file a bucket, so that joins by hash read the run as it lies."""
        name = f"run_{uuid.uuid4().hex}"
        dealt = rows.repartition(self.buckets, *HASH)
        dealt.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", scratch_path(self.spark, "run")).saveAsTable(name)
        run = self.spark.table(name).select("*")
        run.schema  # resolved before the name goes; the files stay
        self.spark.sql(f"DROP TABLE {name}")
        return run

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds a batch (hi, lo, n, top) as a run; returns those of its rows whose hash no earlier run has."""
        earlier = self.all()
        run = self._written(batch)
        new = reduce(lambda left, old: left.join(old.select(*HASH).hint("merge"), HASH, "left_anti"), earlier, run)
        new = materialize(self.spark, new, "new-lines") if earlier else new
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run.select(*HASH, "n"))
        self._compact()
        return new

    def _compact(self) -> None:
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._written(self._sum(runs)))
                runs.clear()

    @staticmethod
    def _sum(runs: list[DataFrame]) -> DataFrame:
        """Sorted runs merged into one, counts added."""

        def merged(left: DataFrame, right: DataFrame) -> DataFrame:
            both = left.join(right.withColumnRenamed("n", "m").hint("merge"), HASH, "full_outer")
            return both.select(*HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

        return reduce(merged, runs)

    def counts(self) -> DataFrame:
        """Documents of every line: hi, lo, n."""
        runs = self.all()
        return runs[0] if len(runs) == 1 else self._sum(runs)


def _batches(rows: DataFrame, doc_id: str, n: int) -> list[float]:
    """Ids that part the rows into about equal batches, from the largest down; at most n - 1 of them."""
    shares = [i / n for i in range(n - 1, 0, -1)]
    bounds = rows.agg(F.percentile_approx(doc_id, shares, 1000)).first()[0] if shares else None
    return sorted(set(bounds or []), reverse=True)


def dropped_lines(rows: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
                  batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc, hi, lo) of every line a document loses."""
    spark = rows.sparkSession
    bounds = _batches(rows, doc_id, batches)
    number = reduce(lambda n, b: n + F.when(F.col("doc") > b, 0).otherwise(1), bounds, F.lit(0))
    pairs = _pairs(rows, text, doc_id, min_chars).withColumn("batch", number)
    path = scratch_path(spark, "line-pairs")
    pairs.write.partitionBy("batch").parquet(path)
    pairs = spark.read.schema(pairs.schema).parquet(path)
    runs, repeats = Runs(spark, fanout), []
    for i in range(len(bounds) + 1):
        batch = pairs.where(F.col("batch") == i).select("doc", *HASH).distinct()
        new = runs.add(batch.groupBy(*HASH).agg(F.count("*").alias("n"), F.max("doc").alias("top")))
        kept = new.select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), "top")
        same = (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo")) & F.col("doc").eqNullSafe(F.col("top"))
        repeats.append(materialize(spark, batch.join(kept, same, "left_anti"), "line-repeats"))
    counts = runs.counts()
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = materialize(spark, counts.where(F.col("n") >= min_documents), "frequent-lines")
    repeats = reduce(DataFrame.unionByName, repeats)
    # At most 1 / HOT_SHARE lines can have this many pairs, whatever the input.
    hot = F.broadcast(frequent.where(F.col("n") >= total * HOT_SHARE).select(*HASH))
    rest = frequent.where(F.col("n") < total * HOT_SHARE).select(*HASH)
    lost = repeats.join(hot, HASH, "left_semi").unionByName(repeats.join(hot, HASH, "left_anti").join(rest, HASH, "left_semi"))
    return lost.select("doc", *HASH)


def remove_lines(rows: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
                 kept: str = "kept", batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Adds the text without its lost lines, the number of lines before and of lost lines (``n_lines, n_dropped``)."""
    results = [kept, "n_lines", "n_dropped"]
    names = [c for c in rows.columns if c not in results]
    owner, lost = unused([*rows.columns, *results], "owner"), unused([*rows.columns, *results], "lost")
    gone = dropped_lines(rows, text, doc_id, min_chars, min_documents, batches, fanout)
    gone = gone.groupBy(F.col("doc").alias(owner)).agg(F.collect_list(F.struct(*HASH)).alias(lost))
    joined = rows.join(gone, rows[doc_id].eqNullSafe(gone[owner]), "left").drop(owner)
    kinds = [f for f in rows.schema.fields if f.name in names]
    schema = T.StructType([*kinds, T.StructField(kept, T.StringType()), *(T.StructField(n, T.LongType()) for n in results[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                out: tuple[list, list, list] = ([], [], [])
                for t, gone in zip(part.column(text).to_pylist(), part.column(lost)):
                    lines, keys = (t or "").split("\n"), None
                    left = lines
                    if gone.is_valid:
                        hashes = np.column_stack([gone.values.field(h).to_numpy() for h in HASH]).astype("<i8").tobytes()
                        bad = {hashes[i : i + 16] for i in range(0, len(hashes), 16)}
                        lines, keys = line_keys(t, min_chars)
                        left = [line for line, key in zip(lines, keys) if key not in bad]
                    for column, value in zip(out, ("\n".join(left), len(lines), len(lines) - len(left))):
                        column.append(value)
                arrays = [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *arrays], names=[*names, *results])

    return joined.select(*dict.fromkeys([*names, text, lost])).mapInArrow(lean(run), schema)
