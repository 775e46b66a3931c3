"""Mixing sources to target weights by Poisson replication.

A document of a source whose target is ``rate`` times what it has is repeated a
Poisson-distributed number of times with that mean, found by inverting the
distribution at a number hashed from the seed and the document's id. Targets are
met in expectation, without a count of what was taken so far, so every document
is decided alone. The copies are then dealt and sorted by a hash: a global shuffle.

A rate above ``STEP`` is a sum of equal smaller ones, each with a draw of its
own, so that tables of the distribution stay short; sums of Poisson numbers are
Poisson.

Defined results: sizes are characters plus one, so null and empty texts have a
weight. Rows without a source are the source null. A source without a target
weight, or with weight 0, gives no copies; weights without a source are unused,
and the others are scaled to 1. Rows with the same id draw alike; each is repeated.
An empty table gives an empty one. Extra columns pass through; columns called
``copy`` and ``shuffle_key`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.scratch import materialize

SEED = 17
#: Largest mean of a single draw.
STEP = 32.0
#: The tables end where less than 2^-52, the grain of the draws, is left at any mean up to STEP.
LAST = 120


def unit(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits, hashed from the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_sizes(documents: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Size of every source: source, size."""
    size = F.coalesce(F.length(F.col(text)), F.lit(0)) + F.lit(1)
    return documents.groupBy(F.col(source).alias("source")).agg(F.sum(size.cast("long")).alias("size"))


def tempered_weights(sizes: DataFrame, power: float = 0.5) -> DataFrame:
    """Weights in proportion to a power of the sizes: 1 keeps the mix, 0 makes all sources equal."""
    return sizes.select("source", F.pow("size", F.lit(power)).alias("weight"))


def rates(sizes: DataFrame, weights: DataFrame, budget: float | None = None) -> DataFrame:
    """Mean number of copies for each source: source, rate. ``budget`` is the wanted size of the mix, by default what there is."""
    given = weights.select(F.col("source").alias("of"), F.col("weight"))
    both = sizes.join(given, F.col("source").eqNullSafe(F.col("of"))).where("weight > 0")
    weighed = both.agg(F.sum("weight")).first()[0]
    there = sizes.agg(F.sum("size")).first()[0]
    wanted = there if budget is None else budget
    return both.select("source", (F.col("weight") / F.lit(weighed) * F.lit(wanted) / F.col("size")).cast("double").alias("rate"))


def _distribution(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... of a Poisson number."""
    first = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))
    step = lambda a, k: F.struct(
        (a["p"] * mean / k).alias("p"), F.concat(a["sums"], F.array(F.element_at(a["sums"], -1) + a["p"] * mean / k)).alias("sums")
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(LAST)), first, step, lambda a: a["sums"])


def replicate(documents: DataFrame, rate: DataFrame, key: str = "doc_id", source: str = "source", seed: int = SEED) -> DataFrame:
    """Every document as often as its draw says, with the number of the copy from 1, in no order yet."""
    drawn = rate.where("rate > 0").withColumn("draws", F.ceil(F.col("rate") / STEP))
    drawn = drawn.select(F.col("source").alias("_of"), F.col("draws").alias("_draws"), _distribution(F.col("rate") / F.col("draws")).alias("_sums"))
    # Written, so that Spark knows the size and broadcasts only a small one.
    drawn = materialize(documents.sparkSession, drawn, "mix-rates")
    draws = F.transform(F.sequence(F.lit(1).cast("long"), F.col("_draws")), lambda d: unit(F.lit(str(seed)), F.col(key).cast("string"), d.cast("string")))
    copies = F.aggregate(draws, F.lit(0), lambda a, u: a + F.size(F.filter("_sums", lambda p: p <= u)))
    joined = documents.drop("copy", "shuffle_key").join(drawn, F.col(source).eqNullSafe(F.col("_of")))
    counted = joined.withColumn("_copies", copies).where("_copies > 0")
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_of", "_draws", "_sums", "_copies")


def shuffle(rows: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Rows dealt by a hash and sorted by it within each part; the hash, ``shuffle_key``, is a global order."""
    order = unit(F.lit(f"{seed}-order"), F.col(key).cast("string"), F.col("copy").cast("string"))
    return rows.withColumn("shuffle_key", order).repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key", key, "copy")


def mix(documents: DataFrame, weights: DataFrame | None = None, budget: float | None = None, text: str = "text", key: str = "doc_id", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mix: copies of documents in shuffled order, with ``copy`` and ``shuffle_key``."""
    sizes = materialize(documents.sparkSession, source_sizes(documents, text, source), "mix-sizes")
    rate = rates(sizes, tempered_weights(sizes) if weights is None else weights, budget)
    return shuffle(replicate(documents, rate, key, source, seed), key, seed)
