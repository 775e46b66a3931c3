"""Repair of the structure of conversations at least cost.

A conversation's rows and the states of a grammar of roles, ``(s?(ua)+)?``, span
a lattice: keeping, re-roling, deleting a row and inserting an empty one are its
edges. Two searches by cost, one from the start and one from the end, settle
nodes until their radii together pass the cost of the best meeting found; then
every edge that leads from the forward radius into the settled reverse nodes is a
crossing of some cheapest path, and every cheapest path has one. Of all
crossings the one with the least concatenated audit wins. Labels carry the least
audit of their cost, taken in the order of the rows among equal costs.

Within one lattice two audits of equal cost between the same two nodes are never
a prefix of each other, since an audit's letters fix its path and more letters
are insertions, which cost. So the least audit of a chain of lattices is made of
the least audits of its links, and a conversation of any length is cut into
segments of bounded rows and bytes. Each segment is solved between all pairs of
states; the results are joined up a tree, level by level, in groups of bounded
size, and the chosen audit is dealt back to the segments.

Rows are dealt by range of (conversation, turn, role, text), so a conversation
with a third of all rows is many tasks. What a task must hold whole is one audit,
a byte a row, which is a value of the result; the hash of a repaired conversation
is taken from its segments in order, as a stream, in one task: a digest has no
parts that could be computed apart.

Defined results: order is by turn (nulls first), then role and text, then copies;
null text and role are one space, a null conversation or turn is one space in
the seed of the damage and a conversation or turn of its own. A row's faults are
judged as given, blank before duplicate before truncated. A role counts by its
first character; an empty one fits no state. Extra columns are not read; a very
long text is a segment of its own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices
from tidemark.sinks.scratch import materialize

#: Rows and text bytes of a segment; links joined at once on a level of the tree.
SEGMENT_ROWS, SEGMENT_BYTES, LINKS = 2048, 1 << 20, 32
SLICE_BYTES = 4_000_000
#: Lattices of up to so many rows are remembered, so many of them.
REMEMBERED_ROWS, REMEMBERED = 24, 20_000

# The costs.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States: nothing yet, after the system's row, after the user's, after the assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: A whole conversation ends in one of these.
ENDS = (START, ASSISTANT)
#: What each state is left for: the next row's role, by its first character.
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: Re-roling and inserting give a user or an assistant only.
MADE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Audit letters, the role told apart within the order D < I < K < R; ``plain`` makes them initials.
LETTER = {("I", ASSISTANT): "I", ("I", USER): "J", ("R", ASSISTANT): "R", ("R", USER): "S"}
_PLAIN = str.maketrans({"J": "I", "S": "R"})
GRAMMAR = ("su", "ua", "au")
_BLANKS = " \t\n\x0b\x0c\r"
OK, BLANK, DUPLICATE, CUT = "", "b", "d", "t"


def plain(audit: str) -> str:
    return audit.translate(_PLAIN)


# A lattice is a tuple of rows (first character of the role, fault). A node is (row, state).


def _edges(rows: tuple, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """(cost, letter, next row, next state) of every edit from a node."""
    made = MADE[state]
    yield INSERT, LETTER["I", made], i, made
    if i < len(rows):
        role, fault = rows[i]
        yield DELETE, "D", i + 1, state
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            if role in FOLLOWS[state]:
                yield more, "K", i + 1, FOLLOWS[state][role]
            yield REROLE + more, LETTER["R", made], i + 1, made


def _edges_into(rows: tuple, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """(cost, letter, row before, state before) of every edit into a node."""
    for before in range(4):
        for j in (i - 1, i):
            if j >= 0:
                for cost, letter, k, to in _edges(rows, j, before):
                    if (k, to) == (i, state):
                        yield cost, letter, j, before


class _Search:
    """Settles nodes by cost from one side; of equal cost, rows nearer to that side first."""

    def __init__(self, sources: list[tuple[int, int]], edges, forward: bool):
        self.edges, self.sign = edges, 1 if forward else -1
        self.label = {node: (0, "") for node in sources}
        self.settled: dict[tuple[int, int], int] = {}
        self.heap = [(0, self.sign * i, state) for i, state in sources]
        heapq.heapify(self.heap)

    def top(self) -> float:
        while self.heap and (self.sign * self.heap[0][1], self.heap[0][2]) in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def step(self) -> tuple[int, int]:
        cost, i, state = heapq.heappop(self.heap)
        node = (self.sign * i, state)
        self.settled[node] = cost
        audit = self.label[node][1]
        for more, letter, j, to in self.edges(*node):
            if (j, to) in self.settled:
                continue
            found = (cost + more, audit + letter if self.sign > 0 else letter + audit)
            known = self.label.get((j, to))
            if known is None or found < known:
                self.label[j, to] = found
                if known is None or found[0] < known[0]:
                    heapq.heappush(self.heap, (found[0], self.sign * j, to))
        return node


def cheapest(rows: tuple, start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Least cost and, of that cost, least audit from ``start`` before the rows to one of ``ends`` behind them."""
    goals = {(len(rows), e) for e in ends}
    ahead = _Search([(0, start)], lambda i, s: _edges(rows, i, s), True)
    behind = _Search(sorted(goals), lambda i, s: _edges_into(rows, i, s), False)
    best = float("inf")
    # Both radii together must pass the best meeting, so all crossings of its cost are inside.
    while (reach := ahead.top() + behind.top()) <= best and reach < float("inf"):
        near, far = (ahead, behind) if ahead.top() <= behind.top() else (behind, ahead)
        node = near.step()
        if node in far.label:
            best = min(best, near.settled[node] + far.label[node][0])
    if best == float("inf"):
        return None
    radius, found = ahead.top() - 1, []
    for node, cost in ahead.settled.items():
        audit = ahead.label[node][1]
        if node in goals and cost == best:
            found.append(audit)
        for more, letter, j, to in _edges(rows, *node):
            if cost + more > radius and (j, to) in behind.settled and cost + more + behind.settled[j, to] == best:
                found.append(audit + letter + behind.label[j, to][1])
    return int(best), min(found)


@lru_cache(REMEMBERED)
def _remembered(rows: tuple, start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    return cheapest(rows, start, ends)


def solve(rows: tuple, start: int = START, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    return (_remembered if len(rows) <= REMEMBERED_ROWS else cheapest)(rows, start, ends)


def repaired_lines(rows: list[tuple[str, str]], audit: str) -> list[str]:
    """``role:text`` of what an audit leaves of the rows (role, text)."""
    out, at = [], 0
    for letter in audit:
        if letter in "IJ":
            out.append("user:" if letter == "J" else "assistant:")
            continue
        role, text = rows[at]
        at += 1
        if letter != "D":
            out.append(f"{role if letter == 'K' else 'user' if letter == 'S' else 'assistant'}:{text}")
    return out


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text of the rows that the damage leaves, by the crc32 of their place."""
    kind = rows.schema[turn].dataType
    one = F.lit(" ")
    seed = F.crc32(F.concat(F.coalesce(F.col(conv).cast("string"), one), F.lit(":"), F.coalesce(F.col(turn).cast("string"), one))) % 20
    text_now = F.coalesce(F.col(text).cast("string"), one)
    role_now = F.coalesce(F.col(role).cast("string"), one)
    text_now = F.when(seed == 1, "").when(seed == 2, F.regexp_replace(text_now, "[.!?]", "")).otherwise(text_now)
    found = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast(kind).alias("turn"), F.when(seed == 4, "user").otherwise(role_now).alias("role"), text_now.alias("text"),
        F.when(seed == 3, 2).when(seed == 0, 0).otherwise(1).alias("copies"),
    )
    return found.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")


def _fault(text: str) -> str:
    seen = text.rstrip(_BLANKS)
    return BLANK if not seen else OK if seen[-1] in ".!?" else CUT


def segments(rows: DataFrame) -> DataFrame:
    """One row per segment of (conv, turn, role, text), whose rows stand in order: texts and faults as lists, turns summed up.

    ``seg`` ascends within a conversation. ``keys`` are hashes of role and text;
    a row whose hash stands earlier in its segment is marked as a duplicate here.
    """
    kind = rows.schema["conv"].dataType
    fields = [("seg", "bigint"), ("roles", "array<string>"), ("texts", "array<string>"), ("faults", "array<string>"), ("keys", "array<binary>"),
              ("turns", "bigint"), ("low", "bigint"), ("high", "bigint")]
    schema = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in fields)).fields])
    order = ["conv", "turn", "role", "text"]
    # Rows alike in all columns have any order; a number of their own keeps them from being one range.
    dealt = rows.withColumn("own", F.monotonically_increasing_id()).repartitionByRange(*order, "own").sortWithinPartitions(*order)
    dealt = dealt.withColumn("part", F.spark_partition_id()).select("part", "conv", F.col("turn").cast("bigint").alias("turn"), "role", "text")

    def closed(held: list, number: int) -> tuple:
        part, conv = held[0][0], held[0][1]
        seen: set[bytes] = set()
        faults, keys = [], []
        for _, _, _, role, text in held:
            key = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())
            fault = _fault(text)
            if fault != BLANK and key in seen:
                fault = DUPLICATE
            seen.add(key)
            faults.append(fault)
            keys.append(key)
        turns = [t for _, _, t, _, _ in held if t is not None]
        own = len(set(turns))
        return conv, part << 40 | number, [r[3] for r in held], [r[4] for r in held], faults, keys, own, min(turns, default=None), max(turns, default=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number, out, weight = [], 0, 0, [], 0

        def sent() -> pa.RecordBatch:
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        arrow = pa.schema([pa.field("conv", _arrow(kind)), ("seg", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                           ("faults", pa.list_(pa.string())), ("keys", pa.list_(pa.binary())), ("turns", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                for row in zip(*(c.to_pylist() for c in some.columns)):
                    if held and (row[1] != held[0][1] or len(held) == SEGMENT_ROWS or size + len(row[4]) > SEGMENT_BYTES):
                        out.append(closed(held, number))
                        weight += size + 64 * len(held)
                        held, size, number = [], 0, number + 1
                        if weight > SLICE_BYTES:
                            yield sent()
                            out, weight = [], 0
                    held.append(row)
                    size += len(row[4])
        if held:
            out.append(closed(held, number))
        if out:
            yield sent()

    return dealt.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def with_duplicates(segs: DataFrame) -> DataFrame:
    """Segments with ``links`` (segments of the conversation) and ``earlier``: keys that an earlier segment of it has.

    Only conversations of several segments are looked at. Counts and minima are
    combined before the shuffle, so a row that is repeated very often is no group.
    """
    links = segs.groupBy("conv").agg(F.count("*").alias("links"))
    links = links.where("links > 1")
    several = segs.join(links.select(F.col("conv").alias("_conv")), F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
    keys = several.select("conv", "seg", F.explode(F.array_distinct("keys")).alias("key"))
    first = keys.groupBy("conv", "key").agg(F.min("seg").alias("seg")).select(F.col("seg").alias("_seg"), F.col("key").alias("_key"))
    # A segment belongs to one conversation, so (segment, key) tells a row of ``first``.
    later = keys.join(first, (F.col("seg") == F.col("_seg")) & (F.col("key") == F.col("_key")), "left_anti")
    later = later.groupBy(F.col("seg").alias("_seg")).agg(F.collect_list("key").alias("earlier"))
    links = several.select("seg").distinct().select(F.col("seg").alias("_of"))
    marked = segs.join(links, F.col("seg") == F.col("_of"), "left").join(later, F.col("seg") == F.col("_seg"), "left")
    return marked.withColumn("whole", F.col("_of").isNull()).drop("_of", "_seg")


_LINK = "struct<source:int,target:int,cost:bigint,audit:string>"
_SUMMARY = ("seg bigint, whole boolean, n bigint, turns bigint, low bigint, high bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
            f"first string, last string, links array<{_LINK}>, segs array<bigint>, sizes array<int>, digest string")  # fmt: skip
_COUNTS = ("n", "turns", "blank", "duplicate", "truncated", "illegal")


def _summarise(segs: DataFrame) -> DataFrame:
    """Every segment's counts and cheapest paths: from start to end if it is the whole conversation, else between all states."""
    kind = segs.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL(_SUMMARY).fields])

    def one(row: dict) -> dict:
        earlier = set(row["earlier"] or ())
        faults = [DUPLICATE if f != BLANK and k in earlier else f for f, k in zip(row["faults"], row["keys"])]
        initials = [r[:1] for r in row["roles"]]
        rows = tuple(zip(initials, faults))
        digest = None
        if row["whole"]:
            cost, audit = solve(rows)
            links = [{"source": START, "target": START, "cost": cost, "audit": audit}]
            lines = repaired_lines(list(zip(row["roles"], row["texts"])), audit)
            digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        else:
            paths = ((s, e, solve(rows, s, (e,))) for s in range(4) for e in range(4))
            links = [{"source": s, "target": e, "cost": p[0], "audit": p[1]} for s, e, p in paths if p]
        return {
            "seg": row["seg"], "whole": row["whole"], "n": len(rows), "turns": row["turns"], "low": row["low"], "high": row["high"],
            "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
            "illegal": sum(a + b not in GRAMMAR for a, b in zip(initials, initials[1:])), "first": initials[0], "last": initials[-1],
            "links": links, "segs": [row["seg"]], "sizes": [len(rows)], "digest": digest,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                out = [{"conv": row["conv"], **one(row)} for row in some.to_pylist()]
                yield pa.RecordBatch.from_pylist(out, schema=_arrow_schema(schema))

    return segs.select("conv", "seg", "whole", "roles", "texts", "faults", "keys", "earlier", "turns", "low", "high").mapInArrow(run, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, _arrow(f.dataType)) for f in schema.fields])


def _joined(a: dict, b: dict) -> dict:
    """The summary of two neighbouring stretches of a conversation."""
    out = {k: a[k] + b[k] for k in _COUNTS}
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    out["illegal"] += a["last"] + b["first"] not in GRAMMAR
    lows, highs = ([x[k] for x in (a, b) if x[k] is not None] for k in ("low", "high"))
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for x in a["links"]:
        for y in b["links"]:
            if x["target"] == y["source"]:
                found = (x["cost"] + y["cost"], x["audit"] + y["audit"])
                way = (x["source"], y["target"])
                if way not in best or found < best[way]:
                    best[way] = found
    links = [{"source": s, "target": e, "cost": c, "audit": w} for (s, e), (c, w) in best.items()]
    return out | {
        "seg": a["seg"], "whole": False, "low": min(lows, default=None), "high": max(highs, default=None), "first": a["first"], "last": b["last"],
        "links": links, "segs": a["segs"] + b["segs"], "sizes": a["sizes"] + b["sizes"], "digest": None,
    }


def _chain(parts: list[dict]) -> dict:
    """Neighbours joined pairwise until one is left."""
    while len(parts) > 1:
        parts = [_joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _combine(parts: DataFrame) -> DataFrame:
    """The stretches of every conversation joined up a tree, LINKS neighbours at a time."""
    spark, schema = parts.sparkSession, parts.schema
    names = [f.name for f in schema.fields if f.name != "conv"]
    shape = T.StructType([T.StructField("conv", schema["conv"].dataType), T.StructField("parts", T.ArrayType(T.StructType([schema[n] for n in names])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                conv, found = (c[row].as_py() for c in batch.columns)
                one = {"conv": conv, **_chain(sorted(found, key=lambda p: p["seg"]))}
                yield pa.RecordBatch.from_pylist([one], schema=_arrow_schema(schema))

    while True:
        most = parts.groupBy("conv").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return parts
        # Places in a conversation: ranks of its segments, which are 1/SEGMENT_ROWS of its rows; only their numbers are ranked.
        places = parts.select("conv", "seg").withColumn("place", _place())
        grouped = parts.join(places.select(F.col("seg").alias("_seg"), "place"), F.col("seg") == F.col("_seg")).drop("_seg")
        grouped = grouped.groupBy("conv", F.floor(F.col("place") / LINKS).alias("group")).agg(F.collect_list(F.struct(*names)).alias("parts"))
        parts = materialize(spark, grouped.select("conv", "parts").to(shape).mapInArrow(run, schema), "stretches")


def _place() -> Column:
    from pyspark.sql import Window

    return F.row_number().over(Window.partitionBy("conv").orderBy("seg")) - 1


def _finished(parts: DataFrame) -> DataFrame:
    """Of every whole stretch the least (cost, audit) from START to an end."""
    good = F.filter("links", lambda x: (x["source"] == START) & x["target"].isin(*ENDS))
    least = F.array_min(F.transform(good, lambda x: F.struct(x["cost"].alias("cost"), x["audit"].alias("audit"))))
    return parts.withColumn("least", least).withColumns({"cost": F.col("least.cost"), "edits": F.col("least.audit")}).drop("least", "links")


def _digests(segs: DataFrame, done: DataFrame) -> DataFrame:
    """conv, digest of the conversations of several segments: audits dealt back to the segments, repaired text hashed in order."""
    kind = segs.schema["conv"].dataType
    pieces = T.StructType.fromDDL("seg bigint, piece string")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                letters = np.frombuffer(row["edits"].encode(), np.uint8)
                # Ends behind the segment's last edit of a row; what is inserted there goes to the next segment, at the end to the last.
                takes = np.flatnonzero(~np.isin(letters, list(b"IJ")))
                ends = [int(takes[n - 1]) + 1 for n in np.cumsum(row["sizes"])]
                ends[-1] = len(letters)
                found = [row["edits"][a:b] for a, b in zip([0, *ends[:-1]], ends)]
                yield pa.RecordBatch.from_arrays([pa.array(row["segs"], pa.int64()), pa.array(found, pa.string())], names=["seg", "piece"])

    dealt = done.select("edits", "segs", "sizes").mapInArrow(deal, pieces).withColumnRenamed("seg", "_seg")
    written = segs.select("conv", "seg", "roles", "texts").join(dealt, F.col("seg") == F.col("_seg")).drop("_seg")
    chunk = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL("seg bigint, chunk binary").fields])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                out = []
                for row in batch.slice(at, 16).to_pylist():
                    lines = repaired_lines(list(zip(row["roles"], row["texts"])), row["piece"])
                    if lines:
                        out.append({"conv": row["conv"], "seg": row["seg"], "chunk": "\n".join(lines).encode()})
                yield pa.RecordBatch.from_pylist(out, schema=_arrow_schema(chunk))

    result = T.StructType([T.StructField("conv", kind), T.StructField("digest", T.StringType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                of, text = batch.column("conv")[row].as_py(), batch.column("chunk")[row].as_py()
                if state is not None and of == conv:
                    state.update(b"\n")
                else:
                    if state is not None:
                        yield pa.RecordBatch.from_pylist([{"conv": conv, "digest": state.hexdigest()}], schema=_arrow_schema(result))
                    conv, state = of, hashlib.sha256()
                state.update(text)
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv": conv, "digest": state.hexdigest()}], schema=_arrow_schema(result))

    chunks = materialize(segs.sparkSession, written.mapInArrow(write, chunk), "repaired")
    return chunks.repartition("conv").sortWithinPartitions("conv", "seg").mapInArrow(hashed, result)


def repair(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of every conversation of (conv, turn, role, text): conv, counts, cost, ``edits`` (letters with roles), digest."""
    spark = rows.sparkSession
    segs = materialize(spark, segments(rows), "segments")
    marked = with_duplicates(segs)
    parts = materialize(spark, _summarise(marked), "summaries")
    long = _finished(_combine(parts.where("NOT whole")))
    long = materialize(spark, long, "long-conversations")
    digests = _digests(segs, long).select(F.col("conv").alias("_conv"), F.col("digest").alias("_digest"))
    long = long.join(digests, F.col("conv").eqNullSafe(F.col("_conv")), "left").withColumn("digest", F.coalesce("_digest", F.lit(hashlib.sha256().hexdigest())))
    columns = ["conv", *_COUNTS, "low", "high", "cost", "edits", "digest"]
    # A whole conversation has the one path it needs.
    return _finished(parts.where("whole")).select(*columns).unionByName(long.select(*columns))


def audit(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of the table: the faults that the damage leaves, and the cheapest repair."""
    found = repair(damage(rows, conv, turn, role, text))
    every = rows.select(F.col(conv).alias("conv_id")).distinct()
    found = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")

    def count(name: Column | str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long")

    return found.select(
        F.col("conv_id").alias(conv),
        count(F.col("high") - F.col("low") + 1 - F.col("turns")).alias("gaps"),
        *(count(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.translate(F.coalesce("edits", F.lit("")), "JS", "IR").alias("audit"),
        F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
