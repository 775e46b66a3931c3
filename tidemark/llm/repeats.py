"""Removal of long repeats across documents with run-length indexes.

Two equal strings of ``LENGTH`` bytes have the same minimiser, the smallest hash
of ``GRAM`` bytes inside them. So strings are dealt by minimiser, and each part
decides for itself:

1. Documents are dealt into groups of bounded size. A group sends each
   minimiser it holds once to that minimiser's part, which answers with those held by
   more than one document.
2. Of these, the group cuts the stretches of text whose strings share the minimiser,
   and sends each distinct stretch once, with the smallest document that has it.
3. A part collapses equal stretches, builds a run-length index of those that
   share a minimiser but differ, streams them through it, and answers for each
   which of its strings also start in a smaller document.
4. The group removes what those strings cover.

An equal stretch that very many documents have is sent once by each group. Around a
frequent line nearly every document's stretch differs, though all share a minimiser;
a minimiser with more than ``HOT`` stretches is therefore not dealt whole: a group sends
the distinct ``LENGTH``-byte strings in its stretches, each with its smallest document, to
parts by the hash of the string. So hot ones do not fill a part. The documents are
shuffled once; all steps read that shuffle.

Defined results: null text is empty; a document shorter than ``LENGTH`` bytes
loses nothing. Rows under one id never match each other. A row without an id keeps
all and counts for no other. An empty table gives an empty one. Matches are judged
on bytes and may cut a character; ``kept`` holds the remaining bytes, and where
text is asked for, bytes that are no whole character are left out of it. Extra columns
pass through; columns with a result's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import as_bytes, hash_slices, lean, mix, parts_for, slices
from tidemark.llm.rindex import RunIndex

LENGTH, GRAM = 50, 26
SPAN = LENGTH - GRAM + 1
#: Bytes of text in a group of documents, in a part of the minimisers, and worked on at once.
GROUP_BYTES, PART_BYTES, BATCH_BYTES = 3_000_000, 6_000_000, 500_000
#: Stretches of one minimiser that go to one part; of more, their strings are dealt.
HOT = 12_000
_LOW = np.uint64(63)


def stretches(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, row, start, end) of every maximal run of LENGTH-byte strings with one minimiser position."""
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none
    place = np.arange(len(data) - GRAM + 1)
    # The low bits tell the place; equal hashes nearby may be told apart either way, for
    # parts compare what the stretches hold and not how they were cut.
    least = hash_slices(data, place, place + GRAM) & ~_LOW | (place.astype(np.uint64) & _LOW)
    done = 1
    while 2 * done <= SPAN:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    least = np.minimum(least[: n], least[SPAN - done : SPAN - done + n])
    start = np.arange(n)
    where = start + ((least & _LOW).astype(np.int64) - start) % 64
    row = np.searchsorted(ends, start, side="right")
    inside = start + LENGTH <= ends[row]
    change = np.ones(n, bool)
    change[1:] = (where[1:] != where[:-1]) | (inside[1:] != inside[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], n) - 1
    fine = inside[first]
    first, last = first[fine], last[fine]
    return mix(least[first] >> np.uint64(6)), row[first], first, last + LENGTH


def _six(values: np.ndarray) -> bytes:
    """The upper 48 bits of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


class _Group:
    """A group's documents by id, and its stretches."""

    def __init__(self, table: pa.Table, key: str, text: str):
        table = table.combine_chunks()
        order = sorted(range(table.num_rows), key=lambda i: (table[key][i].as_py(), table[text][i].as_py() or ""))
        self.table = table.take(pa.array(order, pa.int64()))
        self.ids, self.text = self.table[key].to_numpy(), text

    def batches(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple]]:
        """First row, bytes, row ends and stretches of one batch after another."""
        at = 0
        for whole in self.table.to_batches():
            for part in slices(whole, self.text, BATCH_BYTES):
                data, ends = as_bytes(part.column(self.text))
                yield at, data, ends, stretches(data, ends)
                at += part.num_rows


def _send_minimisers(key: str, text: str, parts: int):
    def run(table: pa.Table) -> pa.Table:
        group = _Group(table, key, text)
        seen, docs = [], []
        for at, _, _, (minimiser, row, _, _) in group.batches():
            seen.append(minimiser & ~np.uint64(0xFFFF))
            docs.append(group.ids[row + at])
        seen, docs = np.concatenate([*seen, np.zeros(0, np.uint64)]), np.concatenate([*docs, np.zeros(0, np.int64)])
        order = np.lexsort((docs, seen))
        seen, docs = seen[order], docs[order]
        new = np.concatenate((np.ones(min(1, len(seen)), bool), seen[1:] != seen[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(seen)) - 1
        several = docs[first] != docs[last]
        # How often, as a rounded-up power of the fourth root of two.
        often = np.ceil(4 * np.log2(last - first + 1)).astype(np.uint8) | several.astype(np.uint8) << 7
        seen, press = seen[first], zstandard.ZstdCompressor(level=3).compress
        part = _part(seen, parts)
        order = np.argsort(part, kind="stable")
        part, seen, often = part[order], seen[order], often[order]
        cuts = np.flatnonzero(np.concatenate((np.ones(min(1, len(part)), bool), part[1:] != part[:-1])))
        rows = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]))
        return pa.table(
            [
                pa.array([int(part[a]) for a, _ in rows], pa.int64()),
                pa.array([table["_g"][0].as_py()] * len(rows), pa.int64()),
                pa.array([_six(seen[a:b]) for a, b in rows], pa.binary()),
                pa.array([press(often[a:b].tobytes()) for a, b in rows], pa.binary()),
            ],
            names=["part", "_g", "seen", "often"],
        )

    return run


def _part(minimiser: np.ndarray, parts: int) -> np.ndarray:
    return ((minimiser >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _answer_shared(table: pa.Table) -> pa.Table:
    seen = [_from_six(x) for x in table["seen"].to_pylist()]
    open_ = zstandard.ZstdDecompressor().decompress
    every, often = np.concatenate(seen), np.frombuffer(b"".join(map(open_, table["often"].to_pylist())), np.uint8)
    _, number, groups = np.unique(every, return_inverse=True, return_counts=True)
    shared = (groups[number] > 1) | (often > 127)
    hot = shared & (np.bincount(number, 2.0 ** ((often & 127) / 4), len(groups)) > HOT)[number]
    cuts = np.cumsum([0, *map(len, seen)])
    answers = [[_six(every[a:b][x[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])] for x in (shared, hot)]
    return pa.table([table["_g"].combine_chunks(), *(pa.array(x, pa.binary()) for x in answers)], names=["_g", "shared", "hot"])


class _Stretches:
    """Distinct stretches of a group that hold shared minimisers, by part, and where they are."""

    def __init__(self, group: _Group, shared: pa.Table, parts: int):
        known, hot = (np.sort(np.concatenate([*map(_from_six, shared[x].to_pylist()), np.zeros(0, np.uint64)])) for x in ("shared", "hot"))
        self.index: dict[bytes, int] = {}
        self.first: list[int] = []  # smallest document of each distinct stretch
        minimisers: list[int] = []
        self.found = []  # for each batch: distinct number and place of every stretch
        for at, data, ends, (minimiser, row, start, end) in group.batches():
            minimiser = minimiser & ~np.uint64(0xFFFF)
            place = np.minimum(np.searchsorted(known, minimiser), max(0, len(known) - 1))
            held = known[place] == minimiser if len(known) else np.zeros(len(minimiser), bool)
            minimiser, row, start, end = minimiser[held], row[held], start[held], end[held]
            whole, numbers, index = data.tobytes(), [], self.index
            for m, d, a, b in zip(minimiser.tolist(), group.ids[row + at].tolist(), start.tolist(), end.tolist()):
                number = index.setdefault(whole[a:b], len(index))
                if number == len(self.first):
                    self.first.append(d)
                    minimisers.append(m)
                numbers.append(number)
            self.found.append((np.array(numbers, np.int64), row, start, end))
        self.minimisers = np.array(minimisers, np.uint64)
        self.owner = np.array(self.first, np.int64)
        part = _part(self.minimisers, parts)
        split = np.isin(self.minimisers, hot)
        # In part order, stretches of one minimiser together: what is sent, and answered, has this order.
        self.order = np.lexsort((self.minimisers, part))
        self.order = self.order[~split[self.order]]
        self.part = part[self.order]
        self._split(np.flatnonzero(split), parts)

    def _split(self, stretches_: np.ndarray, parts: int) -> None:
        """Distinct strings of the stretches of hot minimisers, in part order, and each start's stretch, place and string."""
        every = list(self.index) if len(stretches_) else []
        some = [every[i] for i in stretches_.tolist()]
        data = np.frombuffer(b"".join(some), np.uint8)
        lengths = np.array(list(map(len, some)), np.int64)
        starts = lengths - LENGTH + 1
        self.split_stretch = np.repeat(stretches_, starts)
        self.split_place = np.arange(len(self.split_stretch)) - np.repeat(np.cumsum(starts) - starts, starts)
        at = np.repeat(np.cumsum(lengths) - lengths, starts) + self.split_place
        strings = data[at[:, None] + np.arange(LENGTH)] if len(at) else np.zeros((0, LENGTH), np.uint8)
        strings, self.split_string = _distinct(strings)
        self.string_owner = _smallest(self.owner[self.split_stretch], self.split_string, len(strings))
        first = np.arange(len(strings)) * LENGTH
        part = _part(hash_slices(strings.ravel(), first, first + LENGTH), parts)
        self.string_order = np.argsort(part, kind="stable")
        self.strings, self.string_part = strings[self.string_order], part[self.string_order]

    def marks(self, of_stretches: bytes, of_strings: list[np.ndarray]) -> np.ndarray:
        """The answers as bits of every distinct stretch."""
        bits = np.zeros(len(self.owner), np.uint32)
        bits[self.order] = np.frombuffer(of_stretches, "<u4")
        before = np.zeros(len(self.string_owner), bool)
        before[self.string_order] = np.concatenate([*of_strings, np.zeros(0, bool)])
        hit = before[self.split_string] | (self.string_owner[self.split_string] < self.owner[self.split_stretch])
        np.bitwise_or.at(bits, self.split_stretch[hit], np.uint32(1) << self.split_place[hit].astype(np.uint32))
        return bits


def _distinct(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of LENGTH bytes, and the number of each row's."""
    # Of one width, strings compare as their bytes do, zeros at the end included.
    distinct, number = np.unique(np.ascontiguousarray(strings).view(f"S{LENGTH}").ravel(), return_inverse=True)
    return distinct.view(np.uint8).reshape(-1, LENGTH), number


def _smallest(owners: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, number, owners)
    return out


def _send_stretches(key: str, text: str, parts: int):
    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        names, columns = ["part", "_g", "minimisers", "owners", "sizes", "data", "string_owners", "strings"], [[] for _ in range(8)]
        if table.num_rows and shared.num_rows:
            own = _Stretches(_Group(table, key, text), shared, parts)
            strings = list(own.index)
            g, press = table["_g"][0].as_py(), zstandard.ZstdCompressor(level=3).compress
            cuts, split = (np.searchsorted(x, np.arange(parts + 1)).tolist() for x in (own.part, own.string_part))
            owners = own.string_owner[own.string_order]
            for part, (a, b, c, d) in enumerate(zip(cuts[:-1], cuts[1:], split[:-1], split[1:])):
                if a < b or c < d:
                    at = own.order[a:b]
                    some = [strings[i] for i in at.tolist()]
                    row = (part, g, _six(own.minimisers[at]), press(own.owner[at].tobytes()), bytes(map(len, some)), press(b"".join(some)))
                    row += (press(owners[c:d].tobytes()), press(own.strings[c:d].tobytes())) if c < d else (None, None)
                    for column, value in zip(columns, row):
                        column.append(value)
        kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 6
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _answer_marks(table: pa.Table) -> pa.Table:
    """For each sent stretch, the strings in it that start in a smaller document: bit i for the one at i."""
    open_ = zstandard.ZstdDecompressor().decompress
    minimisers = np.concatenate([_from_six(x) for x in table["minimisers"].to_pylist()])
    owners = np.concatenate([np.frombuffer(open_(x), np.int64) for x in table["owners"].to_pylist()])
    sizes = [np.frombuffer(x, np.uint8) for x in table["sizes"].to_pylist()]
    strings = []
    for data, lengths in zip(map(open_, table["data"].to_pylist()), sizes):
        ends = np.cumsum(lengths, dtype=np.int64)
        strings += [data[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist())]
    # Equal stretches collapse to the one of the smallest document.
    index: dict[bytes, int] = {}
    first = np.empty(len(strings), np.int64)
    for i in np.argsort(owners, kind="stable").tolist():
        first[i] = index.setdefault(strings[i], i)
    marks = np.zeros(len(strings), np.uint64)
    kept = np.fromiter(index.values(), np.int64, len(index))
    kept = kept[np.argsort(minimisers[kept], kind="stable")]
    # A minimiser with one stretch has nothing left to match.
    _, at, count = np.unique(minimisers[kept], return_index=True, return_counts=True)
    for some in _bounded(kept, at[count > 1], count[count > 1]):
        lengths = np.array([len(strings[i]) for i in some], np.int64)
        data = np.frombuffer(b"".join([strings[i] for i in some]), np.uint8)
        marks[some] = RunIndex(data, lengths, owners[some], LENGTH).owned_before(owners[some])
    whole = np.array([(1 << (len(s) - LENGTH + 1)) - 1 for s in strings], np.uint64)
    marks = np.where(owners > owners[first], whole, marks[first])
    cuts = np.cumsum([0, *map(len, sizes)])
    answers = [marks[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
    of_strings = _answer_strings(table)
    return pa.table([table["_g"].combine_chunks(), table["part"].combine_chunks(), pa.array(answers, pa.binary()), pa.array(of_strings, pa.binary())], names=["_g", "part", "marks", "before"])


def _answer_strings(table: pa.Table) -> list[bytes | None]:
    """For each group's strings, packed, if a smaller document of another group has it."""
    open_ = zstandard.ZstdDecompressor().decompress
    owners = [np.frombuffer(open_(x), np.int64) if x else np.zeros(0, np.int64) for x in table["string_owners"].to_pylist()]
    if not any(map(len, owners)):
        return [None] * len(owners)
    strings = np.frombuffer(b"".join(open_(x) for x in table["strings"].to_pylist() if x), np.uint8).reshape(-1, LENGTH)
    distinct, number = _distinct(strings)
    every = np.concatenate(owners)
    before = _smallest(every, number, len(distinct))[number] < every
    cuts = np.cumsum([0, *map(len, owners)])
    return [np.packbits(before[a:b]).tobytes() if a < b else None for a, b in zip(cuts[:-1], cuts[1:])]


def _bounded(kept: np.ndarray, at: np.ndarray, count: np.ndarray, most: int = 12_000) -> Iterator[np.ndarray]:
    """Stretches of whole minimisers, about ``most`` at a time, for one index each."""
    some, size = [], 0
    for a, n in zip(at.tolist(), count.tolist()):
        some.append(kept[a : a + n])
        size += n
        if size >= most:
            yield np.concatenate(some)
            some, size = [], 0
    if some:
        yield np.concatenate(some)


def _remove(key: str, text: str, parts: int, names: list[str], as_text: bool):
    def run(table: pa.Table, shared: pa.Table, marks: dict[int, tuple[bytes, bytes | None]]) -> pa.Table:
        group = _Group(table, key, text)
        own = _Stretches(group, shared, parts)
        size = np.bincount(own.string_part, minlength=parts)
        before = [np.unpackbits(np.frombuffer(marks[p][1], np.uint8), count=size[p]).astype(bool) for p in sorted(marks) if size[p]]
        bits = own.marks(b"".join(marks[p][0] for p in sorted(marks)), before)
        sizes, removed, spans, kept = [], [], [], []
        for (at, data, ends, _), (number, row, start, end) in zip(group.batches(), own.found):
            edge = np.zeros(len(data) + 1, np.int64)
            later = group.ids[row + at] > own.owner[number]
            np.add.at(edge, start[later], 1)
            np.add.at(edge, end[later], -1)
            rest = np.flatnonzero(~later & (bits[number] > 0))
            for i in range(SPAN):
                hit = start[rest[(bits[number[rest]] >> np.uint32(i)) & 1 > 0]] + i
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + LENGTH, -1)
            gone = np.cumsum(edge[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            firsts = np.concatenate(([0], ends[:-1]))
            inner = firsts[firsts < ends]
            begins[inner] = gone[inner]
            total, starts = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(begins)))
            sizes.append(ends - firsts)
            removed.append(total[ends] - total[firsts])
            spans.append(starts[ends] - starts[firsts])
            kept += [data[a:b][~gone[a:b]].tobytes() for a, b in zip(firsts.tolist(), ends.tolist())]
        columns = [group.table[n].combine_chunks() for n in names]
        columns += [pa.array(np.concatenate(x), pa.int64()) for x in (sizes, removed, spans)]
        columns.append(pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()))
        return pa.table(columns, names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", as_text: bool = False) -> DataFrame:
    """Every row without the bytes covered by a 50-byte string that also starts under a smaller id.

    Adds n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary, or text if asked for).
    """
    results = ["n_bytes", "n_removed", "n_spans", "kept"]
    rows = documents.select(*(c for c in documents.columns if c not in results))
    rows = rows.withColumn(key, F.col(key).cast("long"))
    names = rows.columns
    total = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups, parts = parts_for(total, GROUP_BYTES), parts_for(total, PART_BYTES)
    own = rows.where(F.col(key).isNotNull()).withColumn("_g", F.pmod(F.xxhash64(key), F.lit(groups)).cast("long"))

    seen = own.groupBy("_g").applyInArrow(lean(_send_minimisers(key, text, parts)), "part long, _g long, seen binary, often binary")
    shared = seen.groupBy("part").applyInArrow(lean(_answer_shared), "_g long, shared binary, hot binary")
    sent = own.groupBy("_g").cogroup(shared.groupBy("_g")).applyInArrow(
        lean(_send_stretches(key, text, parts)),
        "part long, _g long, minimisers binary, owners binary, sizes binary, data binary, string_owners binary, strings binary",
    )
    marks = sent.groupBy("part").applyInArrow(lean(_answer_marks), "_g long, part long, marks binary, before binary")
    none = F.lit(None).cast("binary")
    answers = shared.withColumns({"part": F.lit(None).cast("long"), "marks": none, "before": none}).unionByName(
        marks.withColumns({"shared": none, "hot": none})
    )
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in results[:3]), T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    remove = _remove(key, text, parts, names, as_text)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table([pa.array([], f.type) for f in table.select(names).schema] + [pa.array([], pa.int64())] * 3 + [pa.array([], pa.string() if as_text else pa.binary())], names=[*names, *results])
        mine = {p: (m, b) for p, m, b in zip(*(answers[x].to_pylist() for x in ("part", "marks", "before"))) if m is not None}
        return remove(table, answers.filter(answers["shared"].is_valid()), mine)

    done = own.groupBy("_g").cogroup(answers.groupBy("_g")).applyInArrow(lean(finish), schema)
    size, whole = F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), F.coalesce(F.col(text), F.lit(""))
    without = rows.where(F.col(key).isNull()).select(
        "*", size.alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), (whole if as_text else whole.cast("binary")).alias("kept")
    )
    return done.unionByName(without)
