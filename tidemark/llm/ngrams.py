"""Katz back-off language model: Good-Turing discounts, exactly normalised weights.

With h the n - 1 tokens before w, p(w | h) is d(c(h,w)) c(h,w) / c(h) for n-grams seen
in training and a(h) p(w | h') for others, where h' lacks the first token of h and
a(h) shares what the discounts leave; and so on down to p(w), which is discounted
too: what it leaves is the probability of an unknown word, a single event. Each
text starts from contexts of its own and ends with one end token.

Counts live in tables parted by word and by context. Documents are dealt into
groups of bounded size and shuffled once:

1. A group sends its distinct words and their training counts to the words' parts,
   which answer with counts over all documents.
2. For n = 2 to the order, it sends its distinct n-grams, each with its word's probability
   under the shorter context, to the contexts' parts, which add them up and answer with
   the n-grams' counts and, for contexts with unseen n-grams, with what their back-off
   weight is made of.
3. It evaluates its tokens: n-gram, else the weighted shorter one, and so on, else unknown.

Very frequent words, contexts and n-grams are sent once by each group. A context of more
than ``HOT`` tokens is split by a salt of the next word over several parts; each adds up its
share, and the small sums its weight is made of are added up by context and joined to the
groups that hold it. Counts of counts and totals go to every group in the same way. A group
sends to no more parts than it has words or n-grams.

Where Good-Turing gives no discount strictly between 0 and 1, (r - 1/2) / r is
used; a context, or the word table, of which no count is discounted keeps
n / (n + 1) of its probability.

Defined results: null text is empty and has only the end token. Rows with one
id are scored each; a row trains if its flag is true, and null is false. With no
training rows every token has probability 1. An empty table gives an empty one.
Extra columns are not carried, whatever their names; a very long text is one group's.
Words are told apart by a 64-bit hash, within one context by 48 bits of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, as_bytes, hash_slices, lean, mix, parts_for, slices, words
from tidemark.llm.repeats import _from_six, _part, _six

#: Largest count that is discounted.
TOP = 5
GROUP_BYTES, PART_BYTES, BATCH_BYTES = 10_000_000, 8_000_000, 1_000_000
#: Tokens after one context that meet in one part, about.
HOT = 400_000
BEGIN, END = np.uint64(1), np.uint64(2)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _pack(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def _open(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _start(level: int) -> np.uint64:
    """The context of a text's first token."""
    return BEGIN if level == 2 else mix(np.array([level], np.uint64) * _SPREAD)[0]


def _longer(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The context made of one and the word after it, by the word's upper 48 bits."""
    return mix(context * _SPREAD + (word >> np.uint64(16)))


def _salt_bits(tokens: np.ndarray, hot: int) -> np.ndarray:
    """Bits of the salt of contexts followed by so many tokens."""
    return np.ceil(np.log2(np.maximum(tokens / hot, 1))).astype(np.uint8)


class _Tokens:
    """All tokens of a group: token, row, whether it trains and begins its row; and distinct words."""

    def __init__(self, table: pa.Table):
        self.table = table.combine_chunks()
        token, row, at = [], [], 0
        for whole in self.table.to_batches():
            for part in slices(whole, "text", BATCH_BYTES):
                data, ends = as_bytes(part.column("text"))
                start, stop, owner = words(data, ends)
                n = part.num_rows
                size = np.bincount(owner, minlength=n) + 1 if n else np.zeros(0, int)
                own = np.full(int(size.sum()), END)
                own[np.arange(len(owner)) + owner] = np.maximum(hash_slices(LOWER[data], start, stop), np.uint64(3))
                token.append(own)
                row.append(np.repeat(np.arange(n), size) + at)
                at += n
        self.token, self.row = np.concatenate(token), np.concatenate(row)
        self.train = np.array(self.table["train"].to_pylist(), object).astype(bool)[self.row]
        self.begins = np.concatenate(([True], self.row[1:] != self.row[:-1]))
        self.words, self.word = np.unique(self.token, return_inverse=True)
        self.counts = np.bincount(self.word, self.train, len(self.words)).astype(np.int64)
        self.others = np.bincount(self.word, ~self.train, len(self.words)).astype(np.int64)

    def contexts(self, level: int, shorter: np.ndarray | None) -> np.ndarray:
        """Every token's context in n-grams of the level, from those of the level below."""
        out = np.roll(self.token if shorter is None else _longer(shorter, self.token), 1)
        out[self.begins] = _start(level)
        return out

    def before(self, values: np.ndarray, at: np.ndarray, first: int) -> np.ndarray:
        """The tokens' values one place before the given ones; ``first`` where a row begins."""
        return np.where(self.begins[at], first, values[at - 1])


class _Grams:
    """Distinct n-grams of a group, by context: ``of`` numbers each token's, ``at`` has one place of each."""

    def __init__(self, own: _Tokens, context: np.ndarray):
        order = np.lexsort((own.token, context))
        v, w = context[order], own.token[order]
        new = np.concatenate(([True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])))
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.at = order[new]
        self.counts = np.bincount(self.of, own.train, len(self.at)).astype(np.int64)
        self.others = np.bincount(self.of, ~own.train, len(self.at)).astype(np.int64)
        self.word, v = own.token[self.at], v[new]
        fresh = np.concatenate(([True], v[1:] != v[:-1]))
        self.contexts, self.context, self.first = v[fresh], np.cumsum(fresh) - 1, self.at[fresh]

    def deal(self, bits: np.ndarray, parts: int) -> None:
        """Sets the order in which n-grams are sent, and where parts and (part, context) runs start in it."""
        part, salted = _part(self.contexts, parts)[self.context], np.flatnonzero(bits[self.context])
        if len(salted):
            context = self.context[salted]
            salt = mix(self.word[salted]) & ((np.uint64(1) << bits[context].astype(np.uint64)) - np.uint64(1))
            part[salted] = _part(mix(self.contexts[context] + (salt + np.uint64(1)) * _SPREAD), parts)
        self.order = np.argsort(part, kind="stable")
        part, context = part[self.order], self.context[self.order]
        change = np.concatenate(([True], part[1:] != part[:-1]))
        self.starts = np.append(np.flatnonzero(change), len(part))
        self.parts = part[self.starts[:-1]]
        self.runs = np.append(np.flatnonzero(change | np.concatenate(([True], context[1:] != context[:-1]))), len(part))


def _rows(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


_WORDS = "part long, _g long, words binary, counts binary, others binary"


def _send_words(parts: int):
    def run(table: pa.Table) -> pa.Table:
        own, g = _Tokens(table), table["_g"][0].as_py()
        part = _part(own.words, parts)
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        rows = [
            (int(part[a]), g, own.words[a:b].tobytes(), _pack(own.counts[a:b], "<u4"), _pack(own.others[a:b], "<u4"))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)])
        ]
        return _rows(["part", "_g", "words", "counts", "others"], [pa.int64(), pa.int64(), *[pa.binary()] * 3], rows)

    return run


#: What parts return. "counts" is for a group. "sums" belongs to a context, or to all n-grams of the level (context 0), and is
#: still to be added up. "need" says that a group holds a context of the next level that is split.
_ANSWER = "_g long, level long, kind string, part long, counts binary, bits binary, flags binary, numbers binary, context long, sums array<double>"
_NAMES = ["_g", "level", "kind", "part", "counts", "bits", "flags", "numbers", "context", "sums"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), *[pa.binary()] * 4, pa.int64(), pa.list_(pa.float64())]
#: Sums have this many numbers; unused ones are 0.
_WIDTH = TOP + 4


def _sums(level: int, context: np.uint64 | int, values: np.ndarray | list) -> tuple:
    padded = [*map(float, values), *[0.0] * (_WIDTH - len(values))]
    return (-1, level, "sums", None, None, None, None, None, int(np.uint64(context).astype(np.int64)), padded)


def _need(g: int, level: int, context: np.uint64) -> tuple:
    return (g, level, "need", None, None, None, None, None, int(context.astype(np.int64)), None)


def _count_words(order: int, hot: int):
    def run(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(x, np.uint64) for x in table["words"].to_pylist()]
        counts, others = (np.concatenate([_open(x, "<u4") for x in table[c].to_pylist()]) for c in ("counts", "others"))
        distinct, number = np.unique(np.concatenate(sent), return_inverse=True)
        sums = np.bincount(number, counts, len(distinct)).astype(np.int64)
        bits = _salt_bits(sums + np.bincount(number, others, len(distinct)), hot)
        part, rows, at = table["part"][0].as_py(), [], 0
        for g, own in zip(table["_g"].to_pylist(), sent):
            mine = number[at : at + len(own)]
            at += len(own)
            rows.append((g, 1, "counts", part, _pack(sums[mine], "<u8"), _pack(bits[mine], "u1"), None, None, None, None))
            for word in own[bits[mine] > 0] if order > 1 else ():
                rows += [_need(g, n, _start(n)) for n in range(2, order + 1)] if word == END else [_need(g, 2, word)]
        of = np.bincount(np.minimum(sums, TOP + 2), minlength=TOP + 3)
        rows.append(_sums(1, 0, [sums.sum(), (sums > 0).sum(), sums[distinct == END].sum(), *of[1 : TOP + 2]]))
        return _rows(_NAMES, _KINDS, rows)

    return run


def discounts(of: np.ndarray) -> np.ndarray:
    """Factor of each count from 0 to TOP, by the numbers of events counted 1 ... TOP + 1 times; that of 0 is unused."""
    out = np.ones(TOP + 1)
    for r in range(1, TOP + 1):
        out[r] = (r - 0.5) / r
    n = of.astype(float)
    if (n > 0).all():
        cut = (TOP + 1) * n[TOP] / n[0]
        for r in range(1, TOP + 1):
            d = ((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut) if cut != 1 else 0.0
            if 0 < d < 1:
                out[r] = d
    return out


class _Words:
    """Probabilities of words by their counts."""

    def __init__(self, totals: list[float]):
        self.total, self.known, self.texts = map(int, totals[:3])
        of = np.array(totals[3:], np.int64)
        self.factor = discounts(of)
        r = np.arange(1, TOP + 1)
        self.scale = 1.0
        if self.total:
            left = float(((1 - self.factor[1:]) * r * of[:TOP]).sum()) / self.total
            if left <= 0:
                self.scale = self.total / (self.total + 1)
                left = 1 - self.scale
            self.unknown = left
        else:
            self.unknown = 1.0

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        factor = np.where(counts <= TOP, self.factor[np.minimum(counts, TOP)], 1.0)
        return np.where(counts > 0, self.scale * factor * counts / max(1, self.total), self.unknown)


def _log(p: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(p, np.finfo(float).tiny))


class _Known:
    """What a group was told: per level the counts by part, and sums by context."""

    def __init__(self, table: pa.Table):
        self.counts: dict[int, list[dict]] = {}
        self.sums: dict[int, dict[int, list[float]]] = {}
        for row in sorted(table.to_pylist(), key=lambda r: (r["level"], r["part"] or 0)):
            if row["kind"] == "counts":
                self.counts.setdefault(row["level"], []).append(row)
            else:
                self.sums.setdefault(row["level"], {})[row["context"]] = row["sums"]

    def column(self, level: int, name: str, kind: str) -> np.ndarray:
        return np.concatenate([_open(r[name], kind) for r in self.counts[level]])


class _Model:
    """Every token's probability, level by level."""

    def __init__(self, own: _Tokens, known: _Known, parts: int):
        self.own, self.known, self.parts, self.level = own, known, parts, 1
        self.words = _Words(known.sums[1][0])
        counts, bits = known.column(1, "counts", "<u8").astype(np.int64), known.column(1, "bits", "u1")
        ends = int(np.searchsorted(own.words, END))
        self.begin_bits = bits[ends]
        self.word_counts = self.counts = counts[own.word]
        self.bits, self.p, self.context = bits[own.word], self.words(counts)[own.word], None

    def grams(self) -> _Grams:
        """The n-grams of the next level, dealt to parts."""
        self.level += 1
        self.context = self.own.contexts(self.level, self.context)
        grams = _Grams(self.own, self.context)
        grams.bits = self.own.before(self.bits, grams.first, self.begin_bits)
        grams.deal(grams.bits, self.parts)
        return grams

    def rise(self, last: bool) -> None:
        """Evaluates the next level."""
        grams, known = self.grams(), self.known
        n, context, order = len(grams.contexts), grams.context, grams.order
        counts = np.empty(len(order), np.int64)
        counts[order] = known.column(self.level, "counts", "<u4")
        sums = known.sums[self.level]
        factor = discounts(np.array(sums[0][: TOP + 1], np.int64))
        before = self.own.before(self.counts, grams.first, self.words.texts)
        lacks, hot = np.bincount(context, counts == 0, n) > 0, grams.bits > 0
        sent = context[order][grams.runs[:-1]]
        whole, numbers = np.zeros(n, bool), np.zeros((n, TOP + 2))
        whole[sent] = known.column(self.level, "flags", "u1").astype(bool)
        numbers[sent[lacks[sent] & ~hot[sent]]] = known.column(self.level, "numbers", "<f8").reshape(-1, TOP + 2)
        for i in np.flatnonzero(hot).tolist():
            numbers[i] = sums[int(grams.contexts[i].astype(np.int64))][: TOP + 2]
            whole[i] = not numbers[i, 1 : TOP + 1].any()
        scale = np.where(whole, before / (before + 1.0), 1.0)
        seen = scale[context] * np.where(counts <= TOP, factor[np.minimum(counts, TOP)], 1.0) * counts / np.maximum(before, 1)[context]
        used = (numbers[:, 1 : TOP + 1] * factor[1:] * np.arange(1, TOP + 1)).sum(1) + numbers[:, TOP + 1]
        left = 1 - scale * used / np.maximum(before, 1)
        weight = np.where(before > 0, left / np.maximum(1 - numbers[:, 0], np.finfo(float).tiny), 1.0)
        self.p = np.where(counts > 0, seen, weight[context] * self.p[grams.at])[grams.of]
        self.counts = counts[grams.of]
        if not last:
            bits = np.empty(len(order), np.uint8)
            bits[order] = known.column(self.level, "bits", "u1")
            self.bits = bits[grams.of]


_GRAMS = "part long, _g long, contexts binary, hot binary, sizes binary, words binary, counts binary, others binary, lower binary, totals array<double>"


def _send_grams(level: int, order: int, parts: int):
    names = ["part", "_g", "contexts", "hot", "sizes", "words", "counts", "others", "lower", "totals"]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 7, pa.list_(pa.float64())]

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            own, known, g = _Tokens(table), _Known(answers), table["_g"][0].as_py()
            model = _Model(own, known, parts)
            for _ in range(2, level):
                model.rise(False)
            # A word's probability follows from its count, which packs better.
            lower, kind = (model.word_counts, "<u8") if level == 2 else (model.p, "<f8")
            grams = model.grams()
            context, runs = grams.context[grams.order], grams.runs
            cuts = np.searchsorted(runs, grams.starts)
            for p, a, b, c, d in zip(grams.parts.tolist(), grams.starts, grams.starts[1:], cuts, cuts[1:]):
                own_, who = grams.order[a:b], context[runs[c:d]]
                others = _pack(grams.others[own_], "<u4") if level < order else None
                rows.append(
                    (p, g, grams.contexts[who].tobytes(), _pack(grams.bits[who] > 0, "u1"), _pack(np.diff(runs[c : d + 1]), "<u4"), _six(grams.word[own_]),
                     _pack(grams.counts[own_], "<u4"), others, _pack(lower[grams.at[own_]], kind), known.sums[1][0])
                )
        return _rows(names, kinds, rows)

    return run


def _count_grams(level: int, order: int, most: int):
    def run(table: pa.Table) -> pa.Table:
        column = lambda n, kind: [_open(x, kind) for x in table[n].to_pylist()]
        contexts = [np.frombuffer(x, np.uint64) for x in table["contexts"].to_pylist()]
        sizes = [x.astype(np.int64) for x in column("sizes", "<u4")]
        known, of = np.unique(np.concatenate(contexts), return_inverse=True)  # numbers of contexts
        n, v = len(known), np.repeat(of, np.concatenate(sizes))
        hot = np.zeros(n, bool)
        hot[of] = np.concatenate(column("hot", "u1")).astype(bool)
        w = np.concatenate([_from_six(x) for x in table["words"].to_pylist()])
        by = np.lexsort((w, v))
        new = np.concatenate(([True], (v[by][1:] != v[by][:-1]) | (w[by][1:] != w[by][:-1])))
        number = np.empty(len(by), np.int64)
        number[by] = np.cumsum(new) - 1
        first = by[new]
        sums = np.bincount(number, np.concatenate(column("counts", "<u4")), len(first)).astype(np.int64)
        seen, context = sums > 0, v[first]
        if level == 2:
            share = _Words(table["totals"][0].as_py())(np.concatenate(column("lower", "<u8"))[first].astype(np.int64))
        else:
            share = np.concatenate(column("lower", "<f8"))[first]
        # Of each context: probability its seen words have in the shorter one, numbers of counts 1 ... TOP, sum of larger counts.
        numbers = np.zeros((n, TOP + 2))
        numbers[:, 0] = np.bincount(context[seen], share[seen], n)
        for r in range(1, TOP + 1):
            numbers[:, r] = np.bincount(context[sums == r], minlength=n)
        numbers[:, TOP + 1] = np.bincount(context[sums > TOP], sums[sums > TOP], n)
        whole = numbers[:, 1 : TOP + 1].sum(1) == 0
        bits = None
        if level < order:
            bits = _salt_bits(sums + np.bincount(number, np.concatenate(column("others", "<u4")), len(first)), most)
            bits[w[first] == END & ~np.uint64(0xFFFF)] = 0  # nothing follows an end
            next_ = _longer(known[context], w[first])
        part, rows, at, c_at = table["part"][0].as_py(), [], 0, 0
        for g, own, size in zip(table["_g"].to_pylist(), contexts, sizes):
            mine = number[at : at + int(size.sum())]
            at += len(mine)
            who = of[c_at : c_at + len(own)]
            c_at += len(own)
            lacks = np.bincount(np.repeat(np.arange(len(own)), size), sums[mine] == 0, len(own)) > 0
            told = numbers[who[lacks & ~hot[who]]]
            packed = None if bits is None else _pack(bits[mine], "u1")
            rows.append((g, level, "counts", part, _pack(sums[mine], "<u4"), packed, _pack(whole[who], "u1"), _pack(told, "<f8"), None, None))
            if bits is not None:
                rows += [_need(g, level + 1, x) for x in next_[mine[bits[mine] > 0]]]
        rows += [_sums(level, known[i], numbers[i]) for i in np.flatnonzero(hot)]
        rows.append(_sums(level, 0, np.bincount(np.minimum(sums, TOP + 2), minlength=TOP + 3)[1 : TOP + 2]))
        return _rows(_NAMES, _KINDS, rows)

    return run


def _score(order: int, parts: int):
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), *[pa.int64()] * 3, pa.float64(), pa.float64()]

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _rows(names, kinds, [])
        own = _Tokens(table)
        model = _Model(own, _Known(answers), parts)
        for level in range(2, order + 1):
            model.rise(level == order)
        n, counts, total = own.table.num_rows, model.word_counts, model.words.total
        base = np.log10((counts + 1) / (total + model.words.known + 1))
        per = lambda x: np.bincount(own.row, x, n)
        columns = [np.bincount(own.row, minlength=n), per(counts > 0).astype(np.int64), np.full(n, total), per(base), per(_log(model.p))]
        return pa.table([own.table["doc_id"].combine_chunks(), *(pa.array(c, k) for c, k in zip(columns, kinds[1:]))], names=names)

    return run


def score(documents: DataFrame, train: Column, key: str = "doc_id", text: str = "text", order: int = 2, hot: int = HOT) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row, learning from those where ``train`` holds.

    ``order`` is the length of the longest n-grams; contexts of more than ``hot`` tokens are split.
    """
    given = documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    total = documents.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 1)).first()[0] or 0
    groups, parts = parts_for(total, GROUP_BYTES), parts_for(total, PART_BYTES)
    own = given.withColumn("_g", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(groups)).cast("long"))
    every = documents.sparkSession.range(groups).select(F.col("id").alias("_g"), F.lit(0).cast("long").alias("context"))

    def told(answers: DataFrame, level: int, need: DataFrame) -> DataFrame:
        """The parts' answers to groups, and the sums of the contexts that a group needs."""
        sums = answers.where("kind = 'sums'").groupBy("context").agg(F.array(*(F.sum(F.col("sums")[i]) for i in range(_WIDTH))).alias("sums"))
        wanted = need.where(F.col("level") == level).select("_g", "context").unionByName(every).join(sums, "context")
        filled = wanted.withColumns({"level": F.lit(level).cast("long"), "kind": F.lit("sums"), "part": F.lit(None).cast("long")})
        empty = {c: F.lit(None).cast("binary") for c in ("counts", "bits", "flags", "numbers")}
        return answers.where("kind = 'counts'").unionByName(filled.withColumns(empty).select(_NAMES))

    sent = own.groupBy("_g").applyInArrow(lean(_send_words(parts)), _WORDS)
    answers = sent.groupBy("part").applyInArrow(lean(_count_words(order, hot)), _ANSWER)
    need = answers.where("kind = 'need'")
    known = told(answers, 1, need)
    for level in range(2, order + 1):
        grams = own.groupBy("_g").cogroup(known.groupBy("_g")).applyInArrow(lean(_send_grams(level, order, parts)), _GRAMS)
        answers = grams.groupBy("part").applyInArrow(lean(_count_grams(level, order, hot)), _ANSWER)
        known = known.unionByName(told(answers, level, need))
        if level < order:
            need = need.unionByName(answers.where("kind = 'need'"))
    return own.groupBy("_g").cogroup(known.groupBy("_g")).applyInArrow(
        lean(_score(order, parts)), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
