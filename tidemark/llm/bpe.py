"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regular expression. Every code point gets a class from
a table; the splitting pattern is a small automaton over these classes, with the
look-ahead (white space before white space, the length of a contraction after an
apostrophe) folded into the symbol. Each symbol is a function from state to
state. Those functions form a finite monoid, so the states of a whole batch come
from an associative scan over function numbers: blocks are composed in parallel,
then the blocks' results, then the states inside the blocks. A new document is
a constant function, so one scan serves all documents of a batch.

The slices go through a cache of merged pieces; those it lacks are merged together.
Merging takes the adjacent pair of lowest rank, leftmost first, with a heap for
long pieces.

Defined results: null and empty text give no ids and empty bytes. Text of any
length is encoded whole. Repeated rows get equal results. Ids outside the
vocabulary cannot be decoded and raise ``ValueError``. Other columns pass
through; a column with the name of a result is replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import lean, slices

#: Text bytes handled at once; bounds a worker's memory, not the text's length.
BATCH_BYTES = 2_000_000
#: Merged pieces a task remembers; when full, it starts anew.
CACHE_PIECES = 300_000
#: Longer pieces are merged one by one, with a heap.
LONG_PIECE = 64
#: Rank of a pair that does not merge.
NONE = 1 << 60

# The White_Space property, and the contractions of the pattern.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")

# Symbols of the automaton.
LETTER, NUMBER, OTHER, SHORT, LONG, JOINING, LONE, INNER = range(8)
# States: what is open before a code point.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_SPACE, TWO_LEFT, ONE_LEFT = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a piece starts at this code point)."""
    if symbol == LETTER and state in (TWO_LEFT, ONE_LEFT):
        return (ONE_LEFT if state == TWO_LEFT else FRESH), False
    if symbol == LETTER:
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_SPACE)
    if symbol in (OTHER, SHORT, LONG):
        if state in (IN_OTHERS, AFTER_SPACE):
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, SHORT: ONE_LEFT, LONG: TWO_LEFT}[symbol], True
    if symbol == JOINING:
        return AFTER_SPACE, True
    if symbol == LONE:
        return FRESH, True
    return IN_SPACE, state != IN_SPACE


class Automaton:
    """The step functions, numbered, with their composition table."""

    def __init__(self):
        steps = [tuple(_step(s, y)[0] for s in range(8)) for y in range(8)]
        # The first code point of a document forgets what was open before it.
        steps += [(f[FRESH],) * 8 for f in steps]
        known = {f: i for i, f in enumerate(dict.fromkeys(steps))}
        todo = list(known)
        while todo:
            f = todo.pop()
            for g in list(known):
                for h in (tuple(g[s] for s in f), tuple(f[s] for s in g)):
                    if h not in known:
                        known[h] = len(known)
                        todo.append(h)
        functions = list(known)
        self.size = len(functions)
        self.of_symbol = np.array([known[f] for f in steps], np.uint16)
        self.apply = np.array(functions, np.uint8)
        self.then = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
        starts = [[_step(s, y % 8)[1] or y >= 8 for y in range(16)] for s in range(8)]
        self.starts = np.array(starts, bool)

    def states(self, symbols: np.ndarray, block: int = 128) -> np.ndarray:
        """The state before every symbol, from FRESH."""
        n = len(symbols)
        if n <= block:
            out, state = np.empty(n, np.uint8), FRESH
            for i, f in enumerate(self.of_symbol[symbols].tolist()):
                out[i] = state
                state = int(self.apply[f, state])
            return out
        return self._scan(self.of_symbol[symbols], np.uint8(FRESH), block)

    def _scan(self, functions: np.ndarray, first: np.uint8, block: int) -> np.ndarray:
        n = len(functions)
        rows = -(-n // block)
        identity = self._identity()
        grid = np.full(rows * block, identity, np.uint16)
        grid[:n] = functions
        grid = np.ascontiguousarray(grid.reshape(rows, block).T)
        whole = grid[0].copy()
        for row in grid[1:]:
            whole = self.then[whole, row]
        if rows > block:
            state = self._scan(whole, first, block)
        else:
            state, now = np.empty(rows, np.uint8), first
            for i, f in enumerate(whole.tolist()):
                state[i] = now
                now = self.apply[f, now]
        out = np.empty((block, rows), np.uint8)
        for i, row in enumerate(grid):
            out[i] = state
            state = self.apply[row, state]
        return out.T.reshape(-1)[:n]

    def _identity(self) -> int:
        """The identity's number; it is added to the tables when first needed."""
        if not hasattr(self, "_one"):
            self._one = self.size
            numbers = np.arange(self.size, dtype=np.uint16)
            self.apply = np.vstack([self.apply, np.arange(8, dtype=np.uint8)])
            self.then = np.pad(self.then, ((0, 1), (0, 1)))
            self.then[-1, :-1] = self.then[:-1, -1] = numbers
            self.then[-1, -1] = self._one
        return self._one


@lru_cache(1)
def _automaton() -> Automaton:
    return Automaton()


@lru_cache(1)
def _classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or INNER of every code point, as the tokenizer library itself sees them."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    out = np.full(0x110000, OTHER, np.uint8)
    for symbol, kind in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        found = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={})
        chars = bytes(found.encode_ordinary(everything)).decode()
        out[np.frombuffer(chars.encode("utf-32-le"), np.uint32)] = symbol
    out[list(WHITE_SPACE)] = INNER
    return out


def symbols_of(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``ends`` are the documents' ends. The first of a document is raised by 8."""
    n = len(points)
    out = _classes()[points].copy()
    last = np.zeros(n, bool)
    last[ends[(ends > 0)] - 1] = True
    white = out == INNER
    before_text = np.zeros(n, bool)
    before_text[:-1] = ~white[1:]
    before_text &= ~last
    single = white & before_text
    out[single] = np.where(points[single] == 0x20, JOINING, LONE)
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        row_end = ends[np.searchsorted(ends, quotes, side="right")]
        one = np.where(quotes + 1 < row_end, points[np.minimum(quotes + 1, n - 1)], 0)
        two = np.where(quotes + 2 < row_end, points[np.minimum(quotes + 2, n - 1)], 0)
        for text in CONTRACTIONS:
            hit = one == ord(text[0])
            if len(text) == 2:
                hit = hit & (two == ord(text[1]))
            out[quotes[hit]] = LONG if len(text) == 2 else SHORT
    first = np.concatenate(([0], ends[:-1]))
    out[first[first < ends]] += 8
    return out


def piece_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces start in concatenated documents."""
    if not len(points):
        return np.zeros(0, np.int64)
    symbols = symbols_of(points, ends)
    return np.flatnonzero(_automaton().starts[_automaton().states(symbols), symbols])


class Vocabulary:
    def __init__(self, path: str):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.tokens = {i: t for t, i in self.ranks.items()}
        size = max(self.tokens) + 1
        sizes = np.array([len(self.tokens.get(i, b"")) for i in range(size)])
        self.sizes, self.at = sizes, np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.blob = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), np.uint8)
        self.cache: dict[str, bytes] = {}
        self._made: tuple[np.ndarray, np.ndarray] | None = None

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Mergeable pairs of ids as sorted keys, and the id each makes."""
        if self._made is None:
            ranks = self.ranks
            found = [
                (ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
            ]
            self._made = tuple(np.array(sorted(found), np.int64).reshape(-1, 2).T.copy())
        return self._made

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, made = self._pairs()
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        return np.where((keys[at] == pair) & (left >= 0) & (right >= 0), made[at], NONE)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece. One step merges the best pair of every piece at once."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(pieces)
        todo = []
        for i, piece in enumerate(pieces):
            if piece in self.ranks:
                out[i] = np.array([self.ranks[piece]])
            elif len(piece) > LONG_PIECE:
                out[i] = np.array(self._merge_long(piece))
            else:
                todo.append(i)
        todo.sort(key=lambda i: len(pieces[i]))
        single = np.array([self.ranks[bytes([i])] for i in range(256)])
        for some in (todo[i : i + 4096] for i in range(0, len(todo), 4096)):
            wide = len(pieces[some[-1]])
            data = np.frombuffer(b"".join(pieces[i].ljust(wide, b"\0") for i in some), np.uint8).reshape(-1, wide)
            ids = np.where(np.arange(wide) < np.array([len(pieces[i]) for i in some])[:, None], single[data], -1)
            index, ranks = np.array(some), self._rank(ids[:, :-1], ids[:, 1:])
            while True:
                best = ranks.min(1, initial=NONE)
                for i, row in zip(index[best == NONE].tolist(), ids[best == NONE]):
                    out[i] = row[row >= 0]
                going = best < NONE
                if not going.any():
                    break
                index, ids, ranks, best = index[going], ids[going], ranks[going], best[going]
                rows, at, n = np.arange(len(index)), ranks.argmin(1), ids.shape[1]
                ids[rows, at] = best
                ids = ids[np.arange(n) != at[:, None] + 1].reshape(-1, n - 1)
                ranks = ranks[np.arange(n - 1) != at[:, None]].reshape(-1, n - 2)
                for on, k in ((at > 0, at - 1), (at < n - 2, at)):
                    r, c = rows[on], k[on]
                    ranks[r, c] = self._rank(ids[r, c], ids[r, c + 1])
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        stop, alive = list(range(1, n + 1)), [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, middle, end = heapq.heappop(heap)
            if not alive[i] or stop[i] != middle or middle >= n or stop[middle] != end:
                continue
            alive[middle], stop[i], after[i] = False, end, after[middle]
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i : stop[end]])) is not None:
                    heapq.heappush(heap, (r, i, end, stop[end]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heapq.heappush(heap, (r, p, i, end))
        return [ranks[piece[i : stop[i]]] for i in range(n) if alive[i]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        whole = "".join(t for t in texts if t)
        ends = np.cumsum([len(t) if t else 0 for t in texts])
        starts = piece_starts(np.frombuffer(whole.encode("utf-32-le"), np.uint32), ends)
        first = np.searchsorted(starts, np.concatenate(([0], ends))).tolist()
        cuts = starts.tolist()
        pieces = [whole[i:j] for i, j in zip(cuts, [*cuts[1:], len(whole)])]
        missing = set(pieces).difference(self.cache)
        if len(self.cache) + len(missing) > CACHE_PIECES:
            self.cache.clear()
            missing = set(pieces)
        fresh = list(missing)
        self.cache.update(zip(fresh, (x.astype("<u4").tobytes() for x in self.merge([p.encode() for p in fresh]))))
        found = list(map(self.cache.__getitem__, pieces))
        return [b"".join(found[a:b]) for a, b in zip(first[:-1], first[1:])]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offsets of the ids' tokens in the decoded text, and its end."""
        if len(ids) and (int(ids.max()) >= len(self.sizes) or not self.sizes[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return np.concatenate(([0], np.cumsum(self.sizes[ids]))).astype(np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray | None = None) -> bytes:
        """Bytes of the ids; retained offsets spare their computation."""
        offsets = self.offsets(ids) if offsets is None else offsets
        source = np.arange(offsets[-1]) + np.repeat(self.at[ids] - offsets[:-1], np.diff(offsets))
        return self.blob[source].tobytes()


@lru_cache(4)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(rows: DataFrame, path: str, text: str = "text", ids: str = "ids", offsets: str | None = "offsets", decoded: str | None = None) -> DataFrame:
    """Adds the ids (binary, little-endian u32) of every text, its tokens' byte offsets (u64) and the decoded bytes.

    ``offsets`` and ``decoded`` are left out where None. ``decoded`` is made of the ids, not of the text.
    """
    results = [c for c in (ids, offsets, decoded) if c]
    kept = [f for f in rows.schema.fields if f.name not in results]
    schema = T.StructType([*kept, *(T.StructField(c, T.BinaryType()) for c in results)])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                found = vocabulary.encode(part.column(text).to_pylist())
                columns = [part.column(n) for n in names] + [pa.array(found, pa.binary())]
                if offsets or decoded:
                    numbers = [np.frombuffer(x, "<u4") for x in found]
                    places = [vocabulary.offsets(x) for x in numbers]
                    if offsets:
                        columns.append(pa.array([p.astype("<u8").tobytes() for p in places], pa.binary()))
                    if decoded:
                        columns.append(pa.array([vocabulary.decode(x, p) for x, p in zip(numbers, places)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *results])

    return rows.select(*dict.fromkeys([*names, text])).mapInArrow(lean(run, lambda: _vocabulary(path).cache.clear()), schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the bytes of every row's ids; null ids give null."""
    kept = [f for f in rows.schema.fields if f.name != decoded]
    schema = T.StructType([*kept, T.StructField(decoded, T.BinaryType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            found = [None if x is None else vocabulary.decode(np.frombuffer(x, "<u4")) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.binary())], names=[*names, decoded])

    return rows.mapInArrow(lean(run), schema)
