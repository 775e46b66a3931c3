"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton enumerates every vocabulary match of a word; a dynamic
program over the match ends carries the best score and the number of pieces on
the best path, and no back pointers. Ties are the tokenizer's: a later candidate
replaces an earlier one only if its score is greater, and candidates come by
ascending start, so of equal paths the one with the longest last piece stays. A
character that is no piece of its own costs the lowest score less 10 and, with
byte fallback, counts as its UTF-8 bytes.

No piece has a word mark after another character, so no match crosses the start
of a word, every best path breaks there, and words are counted on their own, with
a cache. If a vocabulary had such pieces, whole texts would be taken instead.
Scores are whole numbers, so sums are exact in any order.

Defined results: null and empty text count 0. Text of any length is counted
whole. Repeated rows get equal results. Other columns pass through; a column with
the name of the result is replaced.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words a worker remembers; when full, it starts anew.
CACHE_WORDS = 600_000


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Fields of a protocol-buffers message: number and raw value."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = (8 if kind == 1 else 4, at) if kind in (1, 5) else varint(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a sentencepiece model and their scores, without control, byte and unknown ones."""
    out = []
    with open(path, "rb") as file:
        for number, value in _fields(file.read()):
            if number == 1:
                piece = dict(_fields(value))
                if piece.get(3, 1) == 1:
                    out.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]))
    return out


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        whole = any(MARK in p.lstrip(MARK) for p, _ in pieces)
        # A line feed that is in no piece is a break of its own; it would make long words of lists.
        alone = not any("\n" in p for p, _ in pieces)
        self.split = re.compile("(?s).+" if whole else rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if alone else rf"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.known = _Words(self.word)

    def word(self, word: str) -> int:
        """Pieces on the best path through one word."""
        n, done = len(word), 0  # ends up to ``done`` are final
        best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        for last, (size, score) in self.automaton.iter(word):
            end = last + 1
            if done < last:
                self._settle(word, best, count, done, last)
                done = last
            # Matches at one end come by ascending start, so the first of equals stays.
            value = best[end - size] + score
            if value > best[end]:
                best[end], count[end] = value, count[end - size] + 1
        self._settle(word, best, count, done, n)
        return count[n]

    def _settle(self, word: str, best: list[float], count: list[int], done: int, upto: int) -> None:
        """Lets characters that are no pieces compete for the ends after ``done``, as the last candidates there."""
        for i in range(done, upto):
            if word[i] not in self.single and best[i] + self.unknown > best[i + 1]:
                best[i + 1], count[i + 1] = best[i] + self.unknown, count[i] + len(word[i].encode())

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        return sum(map(self.known.__getitem__, self.split(MARK + text.replace(" ", MARK))))


class _Words(dict):
    """Counts by word, made when first asked for."""

    def __init__(self, make: Callable[[str], int]):
        self.make = make

    def __missing__(self, word: str) -> int:
        self[word] = n = self.make(word)
        return n


@lru_cache(4)
def _counter(path: str) -> Counter:
    return Counter(read_pieces(path))


def count_tokens(rows: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """Adds the number of tokens of every row's whole text."""
    kept = [f for f in rows.schema.fields if f.name != into]
    schema = T.StructType([*kept, T.StructField(into, T.LongType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            found = pa.array(list(map(counter.count, batch.column(text).to_pylist())), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), found], names=[*names, into])

    return rows.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)
