"""Weighted acyclic automata over n-grams of up to three words (for operator 12).

An automaton maps n-grams to whole numbers: a path from the root spells an n-gram,
and the weight of its last arc is the n-gram's (0: not an entry).  It is built
from n-grams in sorted order; states with the same outgoing arcs (labels,
weights and targets) are one state, from the last words upwards, so it is
minimal.  All steps work on whole numpy columns.

N-grams are three columns of word numbers from 1 (0: no word), into a sorted list
of words (bytes).  That order puts a prefix before its continuations.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import zstandard

Columns = tuple[np.ndarray, np.ndarray, np.ndarray]
Gram = tuple[bytes, ...]
# columns of a written automaton: word lengths, root arcs, first states and arcs, second states and arcs
_KINDS = ("<i4", "<i4", "<i8", "<i4", "<i4", "<i4", "<i8", "<i4", "<i4", "<i4", "<i8")


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each of the sizes, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _bits(words: int) -> int:
    """Bits of a word number if three of them fit into one whole number, else 0."""
    bits = int(words).bit_length()
    return bits if 3 * bits <= 63 else 0


def _packed(grams: Columns, bits: int) -> np.ndarray:
    a, b, c = grams
    return (a << 2 * bits) | (b << bits) | c


def _unpacked(keys: np.ndarray, bits: int) -> Columns:
    mask = (1 << bits) - 1
    return keys >> 2 * bits, (keys >> bits) & mask, keys & mask


def _joined(keys: np.ndarray, weights: np.ndarray, take) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], take.reduceat(weights[order], first)


def counted(grams: Columns, words: int) -> tuple[Columns, np.ndarray]:
    """The n-grams in order, each once, and how often each is there."""
    bits = _bits(words)
    if not bits or not len(grams[0]):
        return merged(grams, np.ones(len(grams[0]), np.int64), words)
    keys = np.sort(_packed(grams, bits))
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return _unpacked(keys[first], bits), np.diff(np.append(first, len(keys)))


def merged(grams: Columns, weights: np.ndarray, words: int, take=np.add) -> tuple[Columns, np.ndarray]:
    """The n-grams in order, each once, their weights added (or joined by ``take``)."""
    if not len(weights):
        return grams, weights
    bits = _bits(words)
    if bits:
        keys, weights = _joined(_packed(grams, bits), weights, take)
        return _unpacked(keys, bits), weights
    a, b, c = grams
    order = np.lexsort((c, b, a))
    x, y, z = a[order], b[order], c[order]
    first = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])))
    return (x[first], y[first], z[first]), take.reduceat(weights[order], first)


@dataclass
class Automaton:
    words: list[bytes]  # sorted
    # root arcs: label, weight, target class at depth 1
    root: Columns
    # arcs of the distinct states at depth 1 and 2, and where each state's begin
    first_begin: np.ndarray
    first: Columns
    second_begin: np.ndarray
    second: tuple[np.ndarray, np.ndarray]

    @staticmethod
    def build(words: Sequence[bytes], grams: Columns, weights: np.ndarray) -> Automaton:
        """From sorted distinct n-grams with positive weights; keeps the words in use."""
        seen = np.zeros(len(words) + 1, bool)
        for w in grams:
            seen[w] = True
        seen[0] = False
        number = np.cumsum(seen)
        w1, w2, w3 = (number[w] for w in grams)
        own = [words[i] for i in (np.flatnonzero(seen) - 1).tolist()]
        new1 = np.append(True, w1[1:] != w1[:-1])[: len(w1)]
        new2 = (w2 > 0) & (new1 | np.append(True, w2[1:] != w2[:-1])[: len(w2)])
        at1, at2, at3 = np.flatnonzero(new1), np.flatnonzero(new2), np.flatnonzero(w3)
        state1, state2 = np.cumsum(new1) - 1, np.cumsum(new2) - 1
        kind2, begin2, second = _shared(state2[at3], len(at2), (w3[at3], weights[at3]))
        itself = np.where(w3[at2] == 0, weights[at2], 0)  # a prefix sorts first
        kind1, begin1, first = _shared(state1[at2], len(at1), (w2[at2], itself, kind2))
        root = (w1[at1], np.where(w2[at1] == 0, weights[at1], 0), kind1)
        return Automaton(own, root, begin1, first, begin2, second)

    def grams(self) -> tuple[Columns, np.ndarray]:
        """All entries (not in order) with their weights."""
        label, weight, state = self.root
        width = self.first_begin[state + 1] - self.first_begin[state]
        arc = np.repeat(self.first_begin[state], width) + _within(width)
        a = np.repeat(label, width)
        b, weight2, state2 = (x[arc] for x in self.first)
        width2 = self.second_begin[state2 + 1] - self.second_begin[state2]
        arc2 = np.repeat(self.second_begin[state2], width2) + _within(width2)
        none1, none2 = np.zeros(len(label), np.int64), np.zeros(len(a), np.int64)
        columns = (
            np.concatenate([label, a, np.repeat(a, width2)]), np.concatenate([none1, b, np.repeat(b, width2)]),
            np.concatenate([none1, none2, self.second[0][arc2]]),
        )
        weights = np.concatenate([weight, weight2, self.second[1][arc2]])
        entry = weights > 0
        return tuple(c[entry] for c in columns), weights[entry]

    def to_bytes(self) -> bytes:
        lengths = np.array([len(w) for w in self.words], np.int64)
        columns = [lengths, *self.root, self.first_begin, *self.first, self.second_begin, *self.second]
        head = np.array([len(c) for c in columns], np.int64)
        data = [np.ascontiguousarray(c, kind).tobytes() for c, kind in zip(columns, _KINDS, strict=True)]
        return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *data, *self.words]))

    @staticmethod
    def from_bytes(data: bytes) -> Automaton:
        data = zstandard.ZstdDecompressor().decompress(data)
        sizes = np.frombuffer(data, np.int64, len(_KINDS)).tolist()
        at, columns = 8 * len(_KINDS), []
        for n, kind in zip(sizes, _KINDS, strict=True):
            columns.append(np.frombuffer(data, kind, n, at).astype(np.int64))
            at += n * np.dtype(kind).itemsize
        ends = np.cumsum(columns[0]).tolist()
        words = [data[at + e - n : at + e] for e, n in zip(ends, columns[0].tolist(), strict=True)]
        return Automaton(words, tuple(columns[1:4]), columns[4], tuple(columns[5:8]), columns[8], tuple(columns[9:11]))


def _shared(owner: np.ndarray, states: int, arcs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray, tuple]:
    """States with equal arcs as one: the class of each state, where each class's
    arcs begin, and those arcs.  ``owner`` is the state of each arc, ascending."""
    size = np.bincount(owner, minlength=states)
    begin = np.cumsum(size) - size
    mark = np.zeros(len(owner), np.uint64)
    for column in arcs:
        mark = _mixed(mark * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1))
    total = np.append(np.uint64(0), np.cumsum(mark, dtype=np.uint64))
    sign = _mixed(total[begin + size] - total[begin]) + size.astype(np.uint64)
    _, first, kind = np.unique(sign, return_index=True, return_inverse=True)
    # equal hashes are compared arc by arc
    chosen = first[kind]
    same = (size[chosen] == size).all()
    if same:
        twin = np.repeat(begin[chosen], size) + _within(size)
        same = all((c[twin] == c).all() for c in arcs)
    if not same:
        first = kind = np.arange(states)
    width = size[first]
    rows = np.repeat(begin[first], width) + _within(width)
    return kind, np.append(0, np.cumsum(width)), tuple(c[rows] for c in arcs)


def renumber(words: Sequence[bytes], into: dict[bytes, int], grams: Columns) -> Columns:
    """Word numbers of ``grams`` in the numbering ``into`` (-1: not there)."""
    table = np.fromiter((into.get(w, -1) for w in words), np.int64, len(words))
    table = np.append(0, table)
    return tuple(table[g] for g in grams)


def union(parts: list[Automaton], take=np.add, least: int = 1) -> tuple[list[bytes], Columns, np.ndarray]:
    """Words, sorted n-grams and joined weights of several automata; entries below ``least`` go."""
    words = sorted(set().union(*(p.words for p in parts)))
    numbers = {w: i for i, w in enumerate(words, 1)}
    bits = _bits(len(words))
    if bits and len(words):
        # one number an n-gram at once: a part's columns are not kept
        keys, values = [], []
        for p in parts:
            grams, weights = p.grams()
            keys.append(_packed(renumber(p.words, numbers, grams), bits))
            values.append(weights)
        key, weights = _joined(np.concatenate(keys), np.concatenate(values), take)
        grams = _unpacked(key, bits)
    else:
        found = [p.grams() for p in parts]
        moved = [renumber(p.words, numbers, g) for p, (g, _) in zip(parts, found, strict=True)]
        columns = tuple(np.concatenate([m[k] for m in moved]) for k in range(3))
        grams, weights = merged(columns, np.concatenate([w for _, w in found]), len(words), take)
    kept = weights >= least
    return words, tuple(g[kept] for g in grams), weights[kept]


def cut(words: list[bytes], grams: Columns, splitters: list[Gram]) -> np.ndarray:
    """Number of the first n-gram at or after each splitter."""
    out = np.empty(len(splitters), np.int64)
    for k, gram in enumerate(splitters):
        low, high = 0, len(grams[0])
        for column, word in zip(grams, gram, strict=False):
            at = bisect_left(words, word)
            some = column[low:high]
            if at == len(words) or words[at] != word:
                low += int(np.searchsorted(some, at + 1))
                break
            low, high = low + int(np.searchsorted(some, at + 1)), low + int(np.searchsorted(some, at + 1, "right"))
        out[k] = low
    return out


class Ranges:
    """Ranges of (language, n-gram) between sorted splitters."""

    def __init__(self, splitters: list[tuple[str, Gram]]):
        self.languages = [s[0] for s in splitters]
        self.grams = [s[1] for s in splitters]

    def pieces(self, language: str, words: list[bytes], grams: Columns, weights: np.ndarray):
        """(range, automaton) of the ranges that hold some of the sorted n-grams."""
        low, high = bisect_left(self.languages, language), bisect_right(self.languages, language)
        edges = [0, *cut(words, grams, self.grams[low:high]).tolist(), len(weights)]
        for k, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
            if i < j:
                yield low + k, Automaton.build(words, tuple(g[i:j] for g in grams), weights[i:j])
