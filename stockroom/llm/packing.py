"""Packing of token sequences (operator 6): bounded-space online packing.

Every partition keeps ``open_windows`` windows of ``capacity`` tokens open.  A
document longer than a window is cut into full windows and a rest; the rest is
placed into the open window that it fills best.  When none has room, the
fullest window is emitted and a new one opened.  The windows left open at a
partition's end are merged level by level: ``fan_in`` partitions' leftovers go
through one packer of the next level, until one packer is left.  A packer never
holds more than its open windows, and no task reads more than the leftovers of
``fan_in`` packers.

Each level is written once under ``spark.checkpoint.dir``; emitted windows and
leftovers are read from that table, so both come from one evaluation.

Defined results: a null or empty text has only the closing id; an empty table
gives an empty result; repeated rows are packed each; null doc_ids are carried;
extra columns are not read.
"""

from __future__ import annotations

import os
import sys
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import col, materialize

TOKENIZER_FILE = "word_bpe_49k.json"
END_ID = 2
CAPACITY = 4096
OPEN_WINDOWS = 256
FAN_IN = 32
# Words remembered per worker, in two generations: frequent words stay.  The memory is
# bounded by its bytes, WORD_BYTES for each of these words; longer words than
# LONGEST_WORD (a line of Chinese is one) are encoded each time.
MEMORY_WORDS = 1_200_000
WORD_BYTES = 240
LONGEST_WORD = 64
_ENTRY_BYTES = 220  # of a short word, its place in the memory and the head of its ids
JOINED_WORDS = 128

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, leftover boolean"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("leftover", pa.bool_()),
])
_FLUSH_BYTES = 4 << 20

# A piece: doc_id, start, ids as little-endian unsigned 32-bit integers, doc_tokens.
Piece = tuple[int | None, int, bytes, int]


if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are built as native unsigned 32-bit little-endian integers")


class WordEncoder:
    """Ids of a text by the tokenizers library, each distinct word encoded once.

    The tokenizer's normalizer works character by character and its split never
    crosses white space, so a text's ids are those of its parts between blanks.
    """

    def __init__(self, path: str, memory_words: int = MEMORY_WORDS):
        self._most, self._bytes = WORD_BYTES * memory_words, 0
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings are ordinary text
        vocab = self._tokenizer.get_vocab(with_added_tokens=True)
        self._closes = np.zeros(max(vocab.values()) + 1, bool)
        self._closes[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self._memory: dict[str, bytes] = {"": b""}
        self._old: dict[str, bytes] = {}

    def _recall(self, words: Iterable[str]) -> set[str]:
        """Take up what the older generation knows; the words that are new."""
        new = set(filterfalse(self._memory.__contains__, words))
        again = [w for w in new if w in self._old]
        self._keep({w: self._old[w] for w in again})
        return new.difference(again)

    def _keep(self, ids: dict[str, bytes]) -> None:
        self._memory.update(ids)
        self._bytes += _ENTRY_BYTES * len(ids) + sum(map(len, ids.values()))

    def _learn(self, words: list[str], latin: bool) -> dict[str, bytes]:
        """Remember the ids of the words; those of words too long for that are returned."""
        known = self._memory
        new = self._recall(words)
        if not new:
            return {}
        long = {w: array("I", self._tokenizer.encode(w, add_special_tokens=False).ids).tobytes() for w in new if len(w) > LONGEST_WORD}
        new = new.difference(long)
        # a word of Latin letters and one closing mark are split by the tokenizer as well
        marked = [w for w in new if w[-1] in ".,!?" and w[:-1].isalpha()] if latin else []
        plain = new.difference(marked)
        plain.update(w[:-1] for w in marked)
        plain.update(w[-1] for w in marked)
        plain = self._recall(plain)
        # Latin letters alone are one token of the split, so its ids end with the
        # only one that closes a word, and one call can serve many such words
        letters = [w for w in plain if w.isalpha()] if latin else []
        for i in range(0, len(letters), JOINED_WORDS):
            part = letters[i : i + JOINED_WORDS]
            ids = np.array(self._tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            ends = ((np.flatnonzero(self._closes[ids]) + 1) * 4).tolist()
            data = ids.tobytes()
            self._keep({w: data[x:y] for w, x, y in zip(part, [0, *ends], ends, strict=False)})
            assert len(ends) == len(part) and ends[-1] == len(data)
        rest = plain.difference(letters)
        self._keep({w: array("I", self._tokenizer.encode(w, add_special_tokens=False).ids).tobytes() for w in rest})
        self._keep({w: known[w[:-1]] + known[w[-1]] for w in marked})
        return long

    def __call__(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
            text = text.lower()  # here the same as the tokenizer's: one character each
            latin = True
        except UnicodeEncodeError:
            latin = False
        words = text.replace("\n", " ").split(" ")
        if self._bytes > self._most // 2:
            self._old, self._memory, self._bytes = self._memory, {"": b""}, 0
        long = self._learn(words, latin)
        if long:
            return b"".join([long[w] if len(w) > LONGEST_WORD else self._memory[w] for w in words])
        return b"".join(map(self._memory.__getitem__, words))


@lru_cache(maxsize=2)
def word_encoder(path: str, memory_words: int = MEMORY_WORDS) -> WordEncoder:
    """One encoder per worker process, file and size of memory."""
    return WordEncoder(path, memory_words)


class Packer:
    """Open windows sorted by the room left; emits (window, pieces, leftover)."""

    def __init__(self, capacity: int, open_windows: int):
        self.capacity, self.most = capacity, open_windows
        self._room: list[tuple[int, int]] = []  # (room, window number), ascending
        self._held: dict[int, list[Piece]] = {}
        self._next = 0

    def _emit(self, window: int, leftover: bool = False) -> tuple[int, list[Piece], bool]:
        return window, self._held.pop(window), leftover

    def place(self, piece: Piece) -> Iterator[tuple[int, list[Piece], bool]]:
        size = len(piece[2]) // 4
        at = bisect_left(self._room, (size, -1))
        if at < len(self._room):  # the least room that suffices
            room, window = self._room.pop(at)
        else:
            if len(self._room) >= self.most:
                yield self._emit(self._room.pop(0)[1])  # the fullest
            room, window = self.capacity, self._next
            self._held[window] = []
            self._next += 1
        self._held[window].append(piece)
        if room == size:
            yield self._emit(window)
        else:
            insort(self._room, (room - size, window))

    def rest(self) -> Iterator[tuple[int, list[Piece], bool]]:
        for _, window in self._room:
            yield self._emit(window, leftover=True)
        self._room = []


def cut(doc_id: int | None, ids: bytes, capacity: int) -> Iterator[Piece]:
    total = len(ids) // 4
    for start in range(0, total, capacity):
        yield doc_id, start, ids[4 * start : 4 * (start + capacity)], total


def _rows(level: int, placed: Iterator[tuple[int, list[Piece], bool]]) -> Iterator[pa.RecordBatch]:
    """Record batches of the emitted pieces; sequence numbers unique over levels and tasks."""
    base = (level << 58) | (TaskContext.get().partitionId() << 32)
    rows: list[tuple] = []
    held = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW
        )

    for window, pieces, leftover in placed:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            rows.append((doc_id, start, n, ids, total, base | window, offset, leftover))
            offset += n
            held += len(ids)
        if held >= _FLUSH_BYTES:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def _through(packer: Packer, pieces: Iterator[Piece]) -> Iterator[tuple[int, list[Piece], bool]]:
    for piece in pieces:
        yield from packer.place(piece)
    yield from packer.rest()


def pack(
    docs: DataFrame, encoder: Callable[[], Callable[[str], bytes]], text: str = "text", doc_id: str = "doc_id",
    end_id: int | None = END_ID, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset.

    ``encoder()`` gives, on a worker, the function from a text to its ids.
    """
    end = b"" if end_id is None else end_id.to_bytes(4, "little")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield from cut(d, encode(t.as_py() or "") + end, capacity)

        yield from _rows(0, _through(Packer(capacity, open_windows), pieces()))

    source = docs.select(col(doc_id).cast("long"), col(text))
    written = materialize(source.mapInArrow(first, SCHEMA), "packed-0")
    done = [written.filter(~F.col("leftover"))]
    level = 0
    left = written.filter("leftover")
    while True:
        row = left.agg(F.max(F.shiftrightunsigned(F.col("sequence_id").bitwiseAND((1 << 58) - 1), 32))).first()
        if row[0] is None:
            break
        groups = row[0] // fan_in + 1
        level += 1
        merged = materialize(_merge(left, level, groups, capacity, open_windows, fan_in, groups == 1), f"packed-{level}")
        done.append(merged.filter(~F.col("leftover")))
        if groups == 1:
            break
        left = merged.filter("leftover")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("leftover")


def _merge(
    left: DataFrame, level: int, groups: int, capacity: int, open_windows: int, fan_in: int, last: bool
) -> DataFrame:
    """One level of leftovers: the windows of ``fan_in`` packers through one packer."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for r in batch.select(["doc_id", "start", "ids", "doc_tokens"]).to_pylist():
                    yield r["doc_id"], r["start"], r["ids"], r["doc_tokens"]

        placed = _through(Packer(capacity, open_windows), pieces())
        yield from _rows(level, ((w, p, rest and not last) for w, p, rest in placed))

    task = F.shiftrightunsigned(F.col("sequence_id").bitwiseAND((1 << 58) - 1), 32)
    dealt = left.repartitionById(groups, (task / fan_in).cast("int"))
    # long pieces first: they leave the least room for the short ones to fill
    ordered = dealt.sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
    return ordered.mapInArrow(merge, SCHEMA)


def pack_documents(docs: DataFrame, memory_words: int = MEMORY_WORDS) -> DataFrame:
    """The contract's packing, with the crc of each piece's ids instead of the ids.

    ``memory_words`` trades a worker's memory (``WORD_BYTES`` each) for time.
    """
    path = public_tokenizers.path(TOKENIZER_FILE)
    packed = pack(docs.select("doc_id", "text"), lambda: word_encoder(path, memory_words))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
