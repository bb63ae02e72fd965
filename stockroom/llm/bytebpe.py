"""Byte-level BPE encoding and decoding (operator 4).

The vocabulary is a rank file.  It becomes a model of the tokenizers library:
each byte is written as one printable character (the byte table), each rank's
token as a string of such characters, and the merges are all ways to join two
tokens into a third, by the rank of the result.  Texts arrive as Arrow batches;
a text is cut where the split pattern can never match across (before white
space that follows a visible character), and each distinct piece is encoded
once per worker.  Decoding maps ids back through the byte table to bytes; as
one character may be split over several ids, text comes from an incremental
UTF-8 decoder, never from single ids.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows are encoded each; extra columns pass through; texts are taken
whole, in pieces, so memory is bounded by the text itself.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import re
import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import col, fresh

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
# Bytes of the pieces kept per worker; beyond it the memory is started anew.  Longer
# pieces than LONGEST_PIECE (a text without blanks is one) are encoded each time.
MEMORY_BYTES = 120_000_000
LONGEST_PIECE = 64
_ID_BYTES = 32  # of a whole number object
JOINED_PIECES = 64

# Fixed value: the white space of the split pattern's \\s, as a character class.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c))
_PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


@lru_cache
def byte_table() -> list[str]:
    """One printable character per byte: Latin-1 where that is visible, else from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(other)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one rank file, with a memory of encoded pieces."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        table = byte_table()
        spell = {token: "".join(table[b] for b in token) for token in ranks}
        merges = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = token[:cut], token[cut:]
                if left in ranks and right in ranks:
                    merges.append((rank, ranks[left], ranks[right], spell[left], spell[right]))
        merges.sort()
        vocab = {spell[token]: rank for token, rank in ranks.items()}
        model = models.BPE(vocab=vocab, merges=[m[3:] for m in merges], ignore_merges=True)
        self._tokenizer = Tokenizer(model)
        self._tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        byte_of = {c: b for b, c in enumerate(table)}
        self.bytes_of = {rank: bytes(byte_of[c] for c in token) for token, rank in vocab.items()}
        self._width = {rank: len(token) for rank, token in self.bytes_of.items()}
        self._memory: dict[str, tuple[int, ...]] = {}
        self._bytes = 0

    def _learn(self, pieces: list[str]) -> dict[str, tuple[int, ...]]:
        """Remember the ids of the pieces; those of pieces too long for that are returned."""
        memory: dict[str, tuple[int, ...]] = {}
        new = set(pieces).difference(self._memory)
        long = {p: tuple(self._tokenizer.encode(p, add_special_tokens=False).ids) for p in new if len(p) > LONGEST_PIECE}
        new = list(new.difference(long))
        # pieces that start with white space and end visibly stay apart when
        # joined, so one call serves many of them
        joined = [p for p in new if p[0] in _WHITE and p[-1] not in _WHITE]
        for i in range(0, len(joined), JOINED_PIECES):
            part = joined[i : i + JOINED_PIECES]
            ids = self._tokenizer.encode("".join(part), add_special_tokens=False).ids
            widths = map(self._width.__getitem__, ids)
            end = at = first = last = 0
            for p in part:
                end += len(p.encode())
                while at < end:
                    at += next(widths)
                    last += 1
                memory[p] = tuple(ids[first:last])
                first = last
        for p in set(new).difference(joined):
            memory[p] = tuple(self._tokenizer.encode(p, add_special_tokens=False).ids)
        self._memory.update(memory)
        self._bytes += sum(map(sys.getsizeof, memory)) + sum(sys.getsizeof(x) + _ID_BYTES * len(x) for x in memory.values())
        return long

    def encode(self, text: str) -> list[int]:
        pieces = _PIECE.findall(text)
        if self._bytes > MEMORY_BYTES:
            self._memory.clear()
            self._bytes = 0
        memory = self._memory
        try:
            return list(chain.from_iterable(map(memory.__getitem__, pieces)))
        except KeyError:
            long = self._learn(pieces)
            if long:
                return list(chain.from_iterable(long[p] if len(p) > LONGEST_PIECE else memory[p] for p in pieces))
            return list(chain.from_iterable(map(memory.__getitem__, pieces)))

    def encode_with_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids, and the code points (start, end) of ``text`` that each id touches."""
        ids, offsets, base = [], [], 0
        for piece in _PIECE.findall(text):
            e = self._tokenizer.encode(piece, add_special_tokens=False)
            ids += e.ids
            offsets += [(base + a, base + b) for a, b in e.offsets]
            base += len(piece)
        return ids, offsets

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_pieces(self, ids: Iterable[int]) -> Iterator[str]:
        """Text id by id: a character split over ids comes with its last id."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            yield decoder.decode(self.bytes_of[i])
        yield decoder.decode(b"", final=True)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and rank file."""
    return Codec(path)


def encode(docs: DataFrame, out: str, path: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """``docs`` with the column ``out``: the ids (array<int>) of ``text``, or with
    ``offsets`` a struct of ids, starts and ends in code points."""
    ints = pa.list_(pa.int32())
    if not offsets:

        @F.arrow_udf("array<int>")
        def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            c = codec(path)
            for batch in batches:
                yield pa.array([c.encode(t or "") for t in batch.to_pylist()], ints)
    else:

        @F.arrow_udf("struct<ids:array<int>,starts:array<int>,ends:array<int>>")
        def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            c = codec(path)
            for batch in batches:
                got = [c.encode_with_offsets(t or "") for t in batch.to_pylist()]
                yield pa.StructArray.from_arrays([
                    pa.array([ids for ids, _ in got], ints),
                    pa.array([[a for a, _ in x] for _, x in got], ints),
                    pa.array([[b for _, b in x] for _, x in got], ints),
                ], names=["ids", "starts", "ends"])

    return docs.withColumn(out, udf(col(text)))


def decode(docs: DataFrame, out: str, path: str, ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``out``: the bytes that the array column ``ids`` stands for."""

    @F.arrow_udf("binary")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path)
        for batch in batches:
            yield pa.array([c.decode_bytes(x.as_py() or ()) for x in batch], pa.binary())

    return docs.withColumn(out, udf(col(ids)))


def round_trip(docs: DataFrame, out: str, path: str, text: str = "text") -> DataFrame:
    """``docs`` with the column ``out``: number of ids, SHA-256 of the ids (decimal,
    joined by commas) and of the bytes decoded from them.

    Encodes and decodes in one pass, so that the ids of a long corpus need not
    leave the worker.
    """
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path)
        digits = {i: f"{i},".encode() for i in c.bytes_of}
        for batch in batches:
            rows = []
            for t in batch.to_pylist():
                ids = c.encode(t or "")
                listed = b"".join(map(digits.__getitem__, ids))[:-1]
                rows.append((
                    len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(c.decode_bytes(ids)).hexdigest()
                ))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            arrays = [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            yield pa.StructArray.from_arrays(arrays, fields=list(kind))

    return docs.withColumn(out, udf(col(text)))


def codec_rows(docs: DataFrame) -> DataFrame:
    """The digest of the contract, one row per document."""
    docs = docs.select("doc_id", "text")
    name = fresh(docs, "codec")
    done = round_trip(docs, name, public_tokenizers.path(RANK_FILE))
    return done.select("doc_id", F.col(f"{name}.*"))
