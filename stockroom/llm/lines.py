"""Line dedup (operator 5).

A line's key is its text without blanks at both ends and in lower case (A-Z).
A key of ``MIN_LENGTH``+ code points found in ``MIN_DOCUMENTS``+ documents stays
only in the largest doc_id that holds it.

Each document's keys become 128-bit hashes, which are uniform, so equal-width
ranges of the hash space are the quantiles and need no sample.  Rows go to the
task of their range, sorted by hash, then document (largest first) and row; the
task streams over them, keeps the first document of a hash and reports the
positions in all others once a third document is seen.  What comes back is one
zlib-compressed bitmap of kept lines per document, not text.

Hot lines: within an Arrow batch, a key that three documents of the batch hold
is decided there for all but the largest of them; those positions travel under
the document's own hash, and only one row per batch competes under the key.

Defined results: rows that share a doc_id are one document; null doc_ids are
one document below all others; a null or empty text is one empty line and is
returned as an empty text when anything is rebuilt; repeated rows share one
bitmap; extra columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import BLANKS, col, fresh, shuffle_partitions

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
_BLANKS = BLANKS.encode()

_ROWS = pa.schema([
    ("task", pa.int32()), ("settled", pa.bool_()), ("hi", pa.int64()), ("lo", pa.int64()), ("known", pa.bool_()),
    ("doc", pa.int64()), ("row_hash", pa.int64()), ("n_lines", pa.int32()), ("at", pa.list_(pa.int32())),
    ("seen", pa.int32()),
])
ROWS = (
    "task int, settled boolean, hi bigint, lo bigint, known boolean, doc bigint, row_hash bigint, n_lines int, "
    "at array<int>, seen int"
)
_DROPS = pa.schema([
    ("known", pa.bool_()), ("doc", pa.int64()), ("row_hash", pa.int64()), ("n_lines", pa.int32()),
    ("at", pa.list_(pa.int32())),
])
DROPS = "known boolean, doc bigint, row_hash bigint, n_lines int, at array<int>"

# (known, doc): null doc_ids sort below all others
Doc = tuple[bool, int]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def key_digest(line: bytes, min_length: int = MIN_LENGTH) -> bytes | None:
    """The 128-bit hash of a line's key, or None if the key is too short to count."""
    key = line.strip(_BLANKS)
    if len(key) < min_length or (not key.isascii() and len(key.decode()) < min_length):
        return None
    return xxhash.xxh3_128_digest(key.lower())  # bytes.lower changes A-Z only


def _batch_rows(docs: list[int | None], texts: list[str | None], tasks: int, min_length: int, least: int) -> pa.RecordBatch:
    """Open rows per (key, document row) and settled rows per document row, of one batch."""
    groups: dict[bytes, dict[tuple[Doc, int], list[int]]] = {}
    lines_of: dict[tuple[Doc, int], int] = {}
    for d, t in zip(docs, texts, strict=True):
        data = (t or "").encode()
        row = ((d is not None, d or 0), _signed(xxhash.xxh64_intdigest(data, 42)))
        if row in lines_of:
            continue  # a repeated row: the same lines in the same document
        lines = data.split(b"\n")
        lines_of[row] = len(lines)
        for i, line in enumerate(lines):
            if len(line) >= min_length and (digest := key_digest(line, min_length)):
                groups.setdefault(digest, {}).setdefault(row, []).append(i)
    out: list[tuple] = []
    settled: dict[tuple[Doc, int], list[int]] = {}
    for digest, rows in groups.items():
        held = {doc for doc, _ in rows}
        seen = min(len(held), least)
        top = max(held)
        hi, lo = int.from_bytes(digest[:8], "big"), int.from_bytes(digest[8:], "big")
        task = hi * tasks >> 64
        for row, at in rows.items():
            if seen == least and row[0] != top:
                settled.setdefault(row, []).extend(at)
            else:
                out.append((task, False, _signed(hi), _signed(lo), *row[0], row[1], lines_of[row], at, seen if seen == least else 1))
    for row, at in settled.items():
        task = (row[1] & 0xFFFFFFFF) % tasks
        out.append((task, True, 0, 0, *row[0], row[1], lines_of[row], at, 0))
    columns = zip(*out, strict=True) if out else [[] for _ in _ROWS]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS, strict=True)], schema=_ROWS)


class _Stream:
    """Decides rows that arrive by (settled, hash, document from the largest down)."""

    def __init__(self, least: int):
        self.least = least
        self.key: tuple[int, int] | None = None
        self.first: Doc | None = None
        self.last: Doc | None = None
        self.seen = 0
        self.held: list[tuple] = []

    def take(self, key: tuple[int, int], doc: Doc, seen: int, row: tuple) -> list[tuple]:
        if key != self.key:
            self.key, self.first, self.last, self.seen, self.held = key, doc, doc, 1, []
        elif doc != self.last:
            self.last = doc
            self.seen += 1
        self.seen = max(self.seen, seen)
        if doc != self.first:
            self.held.append(row)
        if self.seen >= self.least and self.held:
            out, self.held = self.held, []
            return out
        return []


def dropped_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = MIN_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """(known, doc, row_hash, n_lines, at): positions of lines to drop; a document row may come in several rows."""
    tasks = shuffle_partitions(docs.sparkSession)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch_rows(batch.column(0).to_pylist(), batch.column(1).to_pylist(), tasks, min_length, min_documents)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Stream(min_documents)
        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in batch.columns[1:8]] + [batch.column(8), batch.column(9).to_pylist()]
            hi, lo = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            # a key with one row in all needs no look: it neither equals the row before nor the next
            same = (hi[1:] == hi[:-1]) & (lo[1:] == lo[:-1])
            lone = np.zeros(len(hi), bool)
            lone[1:-1] = ~(same[1:] | same[:-1])
            for i in np.flatnonzero(~lone | np.asarray(columns[0])).tolist():
                settled, h, l, known, doc, row_hash, n = (columns[c][i] for c in range(7))
                row = (known, doc, row_hash, n, i)
                if settled:
                    out.append((*row[:4], columns[7][i].as_py()))
                else:
                    kept = (*row[:4], columns[7][i].as_py())
                    out += state.take((h, l), (known, doc), columns[8][i], kept)
            cols = zip(*out, strict=True) if out else [[] for _ in _DROPS]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _DROPS, strict=True)], schema=_DROPS)

    rows = docs.select(col(doc_id).cast("long"), col(text)).mapInArrow(hashes, ROWS)
    dealt = rows.repartitionById(tasks, F.col("task")).sortWithinPartitions(
        "settled", "hi", "lo", F.desc("known"), F.desc("doc"), "row_hash"
    )
    return dealt.mapInArrow(stream, DROPS)


def pack_bitmap(n_lines: int, dropped: list[int]) -> bytes:
    keep = np.ones(n_lines, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 9)


def unpack_bitmap(n_lines: int, bitmap: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, **options) -> DataFrame:
    """One row per document row that loses a line: known, doc, row_hash, n_lines,
    n_dropped and the compressed bitmap of the lines that stay."""

    @F.arrow_udf("struct<n_dropped:int,keep:binary>")
    def bitmap(n_lines: pa.Array, at: pa.Array) -> pa.Array:
        sets = [sorted({i for some in x for i in some}) for x in at.to_pylist()]
        packed = [pack_bitmap(n, x) for n, x in zip(n_lines.to_pylist(), sets, strict=True)]
        return pa.StructArray.from_arrays([
            pa.array([len(x) for x in sets], pa.int32()), pa.array(packed, pa.binary())
        ], names=["n_dropped", "keep"])

    grouped = dropped_lines(docs, **options).groupBy("known", "doc", "row_hash").agg(
        F.max("n_lines").alias("n_lines"), F.collect_list("at").alias("at")
    )
    done = grouped.withColumn("b", bitmap("n_lines", "at"))
    return done.select("known", "doc", "row_hash", "n_lines", "b.n_dropped", "b.keep")


def _kept_text(text: Column, n_lines: Column, keep: Column) -> Column:
    @F.arrow_udf("string")
    def udf(texts: pa.Array, n: pa.Array, bitmaps: pa.Array) -> pa.Array:
        out = []
        for t, k, b in zip(texts.to_pylist(), n.to_pylist(), bitmaps.to_pylist(), strict=True):
            if b is None:
                out.append(None)
            else:
                keep = unpack_bitmap(k, b).tolist()
                out.append("\n".join(line for line, stays in zip((t or "").split("\n"), keep, strict=True) if stays))
        return pa.array(out, pa.string())

    lost = keep.isNotNull()
    return F.when(lost, udf(F.when(lost, text), n_lines, keep)).otherwise(text)


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", dropped: str | None = None, **options) -> DataFrame:
    """``docs`` with the dropped lines gone from ``text``; ``dropped`` names a column for their number."""
    maps = keep_bitmaps(docs, text=text, doc_id=doc_id, **options)
    names = {c: fresh(docs, c) for c in maps.columns}
    maps = maps.select(*(F.col(c).alias(n) for c, n in names.items()))
    known, doc, row_hash = (fresh(docs, f"own_{c}") for c in ("known", "doc", "row_hash"))
    keyed = (
        docs.withColumn(known, col(doc_id).isNotNull())
        .withColumn(doc, F.coalesce(col(doc_id).cast("long"), F.lit(0)))
        .withColumn(row_hash, F.xxhash64(F.coalesce(col(text), F.lit(""))))
    )
    on = (keyed[known] == maps[names["known"]]) & (keyed[doc] == maps[names["doc"]]) & (
        keyed[row_hash] == maps[names["row_hash"]]
    )
    joined = keyed.join(maps, on, "left")
    out = joined.withColumn(text, _kept_text(col(text), col(names["n_lines"]), col(names["keep"])))
    if dropped:
        out = out.withColumn(dropped, F.coalesce(col(names["n_dropped"]), F.lit(0)).cast("long"))
    return out.select(*(col(c) for c in docs.columns), *([col(dropped)] if dropped else []))


def line_rows(docs: DataFrame) -> DataFrame:
    """The digest of the contract, one row per document."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = docs.withColumn("n_lines", (F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1).cast("long"))
    done = dedup_lines(counted, dropped="n_dropped")
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
