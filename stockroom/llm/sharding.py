"""Sharding by sampled splitters (operator 3).

Rows are ordered by (hash of the text, doc_id, a drawn salt), so copies lie side
by side.  A size-weighted sample of these keys gives quantile boundaries;
ranges that still turn out overfull, in bytes or in rows, are subdivided by
splitters sampled within them.  Each range is sorted by itself; with the totals
of the ranges every row knows its exact position and the bytes before it in the
whole order, and shard ``i`` of ``n`` takes the rows that start in the i-th
n-th part of all bytes.  Hence shards differ from equal by one document at most
(law ``bytes``), whatever the sample was.

A hot group of equal texts, or of repeated rows, spans several ranges: the
doc_id and the salt are part of the key.

Defined results: a null text has no bytes (size 8, crc 0); null doc_ids sort
first; repeated rows get a slot each; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.common import col, materialize

SHARDS = 24
OVERHEAD_BYTES = 8
# Least number of ranges and rows per range asked for, sampled keys per range,
# how far above its share a range may be, and rounds of subdividing.
RANGES = 480
ROWS_PER_RANGE = 1_000_000
SAMPLES_PER_RANGE = 24
OVERFULL = 2.0
ROUNDS = 4

KEY = ("key_hash", "key_doc", "salt")


def order_key(*parts: pa.Array) -> np.ndarray:
    """Signed 64-bit columns as one byte string per row that sorts the same way."""
    columns = [np.asarray(p).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for p in parts]
    return np.ascontiguousarray(np.stack(columns, axis=1).astype(">u8")).view(f"S{8 * len(parts)}").ravel()


def _with_range(rows: DataFrame, splitters: np.ndarray, out: str) -> DataFrame:
    """The number of splitters at or below each row's key."""

    @F.arrow_udf("int")
    def udf(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for parts in batches:
            yield pa.array(np.searchsorted(splitters, order_key(*parts), side="right"), pa.int32())

    return rows.withColumn(out, udf(*KEY))


def _sample(rows: DataFrame, weight: F.Column, whole: float, n: int) -> np.ndarray:
    """About ``n`` keys, each row drawn by its own hash with probability
    ``n * weight / whole`` (at most 1), where ``whole`` is the sum of the weights.

    About ``n`` rows reach the driver, however many tasks there are.
    """
    u = (F.shiftrightunsigned(F.xxhash64(*KEY, F.lit(11)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    got = rows.filter(u * F.lit(max(whole, 1.0)) < weight * F.lit(float(n))).select(*KEY).toArrow()
    return np.sort(order_key(*(got[k].combine_chunks() if got.num_rows else pa.array([], pa.int64()) for k in KEY)))


def quantiles(keys: np.ndarray, parts: int) -> np.ndarray:
    if len(keys) == 0:
        return keys
    at = np.linspace(0, len(keys), parts + 1)[1:-1].astype(int)
    return np.unique(keys[at])


def split(rows: DataFrame, total: int, count: int) -> tuple[np.ndarray, list]:
    """Splitters for ``rows`` (KEY, size), and per range its number, rows and bytes."""
    ranges = max(RANGES, count // ROWS_PER_RANGE)
    mean = total / max(count, 1)
    weight = F.col("size") + F.lit(mean)  # bytes and rows count half each
    splitters = quantiles(_sample(rows, weight, 2.0 * total, ranges * SAMPLES_PER_RANGE), ranges)
    limit = OVERFULL * 2 * total / ranges
    for left in range(ROUNDS, -1, -1):
        # once more than there are rounds: the totals belong to the splitters that are returned
        ranged = _with_range(rows, splitters, "range")
        totals = sorted(
            (r["range"], r["rows"], r["bytes"])
            for r in ranged.groupBy("range").agg(
                F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")
            ).collect()  # one row per range
        )
        weights = {r: size + n * mean for r, n, size in totals if n > 1}
        overfull = {r: int(w // limit) + 1 for r, w in weights.items() if w > limit}
        if not overfull or not left:
            break
        more = _sample(
            ranged.filter(F.col("range").isin(list(overfull))), weight, sum(weights[r] for r in overfull),
            sum(overfull.values()) * SAMPLES_PER_RANGE,
        )
        number = np.searchsorted(splitters, more, side="right")
        new = [quantiles(more[number == r], 2 * parts) for r, parts in overfull.items()]
        grown = np.unique(np.concatenate([splitters, *new]))
        if len(grown) == len(splitters):
            break
        splitters = grown
    if (sum(t[1] for t in totals), sum(t[2] for t in totals)) != (count, total):
        raise ValueError("the ranges do not hold all rows")
    return splitters, totals


def place(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row, by the law ``bytes``."""
    whole = F.coalesce(col(text), F.lit(""))
    rows = materialize(
        docs.select(
            col(doc_id).cast("long").alias("doc_id"), (F.octet_length(whole) + F.lit(OVERHEAD_BYTES)).cast("long").alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"), F.xxhash64(whole).alias("key_hash"),
            F.coalesce(col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("key_doc"),
            # fixed by the written table; tells repeated rows apart
            F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
        ),
        "shard-keys",
    )
    sums = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    total, count = sums[0] or 0, sums[1]
    splitters, totals = split(rows, total, count)
    # first row and first byte of each range in the whole order: one entry per range
    row_at, byte_at, rows_before, bytes_before = {}, {}, 0, 0
    for r, n, size in totals:
        row_at[r], byte_at[r] = rows_before, bytes_before
        rows_before, bytes_before = rows_before + n, bytes_before + size
    spark = docs.sparkSession
    starts = spark.createDataFrame(
        [(r, row_at[r], byte_at[r]) for r in row_at], "range int, row_at bigint, byte_at bigint"
    )
    within = Window.partitionBy("range").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = (
        _with_range(rows, splitters, "range")
        .withColumns({"row_in": F.count(F.lit(1)).over(within) - 1, "byte_in": F.sum("size").over(within) - F.col("size")})
        .join(F.broadcast(starts), "range")  # one row per range
        .withColumns({"row_no": F.col("row_at") + F.col("row_in"), "byte_no": F.col("byte_at") + F.col("byte_in")})
        # bytes times shards stays a long up to 10^17 bytes
        .withColumn("shard", F.expr(f"byte_no * {shards} div {max(total, 1)}").cast("int"))
    )
    placed = materialize(ordered.select("doc_id", "size", "text_crc32", "shard", "row_no"), "shard-rows")
    first = placed.groupBy("shard").agg(F.min("row_no").alias("first_row"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row_no") - F.col("first_row")).alias("slot")
    )


def shard_rows(docs: DataFrame) -> DataFrame:
    """The digest of the contract, one row per document."""
    return place(docs.select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
