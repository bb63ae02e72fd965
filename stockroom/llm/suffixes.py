"""Exact substring dedup by sorted suffixes (operator 8).

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else.  Sorting a suffix for every byte would ship the corpus hundreds of times
over, so the suffix array is sparse: of every ``length``-byte string only the
suffix at its anchor is sorted, the position in it whose ``GRAM``-byte string
has the least hash.  Equal strings have their anchor at the same place.  All
strings with one anchor are a slice of the text around it.

1. Equal texts become one text (a text with a copy is removed whole).
2. Suffixes at anchors, one row each, are range-partitioned by their leading
   eight bytes, then by the hashes of the anchor's gram and of the slice, with
   splitters from a sample; buckets are sorted and neighbours compared, also
   across the boundaries of buckets.  A slice that equals a neighbour's is all
   repeats; a suffix that shares its gram, but not its slice, with a neighbour
   is open.
3. Slices of open suffixes meet by gram; all their ``length``-byte strings are
   taken apart token by token, as a multikey quicksort does, but by the hashes of
   tokens: classes of two or more go on to the next token and those left are repeats.
   That finds equal strings and orders nothing.  The strings of a gram that more than
   ``HOT`` suffixes share are sorted as rows of their own, as in step 2, so no group
   sits in one task.
4. The repeats of a text are merged into spans and cut out.

The buckets are sorted by Spark, on the leading bytes and then on hashes, so the order of
suffixes ends with their eight leading bytes; equal strings are told by at least 96 bits.

Defined results: a null or empty text has no bytes and nothing to remove;
repeated rows are copies of each other, so all bytes of such rows go if there
are ``length`` of them; null doc_ids are carried; an empty table gives an empty
result; extra columns are not read.  Kept bytes may split a character.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import col, materialize, shuffle_partitions
from stockroom.llm.sharding import order_key, quantiles
from stockroom.session import ensure_checkpoint_dir

LENGTH = 200
GRAM = 32
# Bytes of a token of the strings, suffixes of one gram from which on
# their strings are sorted as rows, keys sampled for the splitters.
TOKEN = 40
HOT = 2_000
SAMPLE = 40_000
# Bytes worked on at once.
_BLOCK = 1 << 21
_POSITION_BITS = np.uint64(24)

_TABLE = np.random.default_rng(8).integers(0, 1 << 64, 256, np.uint64)
_MULTIPLIER = 0x9E3779B97F4A7C15


def rolling(data: np.ndarray, widths: list[int]) -> dict[int, np.ndarray]:
    """64-bit hashes of all strings of each width, by doubling: hash(ab) = hash(a) * m^|b| + hash(b)."""
    powers = {1: _TABLE[data]}
    size, out = 1, {}
    while size * 2 <= max(widths):
        h = powers[size]
        m = np.uint64(pow(_MULTIPLIER, size, 1 << 64))
        powers[size * 2] = h[:-size] * m + h[size:] if len(h) > size else h[:0]
        size *= 2
    for width in widths:
        got, done = None, 0
        for size in sorted((s for s in powers if width & s), reverse=True):
            h = powers[size]
            if got is None:
                got = h
            else:
                n = max(len(data) - done - size + 1, 0)
                got = got[:n] * np.uint64(pow(_MULTIPLIER, size, 1 << 64)) + h[done : done + n]
            done += size
        out[width] = got
    return out


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, as a number that sorts like them (signed)."""
    out = np.zeros(len(at), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | data[at + i].astype(np.uint64)
    return (out ^ np.uint64(1 << 63)).view(np.int64)


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, anchor, gram hash) of every run of ``length``-byte
    strings with one anchor; ``ends``: ends of the texts that ``data`` joins."""
    none = np.zeros(0, np.int64)
    span = length - GRAM + 1  # gram positions in one string
    if len(data) < length:
        return none, none, none, none.astype(np.uint64)
    grams = _finish(rolling(data, [GRAM])[GRAM])
    place = np.arange(len(grams), dtype=np.uint64)
    low = (grams >> _POSITION_BITS << _POSITION_BITS) | place
    size = 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    anchor = (low & np.uint64((1 << int(_POSITION_BITS)) - 1)).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(ends, starts, side="right")
    inside = starts + length <= ends[text]
    starts, anchor, text = starts[inside], anchor[inside], text[inside]
    if not len(starts):
        return none, none, none, none.astype(np.uint64)
    new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) + 1
    first, last = np.concatenate([[0], new]), np.concatenate([new, [len(starts)]]) - 1
    return starts[first], starts[last], anchor[first], grams[anchor[first]]


def blocks(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, list[tuple[int, int]]]]:
    """Joined texts of about ``_BLOCK`` bytes, their ends, and (text number, offset in
    it) of each; a longer text comes in pieces that overlap by ``length - 1``."""
    parts, ends, origin, held = [], [], [], 0
    for number, t in enumerate(texts):
        if len(t) < length:
            continue
        for at in range(0, len(t) - length + 1, _BLOCK):
            piece = t[at : at + _BLOCK + length - 1] if len(t) > _BLOCK else t
            parts.append(piece)
            held += len(piece)
            ends.append(held)
            origin.append((number, at))
            if held >= _BLOCK:
                yield b"".join(parts), np.array(ends), origin
                parts, ends, origin, held = [], [], [], 0
            if piece is t:
                break
    if parts:
        yield b"".join(parts), np.array(ends), origin


def _batch(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


# A suffix row: k1 leading bytes; k2 upper half of the gram's hash, then the
# anchor's distance from the first start and the last start's (8 bits each); k3 hash of the slice.
SUFFIX = ["k1", "k2", "k3", "hash", "start", "n_bytes"]
SUFFIX_SCHEMA = "k1 bigint, k2 bigint, k3 bigint, hash bigint, start bigint, n_bytes bigint"


def suffix_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Batches (hash, n_bytes, text) -> suffix rows."""
    for batch in batches:
        hashes, sizes = (np.asarray(batch.column(i)).astype(np.int64) for i in (0, 1))
        texts = [t.encode() for t in batch.column(2).to_pylist()]
        for joined, ends, origin in blocks(texts, length):
            data = np.frombuffer(joined, np.uint8)
            first, last, anchor, gram = anchors(data, ends, length)
            if not len(first):
                continue
            piece = np.searchsorted(ends, first, side="right")
            begin = np.concatenate([[0], ends[:-1]])[piece]
            number = np.array([n for n, _ in origin])[piece]
            offset = np.array([o for _, o in origin])[piece]
            digest = xxhash.xxh3_64_intdigest
            slices = np.fromiter(
                (digest(joined[a:b]) for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)), np.uint64, len(first)
            )
            packed = (gram >> np.uint64(32) << np.uint64(32)) | ((anchor - first).astype(np.uint64) << np.uint64(8)) | (
                last - first
            ).astype(np.uint64)
            yield _batch(SUFFIX, [
                leading(data, anchor), packed.view(np.int64), slices.view(np.int64), hashes[number], first - begin + offset,
                sizes[number],
            ])


def splitters(rows: DataFrame, keys: list[str], parts: int) -> np.ndarray:
    """Quantiles of about ``SAMPLE`` of the rows' keys, drawn by hash."""
    rare = max(rows.count() // SAMPLE, 1)
    drawn = rows.select(*keys).filter(F.pmod(F.xxhash64(*keys), F.lit(rare)) == 0).toArrow()
    columns = [drawn[k].combine_chunks() if drawn.num_rows else pa.array([], pa.int64()) for k in keys]
    return quantiles(np.sort(order_key(*columns)), parts)


def sorted_neighbours(
    rows: DataFrame, keys: list[str], sample: DataFrame, judge: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> DataFrame:
    """``rows`` range-partitioned and sorted by ``keys`` (all bigint), with ``status``.

    ``judge(left, right)`` rates pairs of neighbours, given as matrices with a
    column per key: 0 unrelated, else a higher number for more.  A row's status
    is the higher of its two neighbours' ratings; rows of status 0 are left out.
    """
    tasks = shuffle_partitions(rows.sparkSession)
    cuts = splitters(sample, keys, tasks)
    other = [c for c in rows.columns if c not in keys]
    names = [*keys, *other]

    @F.arrow_udf("int")
    def bucket(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for parts in batches:
            yield pa.array(np.searchsorted(cuts, order_key(*parts), side="right"), pa.int32())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row waits for its right neighbour; edge: 1 first row of the bucket, 2 last, 3 both
        held: np.ndarray | None = None
        left, opening = 0, True
        for batch in batches:
            table = np.stack([np.asarray(c).astype(np.int64) for c in batch.columns], axis=1)
            if not len(table):
                continue
            whole = table if held is None else np.concatenate([held, table])
            rating = judge(whole[:-1, : len(keys)], whole[1:, : len(keys)])
            status = np.maximum(np.concatenate([[left], rating]), np.concatenate([rating, [0]]))
            edge = np.zeros(len(whole), np.int64)
            if opening:
                edge[0] = 1
            if len(whole) > 1:
                done = (status[:-1] > 0) | (edge[:-1] > 0)
                yield _batch([*names, "bucket", "status", "edge"], [
                    *whole[:-1][done].T, status[:-1][done], edge[:-1][done]
                ])
                opening = False
            held, left = whole[-1:], int(status[-1])
        if held is not None:
            edge = np.array([3 if opening else 2])
            yield _batch([*names, "bucket", "status", "edge"], [*held.T, np.array([left]), edge])

    schema = ", ".join(f"{c} bigint" for c in [*names, "bucket", "status", "edge"])
    dealt = rows.select(*names, bucket(*keys).alias("bucket")).repartitionById(tasks, F.col("bucket"))
    compared = materialize(
        dealt.sortWithinPartitions(*keys, *other).mapInArrow(compare, schema), "neighbours"
    )
    # the boundaries: at most two rows a bucket
    edges = sorted(compared.filter("edge > 0").collect(), key=lambda r: (r["bucket"], r["edge"]))
    seam = [list(r) for r in edges]
    at = len(names)
    for a, b in zip(seam, seam[1:], strict=False):
        if a[at] != b[at]:
            rating = int(judge(np.array([a[: len(keys)]]), np.array([b[: len(keys)]]))[0])
            a[at + 1], b[at + 1] = max(a[at + 1], rating), max(b[at + 1], rating)
    spark = rows.sparkSession
    whole = compared.filter("edge = 0").unionAll(spark.createDataFrame([tuple(x) for x in seam], compared.schema))
    return whole.filter("status > 0").drop("bucket", "edge")


def _suffix_rating(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """1: the same leading bytes and gram; 2: the same slice around the anchor."""
    gram = (left[:, 0] == right[:, 0]) & (left[:, 1] >> 32 == right[:, 1] >> 32)
    same = gram & (left[:, 1] == right[:, 1]) & (left[:, 2] == right[:, 2])
    return gram.astype(np.int64) + same


def _equal_rating(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """1: the same string, by its leading bytes and 128-bit hash."""
    return (left[:, :3] == right[:, :3]).all(axis=1).astype(np.int64)


def multikey_repeats(classes: np.ndarray, tokens: list[np.ndarray]) -> np.ndarray:
    """Which strings have an equal one: token by token, by hash, only classes of two
    or more go on to the next token."""
    live = np.arange(len(classes))
    group = classes.astype(np.uint64)
    for token in tokens:
        key = _finish((group + np.uint64(1)) * np.uint64(_MULTIPLIER) + token[live])
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = key[1:] == key[:-1]
        many = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        number = np.cumsum(np.concatenate([[True], ~same]))
        live, group = live[order][many], number[many].astype(np.uint64)
        if not len(live):
            break
    out = np.zeros(len(classes), bool)
    out[live] = True
    return out


def _runs(row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of consecutive starts in one row."""
    cut = np.flatnonzero((row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(row)]]) - 1


SPAN_SCHEMA = "hash bigint, n_bytes bigint, first bigint, last bigint"
_SPAN = ["hash", "n_bytes", "first", "last"]


def slice_repeats(grams: np.ndarray, distances: np.ndarray, slices: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(slice, start in it) of the repeated strings; strings compare only within one
    gram and at one distance from the anchor."""
    joined = b"".join(slices)
    data = np.frombuffer(joined, np.uint8)
    sizes = np.fromiter(map(len, slices), np.int64, len(slices))
    begin = np.cumsum(sizes) - sizes
    count = sizes - length + 1
    row = np.repeat(np.arange(len(slices)), count)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[row] + start
    token = rolling(data, [TOKEN])[TOKEN]
    classes = grams[row].astype(np.uint64) * np.uint64(512) + (distances[row] - start).astype(np.uint64)
    steps = [*range(0, length - TOKEN, TOKEN), length - TOKEN]
    found = multikey_repeats(classes, [token[at + s] for s in steps])
    return row[found], start[found]


def _small_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (k1, gram, distance, hash, n_bytes, start, slice) sorted by (k1, gram) -> spans of repeated starts."""
    held: list[tuple] = []
    size = 0

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        keys = {k: i for i, k in enumerate(dict.fromkeys(r[:2] for r in rows))}
        grams = np.array([keys[r[:2]] for r in rows])
        row, start = slice_repeats(grams, np.array([r[2] for r in rows]), [r[6] for r in rows], length)
        if not len(row):
            return _batch(_SPAN, [np.zeros(0, np.int64)] * 4)
        a, b = _runs(row, start)
        hashes, sizes, base = (np.array([r[i] for r in rows]) for i in (3, 4, 5))
        return _batch(_SPAN, [hashes[row[a]], sizes[row[a]], base[row[a]] + start[a], base[row[b]] + start[b]])

    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= _BLOCK and r[:2] != held[-1][:2]:
                yield flush(held)
                held, size = [], 0
            held.append(r)
            size += len(r[6])
    if held:
        yield flush(held)


TEXT = ["hash", "n_bytes"]  # what tells distinct texts apart


def text_key(text: F.Column) -> list[F.Column]:
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("hash"), F.octet_length(whole).cast("long").alias("n_bytes")]


def distinct_texts(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """(hash, n_bytes, text) of every distinct text of ``length``+ bytes, as a table
    bucketed by (hash, n_bytes), which later joins read without a shuffle.

    Each task first drops its own repeats, so the copies of one text shrink to
    one row per task before they meet.
    """
    spark = docs.sparkSession
    rows = docs.select(*text_key(col(text)), col(text).alias("text")).filter(F.col("n_bytes") >= length)
    schema = "hash bigint, n_bytes bigint, text string"

    def keys_of(batch: pa.RecordBatch) -> list[tuple[int, int]]:
        return list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))

    def first_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # of one file split
        for batch in batches:
            keep = []
            for k in keys_of(batch):
                keep.append(k not in seen)
                seen.add(k)
            yield batch.filter(pa.array(keep, pa.bool_()))

    def first_of_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            keep = []
            for k in keys_of(batch):
                keep.append(k != last)
                last = k
            yield batch.filter(pa.array(keep, pa.bool_()))

    tasks = shuffle_partitions(spark)
    unique = (
        rows.mapInArrow(first_in_task, schema).repartition(tasks, *TEXT).sortWithinPartitions(*TEXT)
        .mapInArrow(first_of_run, schema)
    )
    name = f"llm_texts_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    unique.write.bucketBy(tasks, *TEXT).option("path", path).option("compression", "zstd").saveAsTable(name)
    # the frame keeps the files and their buckets; the catalog need not list them
    written = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return written


def repeated_spans(texts: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(hash, n_bytes, first, last): runs of starts of repeated strings in distinct ``texts``."""
    texts = texts.select(*TEXT, "text")
    find = lambda batches: suffix_rows(batches, length)
    suffixes = texts.mapInArrow(find, SUFFIX_SCHEMA)
    count = texts.count()
    some = texts.filter(F.pmod(F.xxhash64("hash"), F.lit(max(count // 4000, 1))) == 0)
    rated = sorted_neighbours(
        suffixes, ["k1", "k2", "k3", "hash", "start"], some.mapInArrow(find, SUFFIX_SCHEMA), _suffix_rating
    )
    near = rated.select(
        "status", *TEXT, "start", "k1", F.shiftright("k2", 32).alias("gram"),
        F.shiftrightunsigned(F.col("k2").bitwiseAND(0xFFFF), 8).cast("int").alias("distance"),
        F.col("k2").bitwiseAND(0xFF).cast("int").alias("width"), "k3",
    )
    settled = near.filter("status = 2")
    spans = settled.select(*TEXT, F.col("start").alias("first"), (F.col("start") + F.col("width")).alias("last"))
    # open slices, and one of each settled slice with the gram of an open one
    open_ = near.filter("status = 1").drop("k3", "status")
    grams = open_.select("k1", "gram").distinct()
    one = settled.groupBy("k1", "gram", "distance", "width", "k3").agg(F.min(F.struct(*TEXT, "start")).alias("at"))
    one = one.join(grams, ["k1", "gram"], "left_semi").select(
        "at.hash", "at.n_bytes", "at.start", "k1", "gram", "distance", "width"
    )
    members = open_.unionByName(one)
    # a table of its own, so that the join has an exchange on either side and
    # Spark can split the rows of a hot gram
    hot_grams = materialize(
        members.groupBy("k1", "gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot)
        .select("k1", "gram", F.lit(True).alias("hot")),
        "hot-grams",
    )
    members = members.join(hot_grams, ["k1", "gram"], "left")
    wanted = members.groupBy(*TEXT).agg(  # bounded by the text
        F.collect_list(F.struct("k1", "gram", "distance", "width", "start", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("slices")
    )
    names = ["k1", "gram", "distance", *TEXT, "start", "slice", "hot"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    cut_schema = "k1 bigint, gram bigint, distance int, hash bigint, n_bytes bigint, start bigint, slice binary, hot boolean"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, n, t, slices in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = t.encode()
                rows = [
                    (x["k1"], x["gram"], x["distance"], h, n, x["start"],
                     data[x["start"] : x["start"] + x["width"] + length], x["hot"])
                    for x in slices
                ]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    slices = materialize(
        texts.join(wanted, TEXT).select(*TEXT, "text", "slices").mapInArrow(cut, cut_schema), "slices"
    )
    small = (
        slices.filter("NOT hot").drop("hot").repartition("k1", "gram").sortWithinPartitions("k1", "gram", *TEXT, "start")
        .mapInArrow(lambda batches: _small_groups(batches, length), SPAN_SCHEMA)
    )
    spans = spans.unionByName(small)

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per string of a hot gram: leading bytes and a 128-bit hash."""
        for batch in batches:
            for h, size, start, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(data) - length + 1
                digests = b"".join(xxhash.xxh3_128_digest(data[i : i + length]) for i in range(n))
                hashes = np.frombuffer(digests, ">i8").reshape(-1, 2).astype(np.int64)
                yield _batch(SUFFIX, [
                    leading(np.frombuffer(data, np.uint8), np.arange(n)), hashes[:, 0], hashes[:, 1], np.full(n, h),
                    start + np.arange(n), np.full(n, size),
                ])

    hot_slices = slices.filter("hot").select(*TEXT, "start", "slice")
    if hot_slices.take(1):
        whole = hot_slices.mapInArrow(strings, SUFFIX_SCHEMA)
        repeats = sorted_neighbours(whole, ["k1", "k2", "k3", "hash", "start"], whole, _equal_rating)
        spans = spans.unionByName(repeats.select(*TEXT, F.col("start").alias("first"), F.col("start").alias("last")))
    return spans


def merge_spans(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal removed runs (start, end) from runs of starts (first, last)."""
    out: list[list[int]] = []
    for a, b in sorted(starts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


def cut_texts(docs: DataFrame, text: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(hash, n_bytes, spans, kept) of the distinct texts with a repeated string inside:
    removed runs as array<struct<start,end>> in bytes, and the bytes that stay."""

    @F.arrow_udf("struct<spans:array<struct<start:bigint,end:bigint>>,kept:binary>")
    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        spans, kept = [], []
        for t, found in zip(texts.to_pylist(), runs.to_pylist(), strict=True):
            data, parts, at = t.encode(), [], 0
            merged = merge_spans([(r["first"], r["last"]) for r in found], length)
            for a, b in merged:
                parts.append(data[at:a])
                at = b
            kept.append(b"".join([*parts, data[at:]]))
            spans.append([{"start": a, "end": b} for a, b in merged])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(spans, kind), pa.array(kept, pa.binary())], names=["spans", "kept"])

    texts = distinct_texts(docs, text, length)
    runs = repeated_spans(texts, length, hot).groupBy(*TEXT).agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    done = texts.join(runs, TEXT).withColumn("cut", cut("text", "runs"))
    return done.select(*TEXT, "cut.spans", "cut.kept")


def substring_rows(docs: DataFrame) -> DataFrame:
    """The digest of the contract, one row per document."""
    docs = docs.select("doc_id", "text")
    whole = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select("doc_id", *text_key(F.col("text")), F.sha2(whole, 256).alias("sha")), "rows")
    lost = cut_texts(docs).select(
        *TEXT, F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("removed"),
        F.size("spans").cast("long").alias("runs"), F.sha2("kept", 256).alias("kept_sha"), F.lit(0).cast("long").alias("copies"),
    )
    copies = rows.filter(F.col("n_bytes") >= LENGTH).groupBy(*TEXT).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    blank = [F.lit(None).cast("long").alias("removed"), F.lit(None).cast("long").alias("runs"), F.lit(None).cast("string").alias("kept_sha")]
    about = lost.unionByName(copies.select(*TEXT, *blank, "copies")).groupBy(*TEXT).agg(
        F.max("removed").alias("removed"), F.max("runs").alias("runs"), F.max("kept_sha").alias("kept_sha"),
        F.max("copies").alias("copies"),
    )
    # a table of its own, so that Spark can split the rows of a text with many copies
    joined = rows.join(materialize(about, "losses"), TEXT, "left")
    copied, zero = F.coalesce(F.col("copies"), F.lit(0)) > 1, F.lit(0).cast("long")
    return joined.select(
        "doc_id", "n_bytes", F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.when(copied, zero + 1).otherwise(F.coalesce("runs", zero)).alias("n_spans"),
        F.when(copied, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )
