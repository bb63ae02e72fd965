"""SimHash near-dedup (operator 9) with a Gray-order hierarchical index.

Each text gets a 64-bit fingerprint: the bitwise majority of the XXH64 hashes of
its word shingles.  Equal fingerprints are one node.  Two fingerprints within
``max_bits`` differing bits agree in at least one of ``max_bits + 1`` blocks of
bits, so every node goes to one bucket per block; a bucket that is too large is
dealt again by blocks of its remaining bits, which stays exact.

A bucket is searched by an index over its fingerprints in Gray order.  Runs of
neighbours form nodes, runs of nodes upper nodes; a node holds the bits that all
its members share, as a mask and a pattern, and a lower node only the bits that
its parent does not.  A search adds up the differences from the top and leaves
a whole group as soon as the sum passes ``max_bits``.  A bucket returns a
spanning forest of its links, never all pairs; components join the forests.

Defined results: a null or empty text has fingerprint zero, linked like any
other; rows with a null doc_id take part, and a component of such rows only has
a null component_id; repeated rows share a component; an empty table gives an
empty result; extra columns are not read (the filter carries them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import col, fresh, materialize
from stockroom.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
# A bucket of more fingerprints than this is dealt again by its remaining bits, until
# at most FREE_BITS remain (so a bucket cannot hold more than 2 ** FREE_BITS), or until a
# further deal would need more than PARTS choices of blocks (only with max_bits above 3).
BUCKET = 2_000
FREE_BITS = 16
PARTS = 4_096
FAN_OUT = 16
_QUERIES = 512
_HASHES = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of one whole text."""
    parts = (text or "").encode().lower().split()  # bytes: A-Z only, the six ASCII blanks
    if not parts:
        return 0
    n = max(len(parts) - words + 1, 1)
    line = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if n == 1:
        return digest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _HASHES):
        some = [digest(line[a:b], SEED) for a, b in zip(starts[i : i + _HASHES], stops[i : i + _HASHES], strict=True)]
        bits = np.unpackbits(np.array(some, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, out: str, text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long."""

    @F.arrow_udf("bigint")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            got = np.array([fingerprint(t, words) for t in batch.to_pylist()], np.uint64)
            yield pa.array(got.view(np.int64), pa.int64())

    return docs.withColumn(out, udf(col(text)))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each 64-bit word in the reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class GrayIndex:
    """The hierarchical index over distinct fingerprints of one bucket."""

    def __init__(self, prints: np.ndarray, fan_out: int = FAN_OUT):
        self.fan_out = fan_out
        self.prints = prints[np.argsort(gray_rank(prints), kind="stable")]
        full = np.full(len(self.prints), np.uint64(0xFFFFFFFFFFFFFFFF))
        # levels from the fingerprints up: shared-bit mask and pattern of each node
        self.levels = [(full, self.prints)]
        while len(self.levels[-1][0]) > fan_out:
            mask, pattern = self.levels[-1]
            at = np.arange(0, len(mask), fan_out)
            first = np.repeat(pattern[at], np.diff(np.append(at, len(mask))))
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ first), at)
            self.levels.append((shared, pattern[at] & shared))
        # a lower node keeps only the bits its parent does not already compare
        self.own = []
        for k, (mask, pattern) in enumerate(self.levels):
            above = self.levels[k + 1][0] if k + 1 < len(self.levels) else None
            parent = np.arange(len(mask)) // fan_out
            rest = mask if above is None else mask & ~above[parent]
            self.own.append((rest, pattern & rest))

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, fingerprint number) of all pairs within ``most`` bits."""
        top = len(self.own) - 1
        mask, pattern = self.own[top]
        q = np.repeat(np.arange(len(queries)), len(mask))
        node = np.tile(np.arange(len(mask)), len(queries))
        sums = np.zeros(len(q), np.int64)
        for k in range(top, -1, -1):
            mask, pattern = self.own[k]
            sums = sums + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            near = sums <= most
            q, node, sums = q[near], node[near], sums[near]
            if k:
                below = len(self.own[k - 1][0])
                width = np.minimum(self.fan_out, below - node * self.fan_out)
                begin = np.repeat(node * self.fan_out, width)
                step = np.arange(len(begin)) - np.repeat(np.cumsum(width) - width, width)
                q, sums, node = np.repeat(q, width), np.repeat(sums, width), begin + step
        return q, node


def forest(prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints, as index pairs of ``prints``.

    Pairs whose ends are joined already are dropped at once; of the others each
    component takes one that leads to an earlier component, until none is left.
    """
    labels = np.arange(len(prints))
    index = GrayIndex(prints)
    place = np.argsort(gray_rank(prints), kind="stable")
    left, right = [labels[:0]], [labels[:0]]
    for i in range(0, len(prints), _QUERIES):
        q, node = index.search(prints[i : i + _QUERIES], most)
        a, b = q + i, place[node]
        while True:
            apart = labels[a] != labels[b]
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            late, first = np.unique(np.maximum(labels[a], labels[b]), return_index=True)
            left.append(a[first])
            right.append(b[first])
            labels[late] = np.minimum(labels[a], labels[b])[first]
            while not (labels[labels] == labels).all():
                labels = labels[labels]
    return np.concatenate(left), np.concatenate(right)


def _blocks(width: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``parts`` blocks that fill ``width`` bits."""
    edges = [width * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _mask(positions: list[int]) -> int:
    """The bits at ``positions`` as a signed long."""
    mask = sum(1 << p for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _next_choices(chosen: list[list[int]], parts: int) -> list[list[int]]:
    """Each choice of bits with each of ``parts`` blocks of its remaining bits."""
    out = []
    for taken in chosen:
        free = [p for p in range(64) if p not in taken]
        out += [taken + free[first : first + width] for first, width in _blocks(len(free), parts)]
    return out


def links(prints: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``print``) whose components
    are those of all links within ``max_bits`` bits."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def flush() -> pa.RecordBatch:
            group = np.concatenate(held) if held else np.zeros(0, np.int64)
            none = np.zeros(0, np.int64)
            left, right = forest(group.view(np.uint64), max_bits) if len(group) > 1 else (none, none)
            return pa.RecordBatch.from_arrays(
                [pa.array(group[left], pa.int64()), pa.array(group[right], pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            part, key = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            values = np.asarray(batch.column(2))
            new = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
            for i, j in zip([0, *new.tolist()], [*new.tolist(), len(part)], strict=True):
                if i == j:
                    continue
                this = (int(part[i]), int(key[i]))
                if this != held_key:
                    if len(held) > 1 or (held and len(held[0]) > 1):
                        yield flush()
                    held_key, held = this, []
                held.append(values[i:j])
        yield flush()

    # (part, key, print): part numbers the choice of bits, key holds those bits; the
    # children of part p are p * blocks .. p * blocks + blocks - 1
    blocks = max_bits + 1
    chosen: list[list[int]] = [[]]
    rows, edges = prints.select(F.lit(0).alias("part"), "print"), []
    while True:
        chosen = _next_choices(chosen, blocks)
        masks = F.array(*[F.lit(_mask(c)).cast("long") for c in chosen])
        child = F.posexplode(F.slice(masks, F.col("part") * blocks + 1, blocks)).alias("child", "mask")
        dealt = rows.select("part", "print", child).select(
            (F.col("part") * blocks + F.col("child")).alias("part"),
            F.col("print").bitwiseAND(F.col("mask")).alias("key"), "print",
        )
        sizes = dealt.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket)
        sizes = materialize(sizes.select("part", "key"), "hot-buckets")
        deeper = 64 - min(map(len, chosen)) > FREE_BITS and len(chosen) * blocks <= PARTS
        hot = deeper and bool(sizes.take(1))
        plain = dealt.join(sizes, ["part", "key"], "left_anti") if hot else dealt
        ordered = plain.repartition("part", "key").sortWithinPartitions("part", "key", "print")
        edges.append(ordered.select("part", "key", "print").mapInArrow(search, "a bigint, b bigint"))
        if not hot:
            break
        rows = materialize(dealt.join(sizes, ["part", "key"], "left_semi").select("part", "print").distinct(), "hot-prints")
    out = edges[0]
    for more in edges[1:]:
        out = out.unionAll(more)
    return out


def classes(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, text_hash, print, root, component_id) per row of ``docs``; ``root``
    is the least fingerprint (signed) of the component."""
    name = fresh(docs, "print")
    rows = materialize(
        with_fingerprint(docs.select(col(doc_id), col(text)), name, text, words).select(
            col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(col(text), F.lit(""))).alias("text_hash"),
            col(name).alias("print"),
        ),
        "fingerprints",
    )
    prints = materialize(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(links(prints, max_bits))
    # label every linked fingerprint with the least doc_id of its component
    member = prints.join(roots, prints["print"] == roots["node"]).select("least", "root")
    named = member.groupBy("root").agg(F.min("least").alias("component"))
    labels = roots.join(named, "root").select(F.col("node").alias("print"), "root", "component")
    own = prints.join(labels, "print", "left").select(
        "print", F.coalesce("root", "print").alias("root"),
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component")).alias("component_id"),
    )
    # a table of its own: the join below then has an exchange on either side,
    # which is what lets Spark split the rows of a hot fingerprint
    own = materialize(own, "labels")
    return rows.join(own, "print").select("doc_id", "text_hash", "print", "root", "component_id")


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of ``docs`` per component: that with the smallest doc_id (a null one
    only if there is no other), then the smallest text hash; columns unchanged."""
    found = classes(docs, text, doc_id, **options)
    known, number, digest = on = [fresh(docs, n) for n in ("known", "number", "digest")]
    chosen = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    )
    keys = chosen.select(
        (~F.col("first.no_id")).alias(known), F.coalesce("first.doc_id", F.lit(0)).alias(number),
        F.col("first.text_hash").alias(digest),
    )
    keyed = (
        docs.withColumn(known, col(doc_id).isNotNull())
        .withColumn(number, F.coalesce(col(doc_id).cast("long"), F.lit(0)))
        .withColumn(digest, F.xxhash64(F.coalesce(col(text), F.lit(""))))
    )
    return keyed.join(keys, on, "left_semi").dropDuplicates(on).drop(*on)


def simhash_rows(docs: DataFrame) -> DataFrame:
    """The digest of the contract, one row per document."""
    return classes(docs.select("doc_id", "text")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
