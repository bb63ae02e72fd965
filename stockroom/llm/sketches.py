"""MinHash near-dedup by fast similarity sketching (operator 11).

A text is its set of distinct word shingles.  Texts with equal words are one
node.

*Sketch.*  A sketch has ``t`` coordinates.  In round i < t every shingle is
hashed to one coordinate and a value, and a coordinate keeps its least (round,
value); in round t + j every shingle goes to coordinate j.  Rounds end when all
coordinates are filled, which round 2t - 1 guarantees even for one shingle.  A
large set is done after one or two rounds, so the cost is that of the set plus
t log t, while each coordinate agrees for two sets with the probability of
their Jaccard similarity and the number of agreements is concentrated as for
independent coordinates.  Whole batches of texts go through a round together.

*Banding.*  ``BAND_ROWS`` coordinates are a band; the number of bands is chosen
so that a link at the threshold is missed with probability ``MISSED`` at most.
The node with the least hash in a band's bucket stands for it, and the others hang on
it: a star a bucket, not its pairs.  Components of the stars are the candidate clusters.

*Verification.*  A cluster's texts meet once.  The sizes of all intersections
are counted from posting lists of its shingles, and links decided by whole
numbers.  A cluster of too many texts or shingles for one task is dealt in
slices: ``LEADERS`` of its members at a time are compared with all
members, a slice a task, until all members not yet compared with everything
are in one component, so that no undecided pair can join two.

Defined results: a null or empty text, or one of blanks, has an empty set and is
its own component; a text of fewer words than a shingle has one shingle; rows
with a null doc_id take part, and a component of such rows only has a null
component_id (its rows are kept); repeated rows share a component; an empty
table gives an empty result; texts of any length are sketched whole; extra columns are not
read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.common import col, materialize
from stockroom.llm.components import components

SHINGLE_WORDS = 3
PERCENT = 85
BAND_ROWS = 8
MISSED = 1e-6
# A cluster of more texts or shingles than this is compared in slices.
MEMBERS = 8_000
SHINGLES = 2_000_000
LEADERS = 2_048
_TEXTS, _WORDS = 2_048, 1 << 20  # texts and words sketched together
_EXPANDED = 1 << 22  # posting entries counted at once
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)
_M = np.uint64(0x9E3779B97F4A7C15)


def bands_for(percent: int = PERCENT, rows: int = BAND_ROWS, missed: float = MISSED) -> int:
    """Least number of bands that loses a link at the threshold with probability ``missed`` at most."""
    return math.ceil(math.log(missed) / math.log(1 - (percent / 100) ** rows))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation whose bits all depend on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[list[bytes]], words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Per list of words the distinct 64-bit shingle hashes, ascending."""
    vocab: dict[bytes, int] = defaultdict(count().__next__)
    ids = [np.fromiter(map(vocab.__getitem__, t), np.int64, len(t)) for t in texts]
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, vocab), np.uint64, len(vocab))
    out = []
    for some in ids:
        if not len(some):
            out.append(np.zeros(0, np.uint64))
            continue
        h = table[some]
        width = min(words, len(h))
        grams = np.full(len(h) - width + 1, width, np.uint64)
        for k in range(width):
            grams = mix(grams * _M + h[k : len(h) - width + 1 + k])
        out.append(np.unique(grams))
    return out


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """The sketches of non-empty sets, one row of ``t`` coordinates each."""
    out = np.full((len(sets), t), _EMPTY)
    flat = out.reshape(-1)
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for i in range(2 * t):
        if not len(values):
            break
        x = mix(values + np.uint64((i + 1) * int(_M) & int(_EMPTY)))
        kept = np.uint64(i) << np.uint64(32) | (x & _LOW)
        at = ((x >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(flat, owner * t + at, kept)
        open_rows = np.unique(owner)
        open_rows = open_rows[(out[open_rows] == _EMPTY).any(axis=1)]
        if len(open_rows) < len(sets):
            still = np.zeros(len(sets), bool)
            still[open_rows] = True
            values, owner = values[still[owner]], owner[still[owner]]
    return out


def band_keys(sketches: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One signed 64-bit key per band of each sketch."""
    grouped = sketches.reshape(len(sketches), -1, rows)
    keys = np.broadcast_to(np.arange(grouped.shape[1], dtype=np.uint64), grouped.shape[:2])
    for k in range(rows):
        keys = mix(keys * _M + grouped[:, :, k])
    return keys.view(np.int64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: A-Z only, the six ASCII blanks


def _signed(data: bytes) -> int:
    return int.from_bytes(data, "big", signed=True)


def sketch_rows(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, row_hash, hi, lo, n_shingles, keys) per row of (doc_id, row_hash, text);
    a batch sends the band keys of equal texts once."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = ["doc_id", "row_hash", "hi", "lo", "n_shingles", "keys"]

    def send(held: list[tuple], texts: list[list[bytes]]) -> pa.RecordBatch:
        sets = shingle_sets(texts, words)
        some = [i for i, s in enumerate(sets) if len(s)]
        made = band_keys(sketch([sets[i] for i in some], bands * rows), rows)
        keys = {i: k for i, k in zip(some, made, strict=True)}
        number = {}  # (hi, lo) -> place in texts
        for i, words_of in enumerate(texts):
            number[_digest(words_of)] = i
        out, sent = [], set()
        for d, h, key in held:
            i = number[key]
            first = key not in sent and i in keys
            sent.add(key)
            out.append((d, h, *key, len(sets[i]), keys[i] if first else []))
        columns = zip(*out, strict=True) if out else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, seen, size = [], [], set(), 0
        for batch in batches:
            for d, h, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = _words(t)
                key = _digest(found)
                held.append((d, h, key))
                if key not in seen:
                    seen.add(key)
                    texts.append(found)
                    size += len(found)
                if size >= _WORDS or len(texts) >= _TEXTS or len(held) >= 8 * _TEXTS:
                    yield send(held, texts)
                    held, texts, seen, size = [], [], set(), 0
        yield send(held, texts)

    return docs.mapInArrow(run, "doc_id bigint, row_hash bigint, hi bigint, lo bigint, n_shingles bigint, keys array<bigint>")


def _digest(words: list[bytes]) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(b" ".join(words))
    return _signed(d[:8]), _signed(d[8:])


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (least member) after adding the links ``a``-``b``."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = labels[labels]
            if (above == labels).all():
                break
            labels = above


class Postings:
    """Which of some sets hold a shingle; counts intersections with them."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate([*sets, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(values, kind="stable")  # owners ascend within a shingle
        self.owners = owner[order]
        self.values, self.starts = np.unique(values[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))

    def links(self, sets: list[np.ndarray], percent: int, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``sets``, number here) of the pairs at or above ``percent``;
        with ``before``, set i meets only the sets here with a number below before[i]."""
        k = len(self.sizes)
        sizes = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate([*sets, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets)), sizes)
        at = np.minimum(np.searchsorted(self.values, values), max(len(self.values) - 1, 0))
        known = self.values[at] == values if len(self.values) else np.zeros(len(values), bool)
        owner, at = owner[known], at[known]
        width = self.ends[at] - self.starts[at]
        counts = np.zeros(len(sets) * k, np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(width) // _EXPANDED)) + 1
        for part in np.split(np.arange(len(at)), cuts):
            if not len(part):
                continue
            w = width[part]
            total = np.cumsum(w)
            inside = np.arange(total[-1]) - np.repeat(total - w, w)
            other = self.owners[np.repeat(self.starts[at[part]], w) + inside]
            counts += np.bincount(np.repeat(owner[part], w) * k + other, minlength=len(counts))
        pairs = np.flatnonzero(counts)
        both, a, b = counts[pairs], pairs // k, pairs % k
        linked = 100 * both >= percent * (sizes[a] + self.sizes[b] - both)
        if before is not None:
            linked &= b < before[a]
        return a[linked], b[linked]


def cluster_labels(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """The component of each set under all links, as the number of its first set."""
    labels = np.arange(len(sets))
    index = Postings(sets)
    step = max(1, min(256, _EXPANDED // max(len(sets), 1)))
    for i in range(0, len(sets), step):
        some = sets[i : i + step]
        a, b = index.links(some, percent, np.arange(i, i + len(some)))
        labels = join_labels(labels, a + i, b)
    return labels


def _verify(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, hi, lo, text) by cluster -> (hi, lo, root_hi, root_lo)."""
    names = ["hi", "lo", "root_hi", "root_lo"]
    held, nodes, texts = None, [], []

    def flush() -> pa.RecordBatch:
        labels = cluster_labels(shingle_sets(texts, words), percent).tolist()
        rows = [(*n, *nodes[r]) for n, r in zip(nodes, labels, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    for batch in batches:
        for cluster, hi, lo, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if cluster != held:
                if nodes:
                    yield flush()
                held, nodes, texts = cluster, [], []
            nodes.append((hi, lo))
            texts.append(_words(text))
    if nodes:
        yield flush()


def _against_leaders(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, slice, leads, node, text), leaders first in a slice -> links (a, b), a forest a slice."""
    held, nodes, texts, leaders = None, [], [], 0

    def flush() -> pa.RecordBatch:
        sets = shingle_sets(texts, words)
        index = Postings(sets[:leaders])
        labels = np.arange(len(sets))
        for i in range(0, len(sets), 256):
            a, b = index.links(sets[i : i + 256], percent)
            labels = join_labels(labels, a + i, b)
        moved = np.flatnonzero(labels != np.arange(len(sets)))
        ids = np.array(nodes, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[labels[moved]])], names=["a", "b"])

    for batch in batches:
        for cluster, part, leads, node, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (cluster, part) != held:
                if leaders and nodes:
                    yield flush()
                held, nodes, texts, leaders = (cluster, part), [], [], 0
            nodes.append(node)
            texts.append(_words(text))
            leaders += leads
    if leaders and nodes:
        yield flush()


def _large_clusters(members: DataFrame, words: int, percent: int, slice_rows: int, leaders: int) -> DataFrame:
    """(hi, lo, root_hi, root_lo) of clusters too large for one task.

    Each round compares up to ``leaders`` members of a cluster with all its
    members.  A member is done once it was a leader.  Leaders are taken outside
    the largest component of the members that are not done; when nothing is left outside,
    the undecided pairs lie within one component.
    """
    nodes = materialize(members.withColumn("node", F.monotonically_increasing_id()), "near-large")
    sizes = nodes.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("slices"))
    sized = materialize(nodes.join(sizes, "cluster").select("cluster", "node", "slices", "text"), "near-slices")
    one_slice = sized.withColumns({"slice": F.pmod(F.xxhash64("node"), "slices").cast("int"), "leads": F.lit(0)})
    links, done, roots, number = None, None, None, 0
    while True:
        open_nodes = nodes.select("cluster", "node")
        if done is not None:
            open_nodes = open_nodes.join(done, "node", "left_anti").join(roots, "node", "left").select(
                "cluster", "node", F.coalesce("root", "node").alias("root")
            )
            counts = materialize(open_nodes.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n")), "near-parts")
            largest = counts.groupBy("cluster").agg(F.max(F.struct("n", "root")).alias("most")).select("cluster", "most.root")
            open_nodes = open_nodes.join(largest, ["cluster", "root"], "left_anti").select("cluster", "node")
        order = Window.partitionBy("cluster").orderBy(F.xxhash64("node", F.lit(number)), "node")
        chosen = open_nodes.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= leaders).select("node")
        chosen = materialize(chosen, "near-leaders")
        if not chosen.take(1):
            break
        copies = sized.join(chosen, "node").withColumns(
            {"slice": F.explode(F.sequence(F.lit(0), F.col("slices") - 1)), "leads": F.lit(1)}
        )
        rest = one_slice.join(chosen, "node", "left_anti")
        keys = ["cluster", "slice", "leads", "node", "text"]
        met = (
            rest.select(*keys).unionAll(copies.select(*keys)).repartition("cluster", "slice")
            .sortWithinPartitions("cluster", "slice", F.desc("leads"), "node")
            .mapInArrow(lambda batches: _against_leaders(batches, words, percent), "a bigint, b bigint")
        )
        links = met if links is None else links.unionAll(met)
        links = materialize(links, "near-links")
        done = materialize(chosen if done is None else done.unionAll(chosen), "near-done")
        roots = materialize(components(links), "near-roots")
        number += 1
    of = nodes.select("hi", "lo", "node")
    if roots is None:  # no large cluster
        return of.select("hi", "lo", F.col("hi").alias("root_hi"), F.col("lo").alias("root_lo"))
    named = of.join(roots, "node", "left").select("hi", "lo", F.coalesce("root", "node").alias("root"))
    first = of.select(F.col("node").alias("root"), F.col("hi").alias("root_hi"), F.col("lo").alias("root_lo"))
    return named.join(first, "root").select("hi", "lo", "root_hi", "root_lo")


def classes(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE_WORDS, percent: int = PERCENT,
    rows: int = BAND_ROWS, missed: float = MISSED, members: int = MEMBERS, shingles: int = SHINGLES, leaders: int = LEADERS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    source = docs.select(
        col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(col(text), F.lit(""))).alias("row_hash"),
        col(text).alias("text"),
    )
    found = materialize(sketch_rows(source, words, bands_for(percent, rows, missed), rows), "near-rows")
    some = found.filter("n_shingles > 0")
    # buckets with two nodes or more, and the node that stands for each
    band_rows = some.select("hi", F.explode("keys").alias("key"))
    buckets = band_rows.groupBy("key").agg(F.min("hi").alias("first"), F.max("hi").alias("last"))
    buckets = materialize(buckets.filter("first <> last").select("key", "first"), "near-buckets")
    stars = band_rows.join(buckets, "key").filter("hi <> first").select(F.col("hi").alias("a"), F.col("first").alias("b")).distinct()
    clusters = components(stars).select(F.col("node").alias("hi"), F.col("root").alias("cluster"))
    # one row a node: its least doc_id, and one row to read its text from
    nodes = materialize(
        some.groupBy("hi", "lo").agg(
            F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("number"), "row_hash")).alias("at"),
        ),
        "near-nodes",
    )
    member = materialize(nodes.join(clusters, "hi").select("hi", "lo", "n", "cluster", "at.*"), "near-members")
    sizes = member.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    sizes = sizes.select("cluster", ((F.col("size") > members) | (F.col("total") > shingles)).alias("large"))
    wanted = member.join(sizes, "cluster").drop("n")
    place = ["no_id", "number", "row_hash"]
    texts = source.select(
        F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("number"), "row_hash", "text"
    ).dropDuplicates(place)
    read = materialize(texts.join(wanted, place).select("cluster", "large", "hi", "lo", "text"), "near-texts")
    small = (
        read.filter("NOT large").select("cluster", "hi", "lo", "text").repartition("cluster").sortWithinPartitions("cluster", "hi", "lo")
        .mapInArrow(lambda batches: _verify(batches, words, percent), "hi bigint, lo bigint, root_hi bigint, root_lo bigint")
    )
    large = _large_clusters(read.filter("large").select("cluster", "hi", "lo", "text"), words, percent, members, leaders)
    labels = materialize(small.unionAll(large), "near-labels")
    linked = labels.join(nodes.select("hi", "lo", "least"), ["hi", "lo"])
    least = linked.groupBy("root_hi", "root_lo").agg(F.min("least").alias("component_id"))
    labelled = linked.select("hi", "lo", "root_hi", "root_lo").join(least, ["root_hi", "root_lo"]).select("hi", "lo", "component_id")
    alone = nodes.join(labels, ["hi", "lo"], "left_anti").select("hi", "lo", F.col("least").alias("component_id"))
    # a table of its own: the join below can then split the rows of a hot text
    own = materialize(labelled.unionAll(alone), "near-own")
    rows_out = some.select("doc_id", "n_shingles", "hi", "lo").join(own, ["hi", "lo"]).select("doc_id", "n_shingles", "component_id")
    empty = found.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return rows_out.unionAll(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_rows(docs: DataFrame) -> DataFrame:
    """The digest of the contract, one row per document."""
    return classes(docs.select("doc_id", "text"))
