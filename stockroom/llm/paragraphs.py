"""Substring dedup by paragraphs (operator 2): MinHash banding, verified and clustered.

Two kinds of paragraphs of a text take part, each compared with its own kind.

*Lines* of ``MIN_WORDS``+ words.  Equal lines are one node.  A node's set of word
shingles gives a MinHash signature whose bands are tuned for a recall of
``RECALL`` at the threshold.  Nodes that collide in a band meet in a bucket with
their texts; the bucket verifies exact Jaccard similarity, counting shared shingles in blocks
from posting lists, or by matrix products where many of a large bucket's nodes hold them, and
returns each node with the first of its component, never all pairs.  A bucket of more than
``BUCKET`` nodes is dealt in slices, and every two slices meet, which loses no link.

*Passages*, for what lies inside a line or runs over several: every run of ``WINDOW``
words, line ends counting as blanks, has a one-row signature, the least hash of its
shingles of ``PASSAGE_WORDS`` words.  The shingle that holds it is the run's
paragraph.  Equal runs have it at the same place, so every passage of
``WINDOW``+ words that occurs again has a paragraph that occurs again, and as a
shingle is longer than the way from one to the next, the paragraphs of a
passage cover it from the first to the last.  A collision is verified by the words
themselves (128 bits of their hash).

Components of the links are the classes; the first paragraph of a class, by
doc_id and place, stays and the others are removals.

Defined results: a null or empty text has no paragraphs; rows with a null
doc_id take part and sort after all others; rows repeated in full are one place,
listed with equal answers (none removes the other); equal and near paragraphs are ties that go to
the first place; a text of any length is hashed in blocks of words; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import col, materialize
from stockroom.llm.components import components
from stockroom.llm.passages import _MULTIPLIERS, _bounds, _finish, anchors, blocks, rolling
from stockroom.llm.sketches import _M, join_labels, mix

MIN_WORDS = 20
SHINGLE_WORDS = 5
SIMILARITY = 0.8
RECALL = 0.995
BAND_ROWS = 2
BUCKET = 2_000
WINDOW = 50
PASSAGE_WORDS = 26
_BATCH_CHARS = 1 << 21  # text worked on at once
_SEARCHED = 2_048  # lines verified at once, or those of one key
_LARGE = 128  # lines of a key that is verified on its own
_COMMON = 16  # a shingle is common if one line in so many holds it
_CELLS = 1 << 24  # of a matrix of common shingles
_EXPANDED = 1 << 20  # posting entries counted at once
_FOUND = ["doc_id", "row_hash", "passage", "paragraph", "start", "end", "n_words", "hi", "lo", "bands"]
_MULTIPLIER = 0x9E3779B97F4A7C15
LINE, PASSAGE = "line", "passage"


def bands_for(similarity: float = SIMILARITY, rows: int = BAND_ROWS, recall: float = RECALL) -> int:
    """Least number of bands of ``rows`` values that finds a pair at ``similarity`` with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 64, n, np.uint64) | np.uint64(1), rng.integers(0, 1 << 64, n, np.uint64)


def band_keys(words: list[list[bytes]], bands: int, rows: int = BAND_ROWS, n: int = SHINGLE_WORDS) -> np.ndarray:
    """One signed 64-bit key per band of each list of ``n`` words or more."""
    vocab: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(vocab.__getitem__, chain.from_iterable(words)), np.int64)
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, vocab), np.uint64, len(vocab))
    size = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(size) - size
    grams = np.append(_finish(rolling(table[ids], n, _MULTIPLIER)), np.zeros(n, np.uint64))
    # begin and end of each list's shingles; what lies between is reduced too and not used
    edges = np.stack([begin, begin + size - n + 1], axis=1).reshape(-1)
    a, b = _permutations(bands * rows)
    keys = np.empty((len(words), bands), np.uint64)
    for i in range(bands):
        key = np.full(len(words), i, np.uint64)
        for k in range(i * rows, (i + 1) * rows):
            mixed = grams * a[k] + b[k]
            key = _finish(key * np.uint64(_MULTIPLIER) + np.minimum.reduceat(mixed ^ (mixed >> np.uint64(29)), edges)[::2])
        keys[:, i] = key
    return keys.view(np.int64)


def split_paragraphs(text: str, min_words: int) -> Iterator[tuple[int, int, int, list[bytes]]]:
    """(number, start, end, lower-cased words) of the lines with enough words; code points, end exclusive."""
    at = 0
    for number, line in enumerate(text.split("\n")):
        if len(line) >= 2 * min_words - 1:
            words = line.encode().lower().split()
            if len(words) >= min_words:
                yield number, at, at + len(line), words
        at += len(line) + 1


def split_passages(texts: list[str], window: int = WINDOW, size: int = PASSAGE_WORDS) -> list[np.ndarray]:
    """Passage paragraphs of some texts, as columns: number of the text, line it starts in,
    start, end, and the two halves of the hash of its words."""
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 4]  # text, first word, hash
    for words, ends, origin in blocks(texts, window):
        at = anchors(words[0], ends, window, size, places=True)
        piece = np.searchsorted(ends, at, side="right")
        number, offset = np.array(origin).T
        begin = np.concatenate([[0], ends[:-1]])
        hashes = [_finish(rolling(w, size, m)[at]).view(np.int64) for w, m in zip(words, _MULTIPLIERS, strict=True)]
        found.append([number[piece], at - begin[piece] + offset[piece], *hashes])
    text, first, hi, lo = (np.concatenate(c) for c in zip(*found, strict=True))
    _, once = np.unique(np.stack([text, first]), axis=1, return_index=True)  # pieces of a long text overlap
    text, first, hi, lo = text[once], first[once], hi[once], lo[once]
    line, start, end = (np.zeros(len(text), np.int64) for _ in range(3))
    for k in np.unique(text).tolist():
        mine = slice(*np.searchsorted(text, [k, k + 1]))
        begin, stop = _bounds(texts[k])
        start[mine], end[mine] = begin[first[mine]], stop[first[mine] + size - 1]
        breaks = np.flatnonzero(np.frombuffer(texts[k].encode("utf-32-le"), np.uint32) == 10)
        line[mine] = np.searchsorted(breaks, start[mine])
    return [text, line, start, end, hi, lo]


def _key(words: list[bytes]) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(b" ".join(words))
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


class _Postings:
    """Which of some texts hold a shingle; a text shares shingles with those of its bucket only.
    ``bucket`` numbers the bucket of each text."""

    def __init__(self, texts: list[bytes], bucket: np.ndarray, n: int = SHINGLE_WORDS):
        vocab: dict[bytes, int] = defaultdict(count().__next__)
        size = np.array([t.count(b" ") + 1 for t in texts], np.int64)
        ids = np.fromiter(map(vocab.__getitem__, chain.from_iterable(t.split(b" ") for t in texts)), np.int64, int(size.sum()))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, vocab), np.uint64, len(vocab))[ids]
        width = np.minimum(size, n)  # the whole text if it is shorter
        got = size - width + 1
        owner = np.repeat(np.arange(len(texts)), got)
        at = np.arange(len(owner)) + np.repeat(np.cumsum(size) - size - np.cumsum(got) + got, got)
        grams = mix(mix(bucket.astype(np.uint64) * _M) ^ np.uint64(n))[owner]
        for k in range(int(width.max(initial=0))):
            more = slice(None) if (width > k).all() else np.flatnonzero(width[owner] > k)
            grams[more] = mix(grams[more] * _M + hashes[at[more] + k])
        order = np.argsort(grams, kind="stable")  # owners ascend within a shingle
        grams, owner = grams[order], owner[order]
        once = np.append(True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1]))[: len(grams)]
        grams, owner = grams[once], owner[once]
        self.sizes = np.bincount(owner, minlength=len(texts))
        starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])[: len(grams)])
        held = np.diff(np.append(starts, len(grams)))
        self.held = np.repeat(held, held)
        self.rank = np.arange(len(grams)) - np.repeat(starts, held)  # place in its shingle's list
        self.owners = owner

    def shared(self, first: np.ndarray, before: np.ndarray, cells: int, some: np.ndarray) -> np.ndarray:
        """Counts of shared shingles, by ``first[a] + before[b]``, of texts a and b < a, over the entries ``some``."""
        counts = np.zeros(cells, np.int64)
        width = self.rank[some]
        cuts = np.flatnonzero(np.diff(np.cumsum(width) // _EXPANDED)) + 1
        for part in np.split(some, cuts):
            w = self.rank[part]
            total = np.cumsum(w)
            if not len(total) or not total[-1]:
                continue
            inside = np.arange(total[-1]) - np.repeat(total - w, w)
            other = self.owners[np.repeat(part - w, w) + inside]
            counts += np.bincount(np.repeat(first[self.owners[part]], w) + before[other], minlength=cells)
        return counts


def _linked(both: np.ndarray, a: np.ndarray, b: np.ndarray, percent: float) -> np.ndarray:
    return 100 * both >= percent * (a + b - both)


def _small_labels(texts: list[bytes], bucket: np.ndarray, percent: float) -> np.ndarray:
    """The component of each text under all links within its bucket, as the number of its first text;
    one table of counts holds all pairs of all buckets."""
    post = _Postings(texts, bucket)
    size = np.bincount(bucket)
    begin = np.cumsum(size) - size
    base = np.cumsum(size * size) - size * size
    inside = np.arange(len(texts)) - begin[bucket]
    counts = post.shared(base[bucket] + inside * size[bucket], inside, int((size * size).sum()), np.flatnonzero(post.rank))
    cell = np.flatnonzero(counts)
    of = np.searchsorted(base, cell, side="right") - 1
    a, b = begin[of] + (cell - base[of]) // size[of], begin[of] + (cell - base[of]) % size[of]
    ok = _linked(counts[cell], post.sizes[a], post.sizes[b], percent)
    return join_labels(np.arange(len(texts)), a[ok], b[ok])


def _large_labels(texts: list[bytes], percent: float) -> np.ndarray:
    """The same of one large bucket.  Shingles that a good part of its texts hold are counted
    by products of 0/1 matrices, the others from posting lists: no pair has a cost of its own for each shared shingle."""
    k = len(texts)
    post = _Postings(texts, np.zeros(k, np.int64))
    head = np.flatnonzero((post.rank == 0) & (post.held * _COMMON >= k))
    if len(head) * k > _CELLS:  # the most frequent ones that fit
        head = np.sort(head[np.argsort(-post.held[head], kind="stable")[: _CELLS // k]])
    column = np.full(len(post.owners), -1)
    column[head] = np.arange(len(head))
    column = np.where(post.held > 1, column[np.arange(len(column)) - post.rank], -1)
    common = column >= 0
    matrix = np.zeros((k, len(head)), np.float32)
    matrix[post.owners[common], column[common]] = 1
    rest = np.flatnonzero(~common & (post.rank > 0))
    rest = rest[np.argsort(post.owners[rest], kind="stable")]
    place, labels = np.arange(k), np.arange(k)
    step = max(1, min(256, _EXPANDED // k))
    for i in range(0, k, step):
        stop = min(i + step, k)
        some = rest[slice(*np.searchsorted(post.owners[rest], [i, stop]))]
        both = post.shared((place - i) * stop, place, (stop - i) * stop, some).reshape(-1, stop)
        both += (matrix[i:stop] @ matrix[:stop].T).astype(np.int64)  # whole numbers below 2**24: exact
        a, b = np.nonzero(_linked(both, post.sizes[i:stop, None], post.sizes[None, :stop], percent))
        labels = join_labels(labels, a + i, b)
    return labels


def _search(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, words) by key -> links (a, b): each node with the first of its component in the key.

    Many small keys go through one count of shared shingles.
    """
    percent = round(100 * similarity, 9)
    nodes, texts, starts, held = [], [], [], 0

    def flush() -> pa.RecordBatch:
        size = np.diff(np.append(np.array(starts, np.int64), len(nodes)))
        large = size >= _LARGE
        labels = np.arange(len(nodes))
        at = np.flatnonzero(np.repeat(~large, size))
        if len(at):
            bucket = np.repeat(np.arange(int((~large).sum())), size[~large])
            labels[at] = at[_small_labels([texts[i] for i in at], bucket, percent)]
        for j in np.flatnonzero(large).tolist():
            labels[starts[j] : starts[j] + size[j]] = starts[j] + _large_labels(texts[starts[j] : starts[j] + size[j]], percent)
        moved = np.flatnonzero(labels != np.arange(len(labels)))
        ids = np.array(nodes, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids[labels[moved]]), pa.array(ids[moved])], names=["a", "b"])

    last = None
    for batch in batches:
        for key, node, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != last or not nodes:
                if len(nodes) >= _SEARCHED or held >= _BATCH_CHARS:
                    yield flush()
                    nodes, texts, starts, held = [], [], [], 0
                starts.append(len(nodes))
                last = key
            nodes.append(node)
            texts.append(words)
            held += len(words)
    yield flush()


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "start", "end", "row_hash", "paragraph")


def _source(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(
        col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(col(text), F.lit(""))).alias("row_hash"),
        col(text).alias("text"),
    )


def _found(batches: Iterator[pa.RecordBatch], min_words: int, bands: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, row_hash, text) -> their paragraphs of both kinds; only lines have band keys."""
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def send(held: list[tuple[int | None, int, str]]) -> pa.RecordBatch:
        rows, lines, at, seen = [], [], [], set()
        for d, h, t in held:
            for number, start, end, words in split_paragraphs(t, min_words):
                key = _key(words)
                if key not in seen:  # a batch sends the band keys of equal lines once
                    seen.add(key)
                    lines.append(words)
                    at.append(len(rows))
                rows.append([d, h, False, number, start, end, len(words), *key, []])
        if lines:
            for i, keys in zip(at, band_keys(lines, bands), strict=True):
                rows[i][-1] = keys
        columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_FOUND)

    def send_passages(held: list[tuple[int | None, int, str]]) -> pa.RecordBatch:
        text, line, start, end, hi, lo = split_passages([t for _, _, t in held])
        ids = pa.array([d for d, _, _ in held], pa.int64()).take(pa.array(text))
        hashes = np.array([h for _, h, _ in held], np.int64)
        n = len(text)
        columns = [
            ids, hashes[text] if n else [], np.ones(n, bool), line, start, end, np.full(n, PASSAGE_WORDS), hi, lo, pa.nulls(n, kinds[-1])
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, k) if not isinstance(c, pa.Array) else c for c, k in zip(columns, kinds, strict=True)], names=_FOUND)

    held, size = [], 0
    for batch in batches:
        for d, h, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if t:
                held.append((d, h, t))
                size += len(t)
            if size > _BATCH_CHARS:
                yield send(held)
                yield send_passages(held)
                held, size = [], 0
    yield send(held)
    yield send_passages(held)


def classes(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY, recall: float = RECALL, bucket: int = BUCKET, kinds: tuple[str, ...] = (LINE, PASSAGE),
) -> DataFrame:
    """One row per paragraph of a class of two or more: kind, doc_id, paragraph (the line it
    starts in), start, end, n_words, class_doc, class_paragraph and class_start (the class's
    first member), removed."""
    bands = bands_for(similarity, BAND_ROWS, recall)
    source = _source(docs, text, doc_id)
    found = materialize(
        source.mapInArrow(
            lambda batches: _found(batches, min_words, bands),
            "doc_id bigint, row_hash bigint, passage boolean, paragraph int, start int, end int, n_words int, hi bigint, "
            "lo bigint, bands array<bigint>",
        ),
        "paragraphs",
    )
    lines = found.filter("NOT passage")
    out = _line_classes(source, lines.drop("passage"), similarity, bucket).withColumn("kind", F.lit(LINE)) if LINE in kinds else None
    if PASSAGE in kinds:
        more = _equal_classes(found.filter("passage").drop("passage", "bands")).withColumn("kind", F.lit(PASSAGE))
        out = more if out is None else out.unionByName(more)
    return out.select(
        "kind", "doc_id", "paragraph", "start", "end", "n_words", F.col("class_first.doc_id").alias("class_doc"),
        F.col("class_first.paragraph").alias("class_paragraph"), F.col("class_first.start").alias("class_start"),
        (_place() != F.col("class_first")).alias("removed"),
    )


def _equal_classes(found: DataFrame) -> DataFrame:
    """Paragraphs whose words occur at another place, with the first place.

    What occurs again is decided over the hashes alone; only those rows are
    shuffled with their places, and a table of their own lets Spark split a hot one.
    """
    again = materialize(
        found.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("hi", "lo"), "passage-keys"
    )
    repeated = materialize(found.join(again, ["hi", "lo"]), "passage-places")
    first = repeated.groupBy("hi", "lo").agg(F.min(_place()).alias("class_first"))
    return repeated.join(materialize(first, "passage-first"), ["hi", "lo"])


def _line_classes(source: DataFrame, found: DataFrame, similarity: float, bucket: int) -> DataFrame:
    """Lines of classes of two or more, with the class's first place."""
    place = _place()
    # buckets with two nodes or more
    band_rows = found.select("hi", "lo", F.explode("bands").alias("band"))
    shared = band_rows.groupBy("band").agg(F.min("hi").alias("least"), F.max("hi").alias("most")).filter("least <> most").select("band")
    colliding = materialize(band_rows.join(materialize(shared, "shared-bands"), "band").distinct(), "colliding")
    counts = colliding.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    keys = colliding.select("hi", "lo").distinct()
    # one place to read each colliding line from
    at = found.join(keys, ["hi", "lo"]).groupBy("hi", "lo").agg(F.min(place).alias("place"))
    wanted = at.groupBy(
        F.col("place.no_id").alias("no_id"), F.coalesce("place.doc_id", F.lit(0)).alias("number"),
        F.col("place.row_hash").alias("row_hash"),
    ).agg(F.collect_list(F.struct(F.col("place.start").alias("start"), F.col("place.end").alias("end"), "hi", "lo")).alias("wanted"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in wanted:
                    words = t[w["start"] : w["end"]].encode().lower().split()
                    rows.append((w["hi"], w["lo"], b" ".join(words)))
            columns = zip(*rows, strict=True) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)],
                names=["hi", "lo", "words"],
            )

    keyed = source.withColumns({"no_id": F.col("doc_id").isNull(), "number": F.coalesce("doc_id", F.lit(0))})
    texts = (
        keyed.join(wanted, ["no_id", "number", "row_hash"]).select("text", "wanted")
        .mapInArrow(read, "hi bigint, lo bigint, words binary").dropDuplicates(["hi", "lo"])
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = materialize(texts, "paragraph-nodes")  # also fixes the node numbers

    members = colliding.join(counts, "band").join(nodes, ["hi", "lo"]).select("band", "n", "node", "words")
    small = members.filter(F.col("n") <= bucket).select("band", "node", "words")
    hot = members.filter(F.col("n") > bucket).select("band", "n", "node", "words")
    edges = materialize(_links(small, similarity).unionAll(_links(_dealt(hot, bucket), similarity)), "paragraph-links")
    roots = components(edges).select(F.col("node"), "root")
    named = nodes.select("hi", "lo", "node").join(roots, "node", "left").select(
        "hi", "lo", F.coalesce("root", "node").alias("root")
    )
    # classes over equal paragraphs first, then over linked ones
    equal = found.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"))
    labelled = equal.join(named, ["hi", "lo"], "left")
    merged = labelled.filter("root IS NOT NULL").groupBy("root").agg(
        F.sum("copies").alias("copies"), F.min("first").alias("first")
    )
    whole = labelled.filter("root IS NOT NULL").select("hi", "lo", "root").join(merged, "root").select(
        "hi", "lo", "copies", "first"
    ).unionAll(labelled.filter("root IS NULL").select("hi", "lo", "copies", "first")).filter("copies > 1")
    whole = whole.select("hi", "lo", F.col("first").alias("class_first"))
    return found.drop("bands").join(whole, ["hi", "lo"])


def _links(members: DataFrame, similarity: float) -> DataFrame:
    return (
        members.repartition("band").sortWithinPartitions("band", "node")
        .mapInArrow(lambda batches: _search(batches, similarity), "a bigint, b bigint")
    )


def _dealt(hot: DataFrame, bucket: int) -> DataFrame:
    """Members of large buckets, dealt in slices of about ``bucket``; every two slices of a
    bucket, and so every two of its members, meet in a bucket of their own."""
    slices = F.ceil(F.col("n") / bucket).cast("int")
    own = hot.withColumns({"slices": slices, "slice": F.pmod(F.xxhash64("node"), slices).cast("int")})
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).filter("other <> slice")
    pair = F.xxhash64("band", F.least("slice", "other"), F.greatest("slice", "other"))
    return met.select(pair.alias("band"), "node", "words")


def paragraph_rows(docs: DataFrame) -> DataFrame:
    """Every line of 20+ words that repeats, exactly or nearly, and every paragraph of a repeated passage of 50+ words."""
    return classes(docs.select("doc_id", "text"))


def line_rows(docs: DataFrame) -> DataFrame:
    """The lines of ``paragraph_rows``."""
    return classes(docs.select("doc_id", "text"), kinds=(LINE,)).drop("kind", "class_start")
