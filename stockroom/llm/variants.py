"""Spelling variant grouping (operator 13) by dense prefix-suffix tiling.

Words are the maximal runs of Latin letters of all whole texts, A-Z in lower
case.  A run of a document whose checksum is a multiple of ``EVERY`` has one
code point deleted first, which plants misspellings.  Words of ``MIN_LENGTH``+
code points and ``MIN_COUNT``+ occurrences are compared.

Two words are near if one inserted, deleted or replaced code point turns one
into the other, that is if their common prefix and common suffix together
reach the longer length minus one.  One of the two then covers half of that
length, so words meet by (longer length, first half) and by (longer length,
last half); a pair that shares both halves is taken at the first.  The words of
a meeting place are padded code-point matrices, left- and right-aligned, and
blocks of them are compared column by column.  A place of more than ``TILE``
words is dealt as pairs of blocks, each a task of its own.  A block pair returns one row
per word (its near words, counted, and the best of them), never the pairs.

Forms are followed to the last one by doubling: a form occurs ``FACTOR`` times as
often as its word, so chains have no cycle and a logarithmic length.

Defined results: a null or empty text has no words; a null doc_id counts as the
empty text in the checksum; repeated rows count again; ties for a form go to the
smallest word by code points; an empty table gives an empty result; a text of any length is
read in pieces that end between words; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import col, materialize, shuffle_partitions

EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
FACTOR = 5
TILE = 2_048
_PIECE = 1 << 20  # bytes of a text worked on at once
_HELD = 400_000  # distinct words that a task counts before it sends them on
_ROWS = 256  # rows of a tile compared at once
# Latin-1 letters of the contract stay, every other byte becomes a blank
_LETTERS = bytes(c if chr(c).isascii() and chr(c).isalpha() or c >= 0xC0 else 32 for c in range(256))


def words_of(text: str, doc_id: int | None, every: int = EVERY) -> Iterator[list[bytes]]:
    """The words of one text, in lists, with the planted deletions."""
    # characters beyond Latin-1 become "?", which separates like any non-letter
    data = text.encode("latin-1", "replace").lower().translate(_LETTERS)
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    at = 0
    while at < len(data):
        end = data.find(b" ", at + _PIECE)
        piece = data[at : end if end >= 0 else len(data)]
        at += len(piece) + 1
        words = (piece if piece.isascii() else piece.decode("latin-1").encode()).split()
        sums = np.fromiter(map(zlib.crc32, words, repeat(prefix)), np.int64, len(words))
        for i in np.flatnonzero(sums % every == 0).tolist():
            word = words[i].decode()
            p = int(sums[i]) % len(word)
            words[i] = (word[:p] + word[p + 1 :]).encode()
        yield words


def count_words(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT, every: int = EVERY,
) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""

    def send(counts: Counter) -> pa.RecordBatch:
        words = pa.array(counts.keys(), pa.binary()).cast(pa.string())
        long = pc.greater_equal(pc.utf8_length(words), min_length)
        n = pa.array(counts.values(), pa.int64())
        return pa.RecordBatch.from_arrays([words.filter(long), n.filter(long)], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for words in words_of(t, d, every):
                    counts.update(words)
                    if len(counts) > _HELD:
                        yield send(counts)
                        counts = Counter()
        yield send(counts)

    rows = docs.select(col(doc_id).cast("long"), col(text)).filter(col(text).isNotNull())
    found = rows.mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class Tile:
    """The near words among the rows of one block pair."""

    def __init__(self, words: list[str], counts: np.ndarray, blocks: np.ndarray, longest: int, last: bool):
        # best first: most frequent, then smallest by code points
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.counts, self.blocks = counts[order], blocks[order]
        self.longest, self.last = longest, last
        self.length = np.array([len(w) for w in self.words])
        points = lambda ws: np.array(ws, f"<U{longest}").view(np.uint32).reshape(len(ws), longest)
        self.left, self.right = points(self.words), points([w[::-1] for w in self.words])

    def _common(self, points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common run from the aligned end, for rows ``a`` by rows ``b``."""
        same = np.ones((len(a), len(b)), bool)
        run = np.zeros((len(a), len(b)), np.uint16)
        for c in range(self.longest):
            x = points[:, c]
            same &= x[a][:, None] == x[b][None, :]
            if not same.any():
                break
            run += same
        return run

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers of near pairs, each pair once."""
        groups = np.unique(self.blocks)
        rows = np.flatnonzero(self.blocks == groups[0])
        others = np.flatnonzero(self.blocks == groups[-1])
        half = self.longest // 2
        for i in range(0, len(rows), _ROWS):
            a = rows[i : i + _ROWS]
            for j in range(0, len(others), TILE):
                b = others[j : j + TILE]
                if len(groups) == 1 and b[-1] <= a[0]:
                    continue
                prefix, suffix = self._common(self.left, a, b), self._common(self.right, a, b)
                hit = prefix + suffix >= self.longest - 1
                hit &= np.maximum(self.length[a][:, None], self.length[b][None, :]) == self.longest
                if len(groups) == 1:
                    hit &= a[:, None] < b[None, :]
                if self.last:  # pairs that share the first half too are taken there
                    hit &= prefix < half
                x, y = np.nonzero(hit)
                yield a[x], b[y]

    def rows(self) -> tuple[list[str], np.ndarray, list[str], np.ndarray]:
        """(word, near words, best near word, its count) of the words that have any."""
        n = len(self.words)
        count, best = np.zeros(n, np.int64), np.full(n, n)
        for a, b in self.near():
            np.add.at(count, a, 1)
            np.add.at(count, b, 1)
            np.minimum.at(best, a, b)
            np.minimum.at(best, b, a)
        some = np.flatnonzero(count)
        form = best[some]
        return [self.words[i] for i in some], count[some], [self.words[i] for i in form], self.counts[form]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (longest, last, half, low, high, word, n, block) by tile -> (word, n_near, form, form_n)."""
    held_key, words, counts, blocks = None, [], [], []

    def flush() -> pa.RecordBatch:
        tile = Tile(words, np.array(counts, np.int64), np.array(blocks), held_key[0], held_key[1])
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(tile.rows(), kinds, strict=True)], names=["word", "n_near", "form", "form_n"]
        )

    for batch in batches:
        for *key, word, n, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != held_key:
                if len(words) > 1:
                    yield flush()
                held_key, words, counts, blocks = key, [], [], []
            words.append(word)
            counts.append(n)
            blocks.append(block)
    if len(words) > 1:
        yield flush()


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, form, form_n): per word with a near word their number and the
    most frequent one; ``words`` holds distinct words with their counts ``n``."""
    length = F.length("word")

    def place(longest, last: bool):
        half = F.floor(longest / 2).cast("int")
        # substring with computed bounds; a word is never shorter than the half
        cut = F.col("word").substr(length - half + 1, half) if last else F.col("word").substr(F.lit(1), half)
        return F.struct(longest.cast("int").alias("longest"), F.lit(last).alias("last"), cut.alias("half"))

    places = F.array(*[place(m, last) for m in (length, length + 1) for last in (False, True)])
    at = ["longest", "last", "half"]
    dealt = materialize(words.select("word", "n", F.explode(places).alias("p")).select("p.*", "word", "n"), "variant-places")
    sizes = materialize(dealt.groupBy(*at).agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "variant-sizes")
    blocks = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    sides = (
        dealt.join(sizes, at).withColumns({"block": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
        .select(*at, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "word", "n", "block")
    )
    pair = [*at, "low", "high"]
    # a number of tasks: the rows are few, the comparisons are not
    tasks = shuffle_partitions(words.sparkSession)
    found = sides.repartition(tasks, *pair).sortWithinPartitions(*pair).mapInArrow(
        _compare, "word string, n_near bigint, form string, form_n bigint"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form) without cycles: the last form of each word, by doubling."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        after = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = now.join(after, now["root"] == after["at"], "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        step = materialize(step, "variant-roots")
        now = step.select("word", "root")
        if not step.filter("moved").take(1):
            return now


def group_variants(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT, factor: int = FACTOR, every: int = EVERY, tile: int = TILE,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = materialize(count_words(docs, text, doc_id, min_length, min_count, every), "variant-words")
    near = near_words(words, tile)
    fits = F.col("near_n") >= factor * F.col("n")
    near = near.select(F.col("word").alias("at"), F.col("n_near").alias("near"), F.col("form").alias("best"), F.col("form_n").alias("near_n"))
    judged = materialize(
        words.join(near, words["word"] == near["at"], "left").select(
            "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("near_n")).alias("form_n"),
        ),
        "variant-forms",
    )
    roots = last_forms(judged.filter("form IS NOT NULL")).withColumnRenamed("word", "at")
    return judged.join(roots, judged["word"] == roots["at"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variant_rows(docs: DataFrame) -> DataFrame:
    """The digest of the contract, one row per word."""
    return group_variants(docs.select("doc_id", "text"))
