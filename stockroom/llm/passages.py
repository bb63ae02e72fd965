"""Substring dedup by passages (operator 2): shared word windows, whatever the lines.

``paragraphs`` compares lines of 20 or more words as wholes.  This module finds
what lies inside a longer line or is wrapped over several lines: every run of
``WINDOW`` words (lower-cased ASCII, blanks and line ends alike) that also
starts anywhere else.

1. Equal texts become one text.
2. Of every window only its anchor is sent, the gram of ``GRAM`` words in it with
   the least hash.  Equal windows have their anchor at the same place, so a
   window whose anchor's gram occurs once in the table has no equal.
3. The windows at grams that occur again are sent with a 128-bit hash and their
   place.  Equal hashes are a class; its first window, by doc_id and place,
   stays and the others are removals.
4. The windows of a text are merged into runs of words: those in a removed
   window, and the others that a repeated window covers.

Defined results: a null or empty text has no words; rows with a null doc_id
take part and sort after all others; rows repeated in full are one place, listed
with equal answers (none removes the other); an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import BLANKS, col, materialize
from stockroom.llm.suffixes import TEXT, distinct_texts, text_key

WINDOW = 50
GRAM = 16
# Words worked on at once.
_BLOCK = 1 << 18
_POSITION_BITS = np.uint64(24)
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_IS_BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS.encode(), np.uint8))


def rolling(values: np.ndarray, width: int, multiplier: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` values, by doubling: hash(ab) = hash(a) * m^|b| + hash(b)."""
    got, done, size, h = None, 0, 1, values
    while True:
        m = np.uint64(pow(multiplier, size, 1 << 64))
        if width & size:
            n = max(len(values) - done - size + 1, 0)
            got = h if got is None else got[:n] * m + h[done : done + n]
            done += size
        if 2 * size > width:
            return got
        h = h[:-size] * m + h[size:] if len(h) > size else h[:0]
        size *= 2


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def blocks(texts: list[str], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
    """Two 64-bit hashes of each word of about ``_BLOCK`` words, the ends of the texts in
    them, and (text number, offset in it) of each; a longer text comes in pieces
    that overlap by ``window - 1`` words."""
    vocab: dict[bytes, int] = defaultdict(count().__next__)
    ids, ends, origin, held = [], [], [], 0

    def flush() -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
        digests = b"".join(map(xxhash.xxh3_128_digest, vocab))
        table = np.frombuffer(digests, ">u8").reshape(-1, 2).astype(np.uint64)
        return table[np.concatenate(ids)].T, np.array(ends), origin

    for number, t in enumerate(texts):
        words = t.encode().lower().split()  # bytes split at the six ASCII blanks
        for at in range(0, len(words) - window + 1, _BLOCK):
            piece = words[at : at + _BLOCK + window - 1]
            ids.append(np.fromiter(map(vocab.__getitem__, piece), np.int64, len(piece)))
            held += len(piece)
            ends.append(held)
            origin.append((number, at))
            if held >= _BLOCK:
                yield flush()
                vocab = defaultdict(count().__next__)
                ids, ends, origin, held = [], [], [], 0
    if ids:
        yield flush()


def anchors(words: np.ndarray, ends: np.ndarray, window: int, gram: int, places: bool = False):
    """(first start, last start, hash of the anchor's gram) of every run of windows with one anchor;
    with ``places`` the places of the anchors instead."""
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none if places else (none, none, none.astype(np.uint64))
    grams = _finish(rolling(words, gram, _MULTIPLIERS[0]))
    low = (grams >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
    span, size = window - gram + 1, 1  # gram positions in one window
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    anchor = (low & np.uint64((1 << int(_POSITION_BITS)) - 1)).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(ends, starts, side="right")
    inside = starts + window <= ends[text]
    starts, anchor, text = starts[inside], anchor[inside], text[inside]
    if places:
        return np.unique(anchor)
    if not len(starts):
        return none, none, none.astype(np.uint64)
    new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) + 1
    first, last = np.concatenate([[0], new]), np.concatenate([new, [len(starts)]]) - 1
    return starts[first], starts[last], grams[anchor[first]]


def _batch(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Batches (hash, n_bytes, text) -> (gram, hash, n_bytes, first, last) of the runs of windows."""
    for batch in batches:
        hashes, sizes = (np.asarray(batch.column(i)).astype(np.int64) for i in (0, 1))
        for words, ends, origin in blocks(batch.column(2).to_pylist(), window):
            first, last, grams = anchors(words[0], ends, window, gram)
            piece = np.searchsorted(ends, first, side="right")
            shift = (np.array([o for _, o in origin]) - np.concatenate([[0], ends[:-1]]))[piece]
            number = np.array([n for n, _ in origin])[piece]
            yield _batch(["gram", *TEXT, "first", "last"], [
                grams.view(np.int64), hashes[number], sizes[number], first + shift, last + shift
            ])


def _window_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Batches (hash, n_bytes, no_id, number, text, runs) -> (hi, lo, no_id, number, start, hash, n_bytes)."""
    names, none = ["hi", "lo", "no_id", "number", "start", *TEXT], np.zeros(0, np.int64)
    for batch in batches:
        hashes, sizes, no_id, doc = (np.array(batch.column(i).to_pylist()) for i in range(4))
        wanted = [
            np.concatenate([none, *(np.arange(r["first"], r["last"] + 1) for r in sorted(runs, key=lambda r: r["first"]))])
            for runs in batch.column(5).to_pylist()
        ]
        for words, ends, origin in blocks(batch.column(4).to_pylist(), window):
            values = [_finish(rolling(w, window, m)).view(np.int64) for w, m in zip(words, _MULTIPLIERS, strict=True)]
            at, starts, number, begin = [], [], [], 0
            for end, (n, offset) in zip(ends.tolist(), origin, strict=True):
                some = wanted[n]
                some = some[(some >= offset) & (some + window <= offset + end - begin)]
                at.append(some - offset + begin)
                starts.append(some)
                number.append(np.full(len(some), n))
                begin = end
            at, starts, number = (np.concatenate(x) for x in (at, starts, number))
            yield _batch(names, [
                values[0][at], values[1][at], no_id[number].astype(bool), doc[number].astype(np.int64), starts,
                hashes[number].astype(np.int64), sizes[number].astype(np.int64),
            ])


def _bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word, in code points."""
    data = np.frombuffer(text.encode(), np.uint8)
    word = np.concatenate([[False], ~_IS_BLANK[data], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before each byte
    return points[edges[::2]], points[edges[1::2]]


def _covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return np.cumsum(edges)[:n] > 0


def spans_of(text: str, starts: np.ndarray, first: np.ndarray, copied: bool, window: int) -> list[dict]:
    """Runs of words of ``text`` in repeated windows, those in removed windows apart.

    ``starts``: repeated windows; ``first``: whether each is its class's first;
    ``copied``: the text has copies, so that all windows are repeated.
    """
    begin, end = _bounds(text)
    n = len(begin)
    if n < window:
        return []
    removed = _covered(n, starts[~first], window)
    state = np.where(removed, 2, 1 if copied else _covered(n, starts, window).astype(int))
    cuts = np.concatenate([[0], np.flatnonzero(state[1:] != state[:-1]) + 1, [n]]).tolist()
    return [
        {"start": int(begin[a]), "end": int(end[b - 1]), "n_words": b - a, "removed": bool(state[a] == 2)}
        for a, b in zip(cuts, cuts[1:], strict=False) if state[a]
    ]


def passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per run of repeated words of a row: doc_id, start, end (code points,
    end exclusive), n_words, removed.  The runs of a row do not overlap."""
    least = 2 * window - 1  # bytes of a window
    number = col(doc_id).cast("long")
    rows = materialize(
        docs.select(
            number.alias("doc_id"), number.isNull().alias("no_id"), F.coalesce(number, F.lit(0)).alias("number"), *text_key(col(text))
        ).filter(F.col("n_bytes") >= least),
        "passage-rows",
    )
    texts = distinct_texts(docs, text, least)
    about = materialize(
        rows.select(*TEXT, "no_id", "number").distinct().groupBy(*TEXT)
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("no_id", "number")).alias("at"))
        .select(*TEXT, "copies", "at.no_id", "at.number"),
        "passage-texts",
    )
    found = materialize(
        texts.select(*TEXT, "text").mapInArrow(
            lambda batches: _anchor_rows(batches, window, gram), "gram bigint, hash bigint, n_bytes bigint, first bigint, last bigint"
        ),
        "passage-anchors",
    )
    # tables of their own, here and below, so that Spark can split the rows of a hot key
    grams = materialize(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "passage-grams")
    wanted = found.join(grams, "gram").groupBy(*TEXT).agg(F.collect_list(F.struct("first", "last")).alias("runs"))  # bounded by the text
    windows = materialize(
        texts.join(wanted, TEXT).join(about, TEXT).select(*TEXT, "no_id", "number", "text", "runs").mapInArrow(
            lambda batches: _window_rows(batches, window),
            "hi bigint, lo bigint, no_id boolean, number bigint, start bigint, hash bigint, n_bytes bigint",
        ),
        "passage-windows",
    )
    place = F.struct("no_id", "number", "start", *TEXT)
    classes = materialize(
        windows.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n"),
        "passage-classes",
    )
    repeated = windows.join(classes, ["hi", "lo"]).select(*TEXT, "start", (place == F.col("first")).alias("is_first"))
    runs = repeated.groupBy(*TEXT).agg(F.collect_list(F.struct("start", "is_first")).alias("runs"))  # bounded by the text
    span = "struct<start:bigint,end:bigint,n_words:int,removed:boolean>"

    @F.arrow_udf(f"struct<own:array<{span}>,copy:array<{span}>>")
    def mark(texts: pa.Array, copies: pa.Array, runs: pa.Array) -> pa.Array:
        own, copy = [], []
        for t, n, got in zip(texts.to_pylist(), copies.to_pylist(), runs.to_pylist(), strict=True):
            starts = np.array([r["start"] for r in got or ()], np.int64)
            own.append(spans_of(t, starts, np.array([r["is_first"] for r in got or ()], bool), n > 1, window))
            begin, end = _bounds(t)
            whole = n > 1 and len(begin) >= window
            copy.append([{"start": int(begin[0]), "end": int(end[-1]), "n_words": len(begin), "removed": True}] if whole else [])
        fields = [("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int32()), ("removed", pa.bool_())]
        kind = pa.list_(pa.struct(fields))
        return pa.StructArray.from_arrays([pa.array(own, kind), pa.array(copy, kind)], names=["own", "copy"])

    marked = materialize(
        texts.join(about, TEXT).join(runs, TEXT, "left").filter("copies > 1 OR runs IS NOT NULL")
        .select(*TEXT, F.struct("no_id", "number").alias("at"), mark("text", "copies", "runs").alias("spans")),
        "passage-spans",
    )
    mine = F.when(F.struct("no_id", "number") == F.col("at"), F.col("spans.own")).otherwise(F.col("spans.copy"))
    return rows.join(marked, TEXT).select("doc_id", F.explode(mine).alias("s")).select(
        "doc_id", "s.start", "s.end", "s.n_words", "s.removed"
    )


def passage_rows(docs: DataFrame) -> DataFrame:
    """Every run of 50+ words that repeats anywhere in the table, over lines and inside them."""
    return passages(docs.select("doc_id", "text"))
