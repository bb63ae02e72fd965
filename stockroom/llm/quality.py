"""Quality rules on repetition (operator 7).

Every text is cut into words; 64-bit rolling hashes of several n-gram lengths,
computed in numpy over a block of texts at a time, find the n-grams that occur
twice in one text.  A word position is covered when a duplicated n-gram spans
it; the rules compare the characters in covered words, and in lines that equal
an earlier line, with all characters.

Defined results: a null text counts as empty, has no words and is not kept; an
empty table gives an empty result; repeated rows are judged each on its own;
extra columns are carried through untouched.  Texts are taken whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import BLANKS, col, fresh

SYMBOLS = "#*$%&|<>"
BASE_N = 5
MIN_WORDS = 10
BASE_REPEAT_PERCENT = 20
# Highest percentage of a text's word characters that duplicated n-grams of each
# length may cover, and of its characters that may lie in repeated lines.  The
# limits are looser than those usual for web pages (15 to 10 and 20), which
# reject short good documents of the labelled rows for a single repeated line.
COVER_PERCENT = {5: 25, 6: 24, 7: 23, 8: 22, 9: 21, 10: 20}
LINE_PERCENT = 30

_BLOCK_WORDS = 200_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ODD = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", "n_chars"]


def _mix(x: np.ndarray) -> np.ndarray:
    """A random-looking 64-bit value per integer."""
    x = (x + np.uint64(1)) * _BASE
    x = (x ^ (x >> np.uint64(30))) * _ODD[0]
    x = (x ^ (x >> np.uint64(27))) * _ODD[1]
    return x ^ (x >> np.uint64(31))


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters in them."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0, 0
    seen, dup, chars = set(), 0, 0
    for line in lines:
        if line in seen:
            if line.strip(BLANKS):
                dup += 1
                chars += len(line)
        else:
            seen.add(line)
    return dup, chars


def _cover(hashes: np.ndarray, valid: np.ndarray, n: int, words: int) -> np.ndarray | None:
    """Word positions inside an n-gram whose hash occurs twice; None if there are none."""
    starts = np.flatnonzero(valid)
    h = hashes[starts]
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return None
    twice = np.unique(twice)
    at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    found = starts[twice[at] == h]
    edges = np.zeros(words + 1, np.int64)
    np.add.at(edges, found, 1)
    np.add.at(edges, found + n, -1)
    return np.cumsum(edges)[:words] > 0


def _block(texts: list[str], split: list[list[bytes]], lengths: list[int]) -> dict[str, np.ndarray]:
    vocab: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter((i for words in split for i in map(vocab.__getitem__, words)), np.uint64)
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    total, ends = len(ids), np.cumsum(sizes)
    begins = ends - sizes
    chars = np.fromiter((len(w.decode()) for w in vocab), np.int64, len(vocab))[ids.astype(np.int64)]
    doc = np.repeat(np.arange(len(texts)), sizes)
    left = ends[doc] - np.arange(total)  # words from here to the end of the text
    values, salt = _mix(ids), _mix(doc.astype(np.uint64) + np.uint64(1 << 40))

    def per_text(x: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(x)])
        return sums[ends] - sums[begins]

    out = {"n_words": sizes, "word_chars": per_text(chars)}
    rolling = values.copy()
    for n in range(2, max([BASE_N, *lengths]) + 1):
        rolling = rolling[:-1] * _BASE + values[n - 1 :] if total >= n else rolling[:0]
        if n != BASE_N and n not in lengths:
            continue
        fits = left[: len(rolling)] >= n
        cover = _cover(rolling ^ salt[: len(rolling)], fits, n, total) if len(rolling) else None
        zero = np.zeros(len(texts), np.int64)
        out[f"cover_{n}"] = zero if cover is None else per_text(np.where(cover, chars, 0))
        if n == BASE_N:
            out["n_repeat_words"] = zero if cover is None else per_text(cover.astype(np.int64))
    return out


def repetition(texts: list[str | None], lengths: list[int]) -> dict[str, np.ndarray]:
    """The measures of every text, in blocks of about ``_BLOCK_WORDS`` words."""
    texts = [t or "" for t in texts]
    parts: list[dict[str, np.ndarray]] = []
    block, split, words = [], [], 0

    def flush() -> None:
        nonlocal block, split, words
        if block:
            parts.append(_block(block, split, lengths))
        block, split, words = [], [], 0

    for t in texts:
        block.append(t)
        split.append(t.encode().split())  # bytes split at the six ASCII blanks
        words += len(split[-1])
        if words >= _BLOCK_WORDS:
            flush()
    flush()
    names = ["n_words", "word_chars", "n_repeat_words", *(f"cover_{n}" for n in lengths)]
    out = {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in names}
    lines = [_lines(t) for t in texts]
    out["n_dup_lines"] = np.array([x[0] for x in lines], np.int64)
    out["dup_line_chars"] = np.array([x[1] for x in lines], np.int64)
    out["n_symbols"] = np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64)
    out["n_chars"] = np.array([len(t) for t in texts], np.int64)
    return out


def measure(docs: DataFrame, out: str, text: str = "text", lengths: tuple[int, ...] = tuple(COVER_PERCENT)) -> DataFrame:
    """``docs`` with a struct column ``out`` of the measures of ``text``.

    Besides the counts it holds ``cover_<n>``: characters of words inside an
    n-gram of n words that occurs twice in the text, first occurrence included.
    """
    names = list(FIELDS) + [f"cover_{n}" for n in lengths]
    kind = pa.struct([(n, pa.int64()) for n in names])
    wanted = list(lengths)

    @F.arrow_udf("struct<" + ",".join(f"{n}:bigint" for n in names) + ">")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            got = repetition(batch.to_pylist(), wanted)
            yield pa.StructArray.from_arrays([pa.array(got[n], pa.int64()) for n in names], fields=list(kind))

    return docs.withColumn(out, udf(col(text)))


def judge(
    docs: DataFrame, measures: str, cover_percent: dict[int, int] = COVER_PERCENT, line_percent: int = LINE_PERCENT,
    min_words: int = MIN_WORDS, base_percent: int = BASE_REPEAT_PERCENT,
) -> tuple[F.Column, F.Column]:
    """(base_failed, kept) as expressions over the struct column ``measures``."""
    m = lambda name: col(measures)[name]
    failed = (m("n_words") < min_words) | (100 * m("n_repeat_words") > base_percent * m("n_words"))
    kept = ~failed & (100 * m("dup_line_chars") <= line_percent * m("n_chars"))
    for n, percent in cover_percent.items():
        kept = kept & (100 * m(f"cover_{n}") <= percent * m("word_chars"))
    return failed, kept


def filter_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that every rule keeps, columns unchanged."""
    name = fresh(docs, "quality")
    measured = measure(docs, name, text)
    return measured.filter(judge(measured, name)[1]).drop(name)


def quality_rows(docs: DataFrame) -> DataFrame:
    """The digest of the contract, one row per document."""
    name = fresh(docs, "quality")
    measured = measure(docs.select("doc_id", "text"), name)
    failed, kept = judge(measured, name)
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["dup_line_chars", *(f"cover_{n}" for n in COVER_PERCENT)]
    return measured.select(
        "doc_id", *(col(name)[f].alias(f) for f in fields), failed.alias("base_failed"), kept.alias("kept"),
        *(col(name)[f].alias(f) for f in more),
    )
