"""Phrase collocation mining (operator 12) with weighted acyclic automata.

Texts are cut into pieces at sentence marks and line ends, pieces into words;
phrases lie within a piece.  Everything is counted per language.

1. *Shards.*  A task numbers the words of about ``SHARD`` words of one language
   in sorted order, sorts their n-grams of one to three words, and cuts them at the
   splitters of the ranges (quantiles of a sample of the n-grams).  Each part is built,
   from its sorted n-grams, into a minimal acyclic count automaton
   (``automata``).  Only automata are shuffled; a frequent n-gram is one entry of
   its shard, and a frequent first word is cut by the words after it.
2. *Union.*  A range joins the automata of all shards, a bounded number at a
   time, and adds the weights.  Entries below ``MIN_COUNT`` go: a part of a
   frequent phrase is as frequent.
3. *Composition.*  The parts of a range's candidates are an automaton too, the
   request, cut by the same splitters.  A range composes each request with its
   counts (the paths that both accept) and answers with an automaton.  A request
   names a part once, however many candidates have it.  Its weights carry
   the most frequent phrase that contains the part, so a range also learns which of its
   candidates a longer one covers.
4. Candidates are scored by their answers with whole numbers of any size,
   and ranked per language.

Defined results: a null or empty text has no words; a null language is ``und``;
doc_ids are not read, so null ones and repeated rows count like any other; ties are
broken by count, then phrase; an empty table gives an empty result; extra
columns are not read; a long text is read in parts that end at a piece end,
and a piece of any length in parts that overlap by two words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.automata import Automaton, Columns, Ranges, counted, merged, renumber, union
from stockroom.llm.common import col, materialize, shuffle_partitions

MAX_WORDS = 3
MIN_COUNT = 10
COVER_PERCENT = 50
SCALE = 1_000_000
TOP = 2_000
TOP_PARTS = 32
NO_LANGUAGE = "und"
# Bytes of text whose n-grams make one range, and the sample that splits them.
RANGE_BYTES = 16_000_000
SAMPLE_DOCUMENTS = 2_000
SAMPLE_EVERY = 32
SHARD = 1 << 21  # words counted together
_PIECE = 1 << 22  # bytes of a text read at once
_PARTS = 32  # automata joined at once
# the marks that end a piece (a fixed set) become a byte that no UTF-8 text has
_MARK = b"\xff"
_ENDS = bytes(0xFF if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256))


def token_lists(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, ``_MARK`` between pieces, in lists that end at a piece end."""
    data = text.encode().lower().translate(_ENDS)  # bytes.lower: A-Z only
    at = 0
    while at < len(data):
        end = data.find(_MARK, at + _PIECE)
        part = data[at : end if end >= 0 else len(data)]
        at += len(part) + 1
        yield part.replace(_MARK, b" \xff ").split()  # the blanks left are the space and the tab


class Shard:
    """Words of one language and the n-grams that start in them."""

    def __init__(self) -> None:
        self.vocab: dict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[np.ndarray] = []
        self.starts: list[int] = []
        self.words = 0

    def add(self, tokens: list[bytes], starts: int) -> None:
        """``tokens`` whose first ``starts`` may start an n-gram; what follows is not connected."""
        self.ids.append(np.fromiter(map(self.vocab.__getitem__, tokens), np.int64, len(tokens)))
        self.starts.append(starts)
        self.words += len(tokens)

    def grams(self) -> tuple[list[bytes], Columns, np.ndarray]:
        """Sorted words, sorted distinct n-grams and their counts."""
        words = sorted(w for w in self.vocab if w != _MARK)
        number = np.zeros(len(self.vocab), np.int64)  # marks stay 0
        number[[self.vocab[w] for w in words]] = np.arange(1, len(words) + 1)
        gap = np.zeros(MAX_WORDS, np.int64)
        ids = np.concatenate([x for some in self.ids for x in (number[some], gap)])
        may = np.concatenate([np.arange(len(some) + MAX_WORDS) < n for some, n in zip(self.ids, self.starts, strict=True)])
        at = np.flatnonzero(may & (ids > 0))
        a, b, c = ids[at], ids[at + 1], ids[at + 2]
        c = np.where(b > 0, c, 0)
        none = np.zeros(len(a), np.int64)
        two, three = b > 0, c > 0
        columns = tuple(
            np.concatenate(x) for x in ((a, a[two], a[three]), (none, b[two], b[three]), (none, none[two], c[three]))
        )
        return words, *counted(columns, len(words))


def _rows(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])


# rows that travel between ranges; kind orders the rows of a range's language
_SENT = [("range", pa.int32()), ("lang", pa.string()), ("kind", pa.int32()), ("origin", pa.int32()), ("automaton", pa.binary())]
_SENT_SQL = "range int, lang string, kind int, origin int, automaton binary"
_COUNTS, _REQUEST, _ANSWER, _COVERED = range(4)


def _shards(batches: Iterator[pa.RecordBatch], ranges: Ranges, size: int) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> count automata by range."""
    shards: dict[str, Shard] = defaultdict(Shard)
    held = 0

    def send() -> Iterator[pa.RecordBatch]:
        for lang, shard in shards.items():
            words, grams, counts = shard.grams()
            parts = [(r, lang, _COUNTS, 0, a.to_bytes()) for r, a in ranges.pieces(lang, words, grams, counts)]
            yield _rows(parts, _SENT)

    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for tokens in token_lists(text):
                for i in range(0, len(tokens), size):
                    part = tokens[i : i + size + MAX_WORDS - 1]
                    shards[lang].add(part, min(size, len(tokens) - i))
                    held += len(part)
                    if held >= size:
                        yield from send()
                        shards.clear()
                        held = 0
    yield from send()


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, str], Iterator[tuple[int, int, bytes]]]]:
    """((range, lang), its (kind, origin, automaton) in order) of sorted rows."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for key, some in groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2:] for r in some)


def _union(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Count automata by range -> one a range and language, and the number of its words."""
    kinds = [*_SENT, ("n_words", pa.int64())]
    for (number, lang), rows in _by_language(batches):
        held: list[Automaton] = []
        for _, _, data in rows:
            held.append(Automaton.from_bytes(data))
            if len(held) > _PARTS:
                held = [Automaton.build(*union(held))]
        words, grams, counts = union(held)
        n_words = int(counts[grams[1] == 0].sum())
        kept = counts >= least
        some = Automaton.build(words, tuple(g[kept] for g in grams), counts[kept])
        yield _rows([(number, lang, _COUNTS, number, some.to_bytes(), n_words)], kinds)


def _inner(grams: Columns) -> list[tuple[Columns, np.ndarray]]:
    """The parts of candidates on either side of a cut: (part, row of its candidate)."""
    a, b, c = grams
    none = np.zeros(len(a), np.int64)
    two, three = np.flatnonzero((b > 0) & (c == 0)), np.flatnonzero(c > 0)
    any_ = np.flatnonzero(b > 0)
    return [
        ((a[any_], none[any_], none[any_]), any_),  # first word
        ((b[two], none[two], none[two]), two),  # second of two
        ((c[three], none[three], none[three]), three),  # third of three
        ((a[three], b[three], none[three]), three),
        ((b[three], c[three], none[three]), three),
    ]


def _requests(batches: Iterator[pa.RecordBatch], ranges: Ranges) -> Iterator[pa.RecordBatch]:
    """Counts of a range -> its candidates' parts, by the range that counts them.

    The weight of a part is one more than the count of the most frequent longer
    candidate that contains it, if the part is a phrase itself."""
    for (number, lang), rows in _by_language(batches):
        out = []
        for _, _, data in rows:
            words, grams, counts = union([Automaton.from_bytes(data)])
            parts = _inner(grams)
            columns = tuple(np.concatenate([p[k] for p, _ in parts]) for k in range(MAX_WORDS))
            over = np.concatenate([np.where(p[1] > 0, counts[row], 0) for p, row in parts])
            asked, most = merged(columns, over + 1, len(words), np.maximum)
            out += [(r, lang, _REQUEST, number, a.to_bytes()) for r, a in ranges.pieces(lang, words, asked, most)]
        yield _rows(out, _SENT)


def _compose(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Counts and requests of a range -> answers to their origins, and its covered phrases to itself."""
    for (number, lang), rows in _by_language(batches):
        words, index, grams, counts, covering = [], {}, None, None, None
        for kind, origin, data in rows:
            if kind == _COUNTS:
                words, grams, counts = union([Automaton.from_bytes(data)])
                index = {w: i for i, w in enumerate(words, 1)}
                covering = np.zeros(len(counts), np.int64)
                continue
            asked = Automaton.from_bytes(data)
            parts, weights = asked.grams()
            at = _find(grams, renumber(asked.words, index, parts), len(words))
            np.maximum.at(covering, at, weights - 1)
            answer = Automaton.build(words, *_sorted(grams, counts, at))
            yield _rows([(origin, lang, _ANSWER, number, answer.to_bytes())], _SENT)
        gone = np.flatnonzero((covering > 0) & (100 * covering >= percent * counts))
        covered = Automaton.build(words, *_sorted(grams, counts, gone))
        yield _rows([(number, lang, _COVERED, number, covered.to_bytes())], _SENT)


def _sorted(grams: Columns, counts: np.ndarray, rows: np.ndarray) -> tuple[Columns, np.ndarray]:
    rows = np.sort(rows)
    return tuple(g[rows] for g in grams), counts[rows]


def _find(grams: Columns, wanted: Columns, words: int) -> np.ndarray:
    """Row numbers, in sorted n-grams, of distinct n-grams that are all there."""
    asked = np.concatenate([np.zeros(len(grams[0]), np.int64), np.ones(len(wanted[0]), np.int64)])
    if any((w < 0).any() for w in wanted):
        raise ValueError("a part of a counted phrase is not counted")
    found, mark = merged(tuple(np.concatenate(x) for x in zip(grams, wanted, strict=True)), asked, words, np.maximum)
    if len(found[0]) != len(grams[0]) or mark.sum() != asked.sum():
        raise ValueError("a part of a counted phrase is not counted")
    at = np.empty(len(wanted[0]), np.int64)
    at[np.lexsort(wanted[::-1])] = np.flatnonzero(mark)
    return at


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, answers and covered phrases of a range -> (lang, phrase, a, l, r, score)."""
    kinds = [("lang", pa.string()), ("phrase", pa.string()), *((n, pa.int64()) for n in ("a", "l", "r", "score"))]
    for (_, lang), rows in _by_language(batches):
        own, answers, covered = None, [], []
        for kind, _, data in rows:
            found = Automaton.from_bytes(data)
            if kind == _COUNTS:
                own = found
            elif kind == _ANSWER:
                answers.append(found)
            else:
                covered.append(found)
        of = _table(answers)
        gone = _table(covered)
        out = []
        for gram, a in _table([own]).items():
            if len(gram) > 1 and gram not in gone:
                cuts = [(SCALE * a * a // (of[gram[:k]] * of[gram[k:]]), k) for k in range(1, len(gram))]
                score, k = min(cuts)
                out.append((lang, b" ".join(gram).decode(), a, of[gram[:k]], of[gram[k:]], score))
        yield _rows(out, kinds)


def _table(parts: list[Automaton]) -> dict[tuple[bytes, ...], int]:
    out = {}
    for p in parts:
        grams, weights = p.grams()
        for *gram, w in zip(*(g.tolist() for g in grams), weights.tolist(), strict=True):
            out[tuple(p.words[i - 1] for i in gram if i)] = w
    return out


def split_ranges(docs: DataFrame, range_bytes: int) -> Ranges:
    """Splitters from a bounded sample of documents (lang, text) and of their distinct n-grams."""
    sums = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    number = -(-(sums[1] or 0) // range_bytes)
    if number < 2:
        return Ranges([])
    of = max(sums[0] // SAMPLE_DOCUMENTS, 1)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for tokens in token_lists(text):
                    for i in range(len(tokens)):
                        for k in range(1, MAX_WORDS + 1):
                            gram = tokens[i : i + k]
                            if len(gram) < k or _MARK in gram:
                                break
                            # by a hash of the n-gram: a frequent one counts once, as in the ranges
                            if xxhash.xxh3_64_intdigest(b" ".join(gram)) % SAMPLE_EVERY == 0:
                                out.append((lang, b" ".join(gram)))
            yield _rows(out, [("lang", pa.string()), ("gram", pa.binary())])

    chosen = docs.filter(F.pmod(F.xxhash64("text"), F.lit(of)) == 0)
    found = chosen.mapInArrow(sample, "lang string, gram binary").distinct().collect()  # bounded by the constants above
    grams = sorted((r["lang"], tuple(bytes(r["gram"]).split(b" "))) for r in found)
    return Ranges(sorted({grams[len(grams) * i // number] for i in range(1, number)}) if grams else [])


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, percent: int = COVER_PERCENT,
    range_bytes: int = RANGE_BYTES, shard: int = SHARD,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a, l, r, score) of all phrases that are kept, and (lang, n) with each language's words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(col(lang), F.lit(NO_LANGUAGE)).alias("lang"), col(text).alias("text")).filter("text <> ''")
    ranges = split_ranges(texts, range_bytes)
    tasks = min(len(ranges.grams) + 1, max(4 * shuffle_partitions(spark), 1))
    task = F.expr(f"cast(range * {tasks}L div {len(ranges.grams) + 1} as int)")

    def dealt(rows: DataFrame) -> DataFrame:
        """Ranges, or runs of neighbouring ranges, to tasks; a task sees one range and language at a time."""
        columns = [n for n, _ in _SENT]
        return rows.select(*columns).repartitionById(tasks, task).sortWithinPartitions(*columns[:4])

    parts = texts.mapInArrow(lambda b: _shards(b, ranges, shard), _SENT_SQL)
    counts = materialize(
        dealt(parts).mapInArrow(lambda b: _union(b, min_count), _SENT_SQL + ", n_words bigint"), "phrase-counts"
    )
    sent = counts.select(*(n for n, _ in _SENT))
    requests = sent.mapInArrow(lambda b: _requests(b, ranges), _SENT_SQL)
    answers = materialize(
        dealt(sent.unionAll(requests)).mapInArrow(lambda b: _compose(b, percent), _SENT_SQL), "phrase-answers"
    )
    scored = dealt(sent.unionAll(answers)).mapInArrow(
        _score, "lang string, phrase string, a bigint, l bigint, r bigint, score bigint"
    )
    return scored, counts.groupBy("lang").agg(F.sum("n_words").alias("n"))


def phrase_rows(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """The digest of the contract: the first ``top`` phrases of each language."""
    scored, totals = collocations(docs.select("lang", "text"), **options)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # first in parts of a language, so that its last task takes no more than their first phrases
    part = Window.partitionBy("lang", "part").orderBy(*order)
    some = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)))
    some = some.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= top).drop("part", "place")
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = some.withColumn("rank", F.row_number().over(whole).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
