"""Secret scan (operator 1).

Three fixed patterns find the base spans.  Besides, two character Markov models
(order one over a small alphabet) are trained from labelled samples: random
strings and ordinary identifiers.  A long token whose log-likelihood ratio
favours the random model becomes a span of kind ``markov``; of a token that base
spans touch, the parts outside them do (see ``_random_parts``).

Labelled samples: random are the values of the base spans of the whole table
and ``RANDOM_STRINGS`` strings drawn with a fixed seed from four alphabets;
ordinary are all tokens of ``MIN_IDENTIFIER``+ characters of the whole table
that are words, joined by ``_`` or ``-`` and perhaps numbered, outside base
spans, and as many identifiers composed of ``WORDS`` in the usual spellings.  Only character-pair counts (at most 2 x 68 x 68 numbers)
reach the driver.

Defined results: a null text counts as empty and has no span; an empty table
gives an empty result (the model then rests on the drawn strings and
smoothing); repeated rows are scanned each; extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.llm.common import col

# The patterns, least lengths and order of kinds of the contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that have 24 or more
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "markov")

KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
START = len(ALPHABET)
STATES = START + 1
MIN_IDENTIFIER = 8
MIN_TOKEN = 20
RANDOM_STRINGS = 4000
RANDOM_LENGTH = 32
WORDS = (
    "account active address amount array author buffer build byte cache category channel check client code column "
    "command config content context count country create currency current customer data date default delete detail "
    "device document domain element email error event export field file filter first format function group handler "
    "header height history image import index input instance item key label language last length level limit line "
    "link list local location manager map message method model module name network node number object option order "
    "output page parent password path payment price process product profile project property query queue range record "
    "reference region release request resource response result return role root rule schema screen search section "
    "select server service session setting shape size source start state status step store string style system table "
    "target template text time title token total type update upload user value vendor version view width window"
).split()
# A token is reported when the ratio reaches both bounds (natural logarithms).
MIN_RATIO = 12.0
MIN_RATIO_PER_CHARACTER = 0.4

_IDENTIFIER = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_IDENTIFIER},}}")
_WORDS = re.compile("[A-Za-z]+(?:[_-][A-Za-z]+)*[0-9]{0,4}")
_NAME = re.compile("[A-Za-z]+[0-9]{0,4}")
_TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}")
_CODE = np.full(256, START, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of the pattern matches, in order."""
    found = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _pairs(tokens: list[str]) -> np.ndarray:
    """Indices of the character pairs of the tokens, from a start state each."""
    codes = _CODE[np.frombuffer(("\n" + "\n".join(tokens)).encode(), np.uint8)]
    left, right = codes[:-1], codes[1:]
    real = right != START
    return left[real] * STATES + right[real]


def _values(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """The secret part of each base span: what follows the sign of an assignment."""
    out = []
    for s, kind, e in spans:
        value = ASSIGN.match(text, s)[2] if kind == 0 else text[s:e]
        out.append(re.sub("[^A-Za-z0-9+/_=-]", "", value))
    return out


def _outside(text: str, spans: list[tuple[int, int, int]], pattern: re.Pattern) -> list[tuple[int, int]]:
    """Matches of ``pattern`` that no span touches; both come in order and are passed once."""
    out, at, reached = [], 0, 0
    for m in pattern.finditer(text):
        start, end = m.span()
        while at < len(spans) and spans[at][0] < end:
            reached = max(reached, spans[at][2])
            at += 1
        if reached <= start:
            out.append((start, end))
    return out


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratio of each character pair: random over ordinary."""

    ratio: np.ndarray

    def score(self, token: str) -> float:
        return float(self.ratio[_pairs([token])].sum())

    def is_random(self, token: str) -> bool:
        return self.score(token) >= max(MIN_RATIO, MIN_RATIO_PER_CHARACTER * len(token))


def drawn_strings(n: int = RANDOM_STRINGS, length: int = RANDOM_LENGTH, seed: int = 7) -> list[str]:
    """Labelled random strings: hexadecimal, base 32, base 62 and base 64 by turns."""
    rng = np.random.default_rng(seed)
    sets = [ALPHABET[52:62] + "abcdef", ALPHABET[:26] + "234567", ALPHABET[:62], ALPHABET[:64]]
    return ["".join(rng.choice(list(sets[i % 4]), length)) for i in range(n)]


def composed_identifiers(n: int = RANDOM_STRINGS, seed: int = 8) -> list[str]:
    """Labelled ordinary identifiers: snake, kebab, camel, Pascal and upper case by turns."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        parts = rng.choice(WORDS, rng.integers(2, 5)).tolist()
        title = [p.capitalize() for p in parts]
        spellings = ["_".join(parts), "-".join(parts), parts[0] + "".join(title[1:]), "".join(title), "_".join(parts).upper()]
        out.append(spellings[i % 5])
    return out


def fit(random: np.ndarray, ordinary: np.ndarray) -> MarkovModel:
    """From pair counts of the two classes; add-one smoothing per state."""

    def log_probability(counts: np.ndarray) -> np.ndarray:
        table = counts.reshape(STATES, STATES)[:, :START].astype(float) + 1.0
        out = np.zeros((STATES, STATES))
        out[:, :START] = np.log(table / table.sum(axis=1, keepdims=True))
        return out

    return MarkovModel((log_probability(random) - log_probability(ordinary)).ravel())


def train(docs: DataFrame, text: str = "text") -> MarkovModel:
    """Train both models on the labelled tokens of every text of ``docs``."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, STATES * STATES), np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if not t:
                    continue
                spans = base_spans(t)
                words = [t[s:e] for s, e in _outside(t, spans, _IDENTIFIER) if _WORDS.fullmatch(t, s, e)]
                for label, tokens in ((0, words), (1, _values(t, spans) if spans else ())):
                    if tokens:
                        tables[label] += np.bincount(_pairs(tokens), minlength=STATES * STATES)
        label, pair = np.nonzero(tables)
        yield pa.RecordBatch.from_arrays(
            [pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(tables[label, pair], pa.int64())],
            names=["label", "pair", "n"],
        )

    rows = docs.select(col(text)).mapInArrow(counts, "label int, pair int, n bigint")
    tables = np.zeros((2, STATES * STATES), np.int64)
    # at most 2 x STATES x STATES rows, whatever the size of the table
    for r in rows.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect():
        tables[r["label"], r["pair"]] = r["n"]
    for label, sample in ((0, composed_identifiers()), (1, drawn_strings())):
        tables[label] += np.bincount(_pairs(sample), minlength=STATES * STATES)
    return fit(tables[1], tables[0])


def _names(part: str) -> bool:
    return all(_NAME.fullmatch(x) for x in re.split("[+/_=-]+", part) if x)


def _random_parts(text: str, base: list[tuple[int, int, int]], model: MarkovModel) -> Iterator[tuple[int, int]]:
    """Random tokens, and the random parts outside base spans of those that such spans touch.

    A part is judged as a token of its own.  If the whole token is random and no
    assignment names it, the pattern broke off inside a secret: then a part of any
    length goes, unless it is made of names and does not favour the random model
    as much per character.
    """
    at, touching = 0, []
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        touching = [x for x in touching if x[2] > start]  # spans overlap a few at a time
        while at < len(base) and base[at][0] < end:
            if base[at][2] > start:
                touching.append(base[at])
            at += 1
        if not touching:
            if model.is_random(m[0]):
                yield start, end
            continue
        broken = all(kind != 0 for _, kind, _ in touching) and model.is_random(m[0])
        for s, _, e in [*touching, (end, 3, end)]:
            part = text[start:s]
            if (len(part) >= MIN_TOKEN and model.is_random(part)) or (
                part and broken and (not _names(part) or model.score(part) >= MIN_RATIO_PER_CHARACTER * len(part))
            ):
                yield start, s
            start = max(start, e)


def spans_of(text: str, model: MarkovModel) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    more = [(s, 3, e) for s, e in _random_parts(text, base, model)]
    return sorted(base + more) if more else base


def scan(docs: DataFrame, model: MarkovModel, out: str, text: str = "text") -> DataFrame:
    """``docs`` with the array column ``out`` of (kind, start, end): code points, end exclusive."""

    @F.arrow_udf(SPANS)
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [spans_of(t, model) if t else [] for t in batch.to_pylist()]
            yield pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in found], _SPANS)

    return docs.withColumn(out, udf(col(text)))


def mask_spans(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """``text`` with the union of the spans (start, kind, end), in order, replaced by ``mask``."""
    parts, at = [], 0
    for start, _, end in spans:
        if not parts or start > at:  # touching spans are one
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, model: MarkovModel, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every secret of ``text`` masked, found and replaced in one pass."""

    @F.arrow_udf("string")
    def udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([mask_spans(t, spans_of(t, model), mask) if t else t for t in batch.to_pylist()], pa.string())

    return docs.withColumn(text, udf(col(text)))


def redact_documents(docs: DataFrame, text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with the secrets of ``text`` masked by a model trained on it; rows and columns stay."""
    return redact(docs, train(docs, text), text, mask)


def secret_rows(docs: DataFrame) -> DataFrame:
    """The digest of the contract, one row per document."""
    docs = docs.select("doc_id", "text")
    found = scan(docs, train(docs), "found").select("doc_id", "found")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] != KINDS[3])
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"), number("markov"),
    )
