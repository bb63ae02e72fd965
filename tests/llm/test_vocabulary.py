"""Operators 12 and 13: phrases and spelling variants, against plain versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stockroom.llm import phrases, variants
from stockroom.llm.automata import Automaton, Ranges, merged, union


# ---- 13
def brute_variants(docs, min_length=6, min_count=5, every=199):
    counts = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}

    def near(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))

    found = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in found.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(found[w]), None if form[w] is None else words[form[w]]))
    return out


def _variants(df, **options):
    got = variants.group_variants(df, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = set(map(tuple, got))
    assert len(out) == len(got)
    return out


def _misspelt(rng, word):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice("abcé") + word[i:], word[:i] + rng.choice("abcé") + word[i + 1 :]])


def _spelling_rows(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcde") for _ in range(rng.randrange(6, 10))) for _ in range(25)] + ["tête-à-tête Garçon ÀÉî×÷"]
    rows = []
    for d in range(200):
        words = []
        for _ in range(60):
            w = rng.choice(base[: rng.choice([3, 26])])
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                w = _misspelt(rng, w)
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((d, rng.choice([" ", ", ", "1", "漢"]).join(words)))
    return rows


@pytest.mark.parametrize("tile", [2048, 7])
def test_variants_against_all_pairs(spark, tile):
    rows = _spelling_rows(5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = _variants(df, tile=tile)
    assert got == brute_variants(rows)
    assert sum(r[1] is not None for r in got) > 20 and any(r[1] not in (None, r[2]) for r in got)


def test_variants_of_edge_cases(edge, edge_rows, empty, small_docs, small_rows):
    assert _variants(edge, min_count=1) == brute_variants(edge_rows, min_count=1)
    assert _variants(empty) == set()
    assert _variants(small_docs) == brute_variants(small_rows)


def test_words_of_a_long_text_are_not_cut(monkeypatch):
    monkeypatch.setattr(variants, "_PIECE", 5)
    text = "Grüße, ewiglange\nWörter und kurze é"
    assert [w for ws in variants.words_of(text, 1, 1 << 40) for w in ws] == [
        w.encode() for w in "grüße ewiglange wörter und kurze é".split()
    ]


def test_chains_of_forms_end_at_the_last(spark):
    df = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w5")], "word string, form string")
    assert {tuple(r) for r in variants.last_forms(df).collect()} == {(f"w{i}", "w13") for i in range(13)} | {("x", "w13")}


# ---- 12
def brute_phrases(docs, top=2000, least=10):
    """Rows of the contract for (lang, text) pairs."""
    grams = {}
    for lang, text in docs:
        f = grams.setdefault("und" if lang is None else lang, Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, f in grams.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows = []
        for g, a in found.items():
            longer = [found[x] for x in found if len(x) == 3 > len(g) and g in (x[:2], x[1:])]
            if any(100 * x >= 50 * a for x in longer):
                continue
            score, k = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        n = sum(a for g, a in f.items() if len(g) == 1)
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def _phrases(df, **options):
    got = phrases.phrase_rows(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    return sorted(map(tuple, got))


def _phrase_docs(seed):
    rng = random.Random(seed)
    words = ["the", "new", "york", "city", "of", "a", "É", "zz", "漢字", "it's", "\x00", "A", "Of"]
    rows = []
    for _ in range(300):
        w = [rng.choice(words[: rng.choice([3, 6, 13])]) for _ in range(rng.randrange(40))]
        text = "".join(x + rng.choice([" ", "  ", "\t", " ", ". ", "\n", ", ", "\x85 "]) for x in w)
        rows.append((rng.choice(["en", "de", None, "und", ""]), text))
    return rows + [(None, None), ("fr", ""), ("fr", " . ")]


@pytest.mark.parametrize("options", [{}, {"range_bytes": 500, "shard": 64}, {"range_bytes": 3000, "top": 5}])
def test_phrases_against_a_plain_count(spark, options, monkeypatch):
    monkeypatch.setattr(phrases, "SAMPLE_EVERY", 2)
    rows = _phrase_docs(3)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = _phrases(df, **options)
    assert got == brute_phrases(rows, options.get("top", 2000)) and len(got) >= 20


def test_phrases_of_edge_cases(edge, edge_rows, empty, small_docs):
    assert _phrases(edge) == brute_phrases([("en", t) for _, t in edge_rows])
    assert _phrases(empty) == []
    rows = [(r["lang"], r["text"]) for r in small_docs.collect()]
    assert _phrases(small_docs, range_bytes=50_000) == brute_phrases(rows)


def test_a_long_piece_is_counted_in_overlapping_parts(spark):
    text = "a b c " * 5000
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    assert _phrases(df, shard=17) == brute_phrases([("en", text)])


def _grams(rng, n, words):
    rows = [[rng.randrange(1, words + 1) for _ in range(k)] + [0] * (3 - k) for k in rng.choices((1, 2, 3), k=n)]
    return merged(tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)), np.ones(n, np.int64), words)


def test_automata_keep_every_count_and_share_states():
    rng = random.Random(1)
    words = sorted({f"w{rng.randrange(400)}".encode() for _ in range(60)})
    grams, counts = _grams(rng, 3000, len(words))
    first = Automaton.build(words, grams, counts)
    again, got, weights = union([Automaton.from_bytes(first.to_bytes())])
    assert again == first.words == words and (weights == counts).all()
    assert all((x == y).all() for x, y in zip(got, grams, strict=True))
    # equal continuations are stored once
    tail = [(a, 1, c) for a in range(2, 40) for c in (3, 4)]
    columns = tuple(np.array(c, np.int64) for c in zip(*tail, strict=True))
    shared = Automaton.build(words, columns, np.full(len(tail), 7))
    assert len(shared.first[0]) == 1 and len(shared.second[0]) == 2 and len(shared.grams()[1]) == len(tail)


def test_union_adds_and_ranges_cut(monkeypatch):
    rng = random.Random(2)
    words = [b"a", b"b", b"cc", b"d", b"zz"]
    parts = [Automaton.build(words, *_grams(rng, 90, 5)) for _ in range(4)]
    total = Counter()
    for p in parts:
        for *g, w in zip(*(x.tolist() for x in p.grams()[0]), p.grams()[1].tolist(), strict=True):
            total[tuple(p.words[i - 1] for i in g if i)] += w
    joined, grams, counts = union(parts)
    spelt = [tuple(joined[i - 1] for i in g if i) for g in zip(*(x.tolist() for x in grams), strict=True)]
    assert spelt == sorted(total) and counts.tolist() == [total[g] for g in spelt]
    splitters = [(b"a", b"b"), (b"b", b"bb"), (b"cc",), (b"e", b"x"), (b"zz", b"zz", b"zz")]
    ranges = Ranges([("de", (b"q",)), *(("en", s) for s in splitters), ("fr", (b"a",))])
    seen = {}
    for number, piece in ranges.pieces("en", joined, grams, counts):
        for *g, w in zip(*(x.tolist() for x in piece.grams()[0]), piece.grams()[1].tolist(), strict=True):
            gram = tuple(piece.words[i - 1] for i in g if i)
            assert number == 1 + sum(s <= gram for s in splitters)
            seen[gram] = w
    assert seen == total
    # more words than fit into one key: the columns are sorted as they are
    big = tuple(np.array(c, np.int64) for c in ([5, 1, 5, 1], [0, 2, 0, 2], [0, 0, 0, 3]))
    got, sums = merged(big, np.array([1, 2, 4, 8]), 1 << 40)
    assert [c.tolist() for c in got] == [[1, 1, 5], [2, 2, 0], [0, 3, 0]] and sums.tolist() == [2, 8, 5]
