"""Operator 11: near-duplicate texts, against all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest

from stockroom.llm import sketches


def brute_near(docs, percent=85):
    """Per row (doc_id, set size, component_id, kept)."""
    words = [(t or "").encode().lower().split() for _, t in docs]
    sets = [frozenset(tuple(w[i : i + 3]) for i in range(max(len(w) - 2, 1))) if w else frozenset() for w in words]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(set)
    for i, s in enumerate(sets):
        near = set().union(*(holders[g] for g in s)) if s else ()
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
        for g in s:
            holders[g].add(i)
    members = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        members[find(i)].append(d)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in members.items()}
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(docs)]


def _rows(df, **options):
    return brute_sorted(map(tuple, sketches.classes(df, **options).select("doc_id", "n_shingles", "component_id", "kept").collect()))


def brute_sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def _near_copies(seed, n=260):
    """Texts of a few templates, each with some words replaced, so that links chain and break."""
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(3000)}" for _ in range(k)] for k in (4, 30, 60, 200)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(12)}"
        rows.append((i, " ".join(w).upper() if rng.random() < 0.1 else "\n".join(w)))
    rows += [(1000 + i, " ".join(f"u{rng.randrange(9999)}" for _ in range(50))) for i in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"members": 6, "leaders": 60}, {"shingles": 300, "leaders": 50}])
def test_components_against_all_pairs(spark, limits):
    rows = _near_copies(4)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert _rows(df, **limits) == brute_sorted(brute_near(rows))


def test_near_duplicates_of_edge_cases(edge, edge_rows, empty, small_docs, small_rows):
    assert _rows(edge) == brute_sorted(brute_near(edge_rows))
    assert _rows(empty) == []
    assert _rows(small_docs) == brute_sorted(brute_near(small_rows))


def test_very_long_texts_and_a_third_of_one_template(spark):
    rng = random.Random(8)
    long = [f"w{rng.randrange(500)}" for _ in range(150_000)]
    template = [f"t{i}" for i in range(70)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-3000])), (3, " ".join(long[: len(long) // 2]))]
    for i in range(150):
        w = list(template)
        w[rng.randrange(70)] = f"n{i}"
        rows.append((10 + i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(20))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert _rows(df, members=40, leaders=16) == brute_sorted(brute_near(rows))


def test_sketches_estimate_the_similarity():
    rng = np.random.default_rng(1)
    t = 352
    for n in (1, 5, 40, 3000):
        base = rng.integers(0, 1 << 64, n + n // 4, np.uint64)
        a, b = np.unique(base[:n]), np.unique(base[n // 4 :])
        got = sketches.sketch([a, b, a], t)
        assert (got != sketches._EMPTY).all() and (got[0] == got[2]).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((got[0] == got[1]).mean() - true) < 5 * (true * (1 - true) / t) ** 0.5 + 0.02
    # the sketch of a set does not depend on the sets it is computed with
    assert (sketches.sketch([a], t)[0] == got[0]).all()


def test_bands_reach_the_recall():
    n = sketches.bands_for()
    assert (1 - 0.85**sketches.BAND_ROWS) ** n <= sketches.MISSED < (1 - 0.85**sketches.BAND_ROWS) ** (n - 1)
    rng = np.random.default_rng(2)
    found = 0
    for _ in range(300):
        base = rng.integers(0, 1 << 64, 1080, np.uint64)
        keys = sketches.band_keys(sketches.sketch([np.unique(base[:1000]), np.unique(base[80:])], n * sketches.BAND_ROWS))
        found += bool((keys[0] == keys[1]).any())  # similarity 920 / 1080 = 0.852
    assert found == 300
