"""Operators 2, 5, 8 and 9: duplicates, against plain versions."""

import random
import time
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest

from stockroom.llm import lines, paragraphs, passages, simhash, suffixes
from stockroom.llm.components import components
from stockroom.session import ensure_checkpoint_dir


def _key(r):
    return tuple((x is not None, str(x)) for x in r)


def _sorted(rows):
    return sorted(map(tuple, rows), key=_key)


def _words(rng, n):
    return [rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randrange(300)) for _ in range(n)]


# ---- 2
def _classes(df, **options):
    got = paragraphs.classes(df, kinds=("line",), **options).collect()
    return {(r["doc_id"], r["paragraph"]): (r["class_doc"], r["class_paragraph"]) for r in got}, got


def test_paragraph_classes(edge, edge_rows, small_docs, small_rows):
    for df, rows in ((edge, edge_rows), (small_docs, small_rows)):
        found, got = _classes(df)
        assert found == brute.paragraph_classes(rows)
        text = {d: t for d, t in rows}
        for r in got:
            line = text[r["doc_id"]][r["start"] : r["end"]]
            assert len(line.split()) == r["n_words"] and "\n" not in line
            assert r["removed"] == ((r["doc_id"], r["paragraph"]) != (r["class_doc"], r["class_paragraph"]))


@pytest.mark.parametrize("bucket", [2000, 3])
def test_near_paragraphs_in_large_and_small_buckets(spark, bucket):
    rng = random.Random(3)
    base = _words(rng, 60)
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = f"new{rng.randrange(5)}"
        rows.append((i, "kurz\n" + " ".join(w)))
    rows += [(100 + i, " ".join(_words(rng, 40))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert _classes(df, bucket=bucket)[0] == brute.paragraph_classes(rows)


def test_repeated_passages_over_and_inside_lines(spark, edge):
    rng = random.Random(9)
    passage = [_words(rng, n) for n in (50, 51, 63, 90, 49)]
    rows, holders = [], defaultdict(set)
    for i in range(120):
        w = _words(rng, rng.randrange(10, 150))
        for _ in range(rng.choice([0, 1, 1, 2])):
            p = rng.randrange(5)
            w += passage[p] + _words(rng, rng.randrange(30))
            holders[p].add(i)
        sep = rng.choice([" ", "\n", "  \t"])
        rows.append((i, "".join(x + (sep if rng.random() < 0.3 else " ") for x in w)))
    rows += [(500 + i, "q" + "\n".join(" ".join(_words(rng, 19)) for _ in range(20))) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = paragraphs.classes(df).filter("kind = 'passage'").collect()
    text = dict(rows)
    plain = {d: " " + " ".join(t.lower().split()) + " " for d, t in rows}
    found = {r["doc_id"] for r in got}
    assert set().union(*(holders[p] for p in range(4))) <= found and not any(d >= 500 for d in found)
    for r in got:  # each occurs elsewhere, and the class's first is an equal one
        words = text[r["doc_id"]][r["start"] : r["end"]].lower().split()
        assert len(words) == r["n_words"] == paragraphs.PASSAGE_WORDS
        unit = " " + " ".join(words) + " "
        assert sum(t.count(unit) for t in plain.values()) > 1
        assert text[r["class_doc"]][r["class_start"] :].lower().split()[: len(words)] == words
        assert r["removed"] == ((r["doc_id"], r["start"]) != (r["class_doc"], r["class_start"]))
        assert text[r["doc_id"]][: r["start"]].count("\n") == r["paragraph"]
    # the paragraphs of a passage leave no gap between them
    for d in holders[3]:
        covered = set()
        for r in got:
            if r["doc_id"] == d:
                first = len(text[d][: r["start"]].split())
                covered.update(range(first, first + r["n_words"]))
        words = text[d].split()
        at = next(i for i in range(len(words)) if words[i : i + 90] == passage[3])
        inside = sorted(covered & set(range(at, at + 90)))
        assert len(inside) >= 42 and inside == list(range(inside[0], inside[-1] + 1))
    assert paragraphs.classes(edge.limit(0)).count() == 0


def test_third_of_all_rows_from_one_template(spark):
    rng = random.Random(19)
    template = _words(rng, 120)
    rows = []
    for i in range(300):
        w = list(template)
        for _ in range(3):
            w[rng.randrange(120)] = f"n{i}x{rng.randrange(9)}"
        rows.append((i, "head " + " ".join(w[:60]) + "\n" + " ".join(w[60:])))
    rows += [(1000 + i, " ".join(_words(rng, 60))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert _classes(df, bucket=40)[0] == brute.paragraph_classes(rows)
    found = {r["doc_id"] for r in paragraphs.classes(df, bucket=40).select("doc_id").distinct().collect()}
    assert set(range(300)) <= found and not any(d >= 1000 for d in found)


def _searched(rows):
    """Links of ``paragraphs._search`` over rows (key, node, words) by key, as components of each key."""
    batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 700]), (pa.int64(), pa.int64(), pa.binary()))],
                                          names=["band", "node", "words"]) for i in range(0, len(rows), 700)]
    return [(a, b) for found in paragraphs._search(iter(batches), 0.8) for a, b in zip(found["a"].to_pylist(), found["b"].to_pylist())]


def test_links_of_buckets_of_all_sizes():
    rng = random.Random(31)
    rows, want, node = [], [], 0
    for key, size in enumerate([2, 1, 127, 128, 3, 400, 2, 129, *[2] * 300, 900, 5]):
        bases = [_words(rng, rng.choice([1, 3, 4, 5, 30, 60])) for _ in range(rng.choice([1, 3]))]
        texts = []
        for _ in range(size):
            w = list(rng.choice(bases))
            for _ in range(rng.choice([0, 1, 2, 5])):
                w[rng.randrange(len(w))] = f"n{rng.randrange(4)}"
            texts.append(" ".join(w).encode())
        sets = []
        for t in texts:
            w = t.split()
            sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))})
        first = list(range(size))  # the least of a component
        for a in range(size):
            for b in range(a):
                if first[a] != first[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    x, y = sorted((first[a], first[b]))
                    first = [x if f == y else f for f in first]
        want += [(node + f, node + i) for i, f in enumerate(first) if f != i]
        rows += [(key, node + i, t) for i, t in enumerate(texts)]
        node += size
    assert sorted(_searched(rows)) == sorted(want)


def test_a_large_bucket_of_near_lines_takes_little_time():
    """Pairs of a bucket that share a hundred shingles each are not counted shingle by shingle."""
    rng = random.Random(37)
    base, rows = _words(rng, 120), []
    for i in range(3000):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(120)] = f"n{i}x{rng.randrange(9)}"
        rows.append((7, i, " ".join(w).encode()))
    began = time.process_time()
    assert sorted(_searched(rows)) == [(0, i) for i in range(1, 3000)]
    assert time.process_time() - began < 5


def test_members_of_a_hot_bucket_meet_in_few_buckets(spark):
    """Every two members meet, and a member is sent once for each other slice, not once for each shingle of its prefix."""
    hot = spark.range(60).selectExpr("id % 2 AS band", "30L AS n", "id AS node", "cast('w' AS binary) AS words")
    met = defaultdict(set)
    sent = paragraphs._dealt(hot, 10).collect()
    for r in sent:
        met[r["band"]].add(r["node"])
    assert len(sent) == 60 * 2 and len(met) == 2 * 3 and all(len({n % 2 for n in m}) == 1 for m in met.values())
    pairs = {(a, b) for m in met.values() for a in m for b in m}
    assert pairs == {(a, b) for a in range(60) for b in range(60) if a % 2 == b % 2}


def test_bands_reach_the_recall():
    n = paragraphs.bands_for()
    assert 1 - (1 - paragraphs.SIMILARITY**paragraphs.BAND_ROWS) ** n >= paragraphs.RECALL
    rng = random.Random(1)
    hit = 0
    for _ in range(500):
        first = [w.encode() for w in _words(rng, 100)]
        second = [*first[:30], b"x", *first[31:70], b"y", *first[71:]]  # 86 of 106 shingles: 0.81
        keys = paragraphs.band_keys([first, [b"z"] * 7, second, first], n)
        assert (keys[0] == keys[3]).all()
        hit += bool((keys[0] == keys[2]).any())
    assert hit >= 490


def test_passages(edge, edge_rows, empty, small_docs, small_rows):
    ensure_checkpoint_dir(edge.sparkSession)
    assert passages.passage_rows(empty).collect() == []
    for df, rows in ((edge, edge_rows), (small_docs, small_rows)):
        assert _sorted(passages.passage_rows(df).collect()) == _sorted(brute.passages(rows))


def test_planted_passages_inside_and_over_lines(spark):
    """What no pair of lines shows: a passage inside a longer line, one wrapped over short lines, near copies."""
    ensure_checkpoint_dir(spark)
    rng = random.Random(21)
    planted, rows = _words(rng, 57), []
    own = lambda n: " ".join(_words(rng, n))
    wrapped = "\n".join(" ".join(planted[i : i + 9]) for i in range(0, 57, 9))
    rows += [(4, f"{own(40)} {' '.join(planted)} {own(43)}"), (2, f"é {own(30)}\n{wrapped.upper()}\n{own(12)}")]
    rows += [(3, own(25) + " " + " ".join(planted[:49]) + " " + own(30)), (None, own(8) + "  " + wrapped)]
    base = _words(rng, 160)
    rows += [(100 + i, " ".join(w if j != 10 * i + 5 else "anders" for j, w in enumerate(base))) for i in range(14)]
    rows += [(50 + i, "wieder " * (60 + i)) for i in range(3)] + [(9, rows[0][1])] * 2 + [(7, own(49)), (8, own(300))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = _sorted(passages.passage_rows(df).collect())
    assert got == _sorted(brute.passages(rows))
    lengths = {d: (n, gone) for d, _, _, n, gone in got if d in (2, 3, None)}
    assert lengths == {2: (57, False), None: (57, True)}
    assert not {2, None} & {d for d, _ in _classes(df)[0]}  # no line of these is like another


def test_passages_of_long_texts_come_in_overlapping_pieces(monkeypatch):
    import pyarrow as pa

    rng = random.Random(22)
    texts = [" ".join(_words(rng, n)) for n in (700, 3, 260, 50, 49)]
    keys = [pa.array(range(5), pa.int64())] * 2

    def windows():
        given = pa.RecordBatch.from_arrays([*keys, pa.array(texts)], names=["hash", "n_bytes", "text"])
        runs = defaultdict(list)
        for b in passages._anchor_rows([given], 50, 16):
            for r in b.to_pylist():
                runs[r["hash"]].append({"first": r["first"], "last": r["last"]})
        given = pa.RecordBatch.from_arrays(
            [*keys, pa.array([False] * 5), keys[0], pa.array(texts), pa.array([runs[i] for i in range(5)])],
            names=["hash", "n_bytes", "no_id", "number", "text", "runs"],
        )
        return sorted((r["hash"], r["start"], r["hi"], r["lo"]) for b in passages._window_rows([given], 50) for r in b.to_pylist())

    whole = windows()
    assert [x[:2] for x in whole] == [(i, s) for i, n in ((0, 700), (2, 260), (3, 50)) for s in range(n - 49)]
    monkeypatch.setattr(passages, "_BLOCK", 90)
    assert windows() == whole


# ---- 5
def test_line_rows(edge, edge_rows, small_docs, small_rows):
    for df, rows in ((edge, edge_rows), (small_docs, small_rows)):
        want = [(d, n, k, brute.sha(t.encode())) for (d, _), (n, k, t) in zip(rows, brute.line_dedup(rows), strict=True)]
        assert _sorted(lines.line_rows(df).collect()) == _sorted(want)


def test_line_dedup_over_batches_and_hot_lines(spark):
    rng = random.Random(5)
    common = [f"a common line number {i} of the corpus" for i in range(12)]
    rows = []
    for i in range(300):
        own = [rng.choice(common) if rng.random() < 0.6 else f"line {rng.randrange(150)} that few documents hold" for _ in range(rng.randrange(6))]
        rows.append((rng.choice([i, i // 2, None if i % 50 == 0 else i]), "\n".join([*own, common[0] if i % 3 else "x"])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    want = [(d, n, k, brute.sha(t.encode())) for (d, _), (n, k, t) in zip(rows, brute.line_dedup(rows), strict=True)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert _sorted(lines.line_rows(df).collect()) == _sorted(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_line_bitmaps_round_trip(edge):
    for n, dropped in ((1, []), (9, [0, 8]), (1000, list(range(0, 1000, 7)))):
        keep = lines.unpack_bitmap(n, lines.pack_bitmap(n, dropped))
        assert keep.sum() == n - len(dropped) and not keep[dropped].any()
    out = lines.dedup_lines(edge)
    assert out.columns == edge.columns and out.count() == edge.count()


# ---- 8
def _substring(df):
    return [tuple(r) for r in suffixes.substring_rows(df).collect()]


def test_substring_rows(edge, edge_rows, small_docs, small_rows):
    for df, rows in ((edge, edge_rows), (small_docs, small_rows)):
        want = [(d, *x) for (d, _), x in zip(rows, brute.substring_dedup([t for _, t in rows]), strict=True)]
        assert _sorted(_substring(df)) == _sorted(want)


def _span_rows(df, length, hot):
    texts = suffixes.distinct_texts(df, length=length)
    found = suffixes.repeated_spans(texts, length, hot).collect()
    starts = {}
    for r in found:
        starts.setdefault((r["hash"], r["n_bytes"]), set()).update(range(r["first"], r["last"] + 1))
    return {r["text"]: starts.get((r["hash"], r["n_bytes"]), set()) for r in texts.collect()}


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeated_starts_in_random_texts(spark, hot):
    ensure_checkpoint_dir(spark)
    rng = random.Random(11)
    passage = "".join(rng.choice("abcd ") for _ in range(330))
    texts = []
    for i in range(40):
        own = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
        a = rng.randrange(0, 120)
        texts.append(own(rng.randrange(90)) + passage[a : a + rng.randrange(190, 330)] + own(rng.randrange(150)))
    texts += ["ab" * 180, "c" * 500, passage, passage * 2, "kurz", passage[:199]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    got = _span_rows(df, 200, hot)
    data = {t: t.encode() for t in set(texts)}
    from collections import Counter

    counts = Counter(t[i : i + 200] for t in data.values() for i in range(len(t) - 199))
    for t, b in data.items():
        if len(b) >= 200:
            assert got[t] == {i for i in range(len(b) - 199) if counts[b[i : i + 200]] > 1}, t[:40]


def test_long_texts_come_in_overlapping_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    data = bytes(rng.integers(97, 105, 5000, np.uint8))
    whole = list(suffixes.blocks([data], 200))
    monkeypatch.setattr(suffixes, "_BLOCK", 700)

    def starts(parts):
        out = {}
        for joined, ends, origin in parts:
            first, last, anchor, _ = suffixes.anchors(np.frombuffer(joined, np.uint8), ends, 200)
            piece = np.searchsorted(ends, first, side="right")
            begin = np.concatenate([[0], ends[:-1]])[piece]
            for f, l, a, p, b in zip(first, last, anchor, piece, begin, strict=True):
                for s in range(f, l + 1):
                    out[s - b + origin[p][1]] = a - b + origin[p][1]
        return out

    assert starts(whole) == starts(suffixes.blocks([data], 200))
    assert sorted(starts(whole)) == list(range(len(data) - 199))


def test_multikey_sort_finds_equal_strings():
    rng = np.random.default_rng(4)
    tokens = [rng.integers(0, 3, 400).astype(np.uint64) for _ in range(4)]
    classes = rng.integers(0, 2, 400)
    rows = list(zip(classes.tolist(), *(t.tolist() for t in tokens), strict=True))
    assert suffixes.multikey_repeats(classes, tokens).tolist() == [rows.count(r) > 1 for r in rows]


# ---- 9
def test_simhash_rows(edge, edge_rows, small_docs, small_rows):
    for df, rows in ((edge, edge_rows), (small_docs, small_rows)):
        want = [(d, format(p, "016x"), c) for (d, _), (p, c, _) in zip(rows, brute.simhash_components(rows), strict=True)]
        assert _sorted(simhash.simhash_rows(df).collect()) == _sorted(want)


def test_simhash_keeps_one_row_of_a_component(edge, edge_rows):
    out = simhash.dedup(edge)
    assert out.columns == edge.columns
    root = {r: c for _, c, r in brute.simhash_components(edge_rows)}
    assert sorted((r["doc_id"] for r in out.collect()), key=lambda d: (d is None, d)) == sorted(
        root.values(), key=lambda d: (d is None, d)
    )


def _chain_prints(rng, n):
    """Fingerprints in clusters and chains of few bits, and far ones."""
    out = set(rng.integers(0, 1 << 63, n, np.uint64).tolist())
    for seed in list(out)[: n // 4]:
        at = seed
        for _ in range(6):
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                at ^= 1 << int(b)
            out.add(at)
    return np.array(sorted(out), np.uint64)


def test_gray_index_finds_all_pairs():
    prints = _chain_prints(np.random.default_rng(6), 300)
    index = simhash.GrayIndex(prints)
    q, node = index.search(prints, 3)
    got = {(int(prints[a]), int(index.prints[b])) for a, b in zip(q, node, strict=True)}
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    assert got == {(int(prints[a]), int(prints[b])) for a, b in zip(*np.nonzero(near), strict=True)}


@pytest.mark.parametrize("bucket", [2000, 3])
def test_simhash_links_join_the_right_components(spark, bucket):
    ensure_checkpoint_dir(spark)
    prints = _chain_prints(np.random.default_rng(7), 200)
    prints = np.concatenate([prints, np.uint64(1 << 40) ^ (np.uint64(1) << np.arange(20, dtype=np.uint64))])
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "print bigint").distinct()
    edges = simhash.links(df, 3, bucket).collect()
    values = np.unique(prints)
    number = {int(v): i for i, v in enumerate(values.view(np.int64))}
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 3 for a, b in edges)

    def label(pairs):
        root = list(range(len(values)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(len(values))]

    near = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3, 1))
    assert label([(number[a], number[b]) for a, b in edges]) == label(near.tolist())


def test_choices_of_bits_cover_all_bits_and_end():
    chosen, depth = [[]], 0
    while 64 - min(map(len, chosen)) > simhash.FREE_BITS:
        nexts = simhash._next_choices(chosen, 4)
        for i, taken in enumerate(chosen):
            blocks = [set(c) - set(taken) for c in nexts[4 * i : 4 * i + 4]]
            assert set().union(*blocks) == set(range(64)) - set(taken) and sum(map(len, blocks)) == 64 - len(taken)
        chosen, depth = nexts, depth + 1
    assert depth == 5 and len(chosen) <= simhash.PARTS


def test_simhash_links_of_a_cluster_that_shares_most_bits(spark):
    # 300 fingerprints differ in 14 bits only, so that every early bucket holds all of them
    rng = np.random.default_rng(7)
    low = rng.choice(1 << 14, 300, replace=False).astype(np.uint64)
    prints = np.unique(np.concatenate([low | np.uint64(0xABCD << 48), rng.integers(0, 1 << 63, 40, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print bigint")
    edges = simhash.links(df, 3, 20).collect()
    root = list(range(len(prints)))
    place = {int(p): i for i, p in enumerate(prints.view(np.int64))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= 3
        root[find(place[a])] = find(place[b])
    for i, p in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(prints ^ p) <= 3):
            assert find(i) == find(int(j))


def test_components(spark):
    ensure_checkpoint_dir(spark)
    rng = random.Random(9)
    pairs = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1040)] + [(5, 5), (None, 3), (2000, 2001), (2001, 2000)]
    pairs += [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(120)] + [(-7, 60)]
    rng.shuffle(pairs)
    got = dict(components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    real = [(a, b) for a, b in pairs if a is not None]
    root = {x: x for p in real for x in p}
    for _ in range(len(root)):
        before = dict(root)
        for a, b in real:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    assert got == root
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("rows", [paragraphs.paragraph_rows, lines.line_rows, suffixes.substring_rows, simhash.simhash_rows])
def test_empty_tables(empty, rows):
    ensure_checkpoint_dir(empty.sparkSession)
    assert rows(empty).collect() == []
