"""Operators 3, 6 and 10: shards, packed sequences and exact top-k."""

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from stockroom.llm import packing, sharding, topk


# ---- 3
def _check_shards(got, rows, shards=24):
    sizes = [len((t or "").encode()) + 8 for _, t in rows]
    crc = [zlib.crc32((t or "").encode()) for _, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=key) == sorted(
        zip([d for d, _ in rows], sizes, crc, strict=True), key=key
    )
    by = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        by[r["shard"]].append((r["slot"], r["size"]))
    total, most = sum(sizes), max(sizes, default=0)
    for shard, members in by.items():
        assert 0 <= shard < shards and sorted(s for s, _ in members) == list(range(len(members)))
    for shard in range(shards):  # equal up to the document at either end
        assert abs(sum(s for _, s in by[shard]) - total / shards) <= most + 1


def test_shards(edge, edge_rows, small_docs, small_rows):
    _check_shards(sharding.shard_rows(edge).collect(), edge_rows)
    _check_shards(sharding.shard_rows(small_docs).collect(), small_rows)


def test_shards_with_hot_copies_and_repeated_rows(spark):
    rng = random.Random(1)
    rows = [(i, "copy of one text " * 5) for i in range(900)] + [(7, "")] * 500 + [(None, None)] * 20
    rows += [(10_000 + i, "x" * rng.randrange(400)) for i in range(600)] + [(99_999, "long " * 2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    _check_shards(sharding.shard_rows(df).collect(), rows)


def test_order_key_sorts_like_the_columns():
    rng = np.random.default_rng(3)
    import pyarrow as pa

    a, b = (rng.choice(np.array([-(1 << 63), -5, 0, 1, 256, (1 << 63) - 1]), 200) for _ in range(2))
    keys = sharding.order_key(pa.array(a), pa.array(b))
    assert np.argsort(keys, kind="stable").tolist() == sorted(range(200), key=lambda i: (a[i], b[i]))


def test_overfull_ranges_are_subdivided(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 3000, 5).otherwise(F.col("id")).cast("long").alias("key_hash"), F.col("id").alias("key_doc"),
        F.lit(0).cast("long").alias("salt"), F.when(F.col("id") % 100 == 0, 3000).otherwise(10).cast("long").alias("size"),
    )
    total = rows.agg(F.sum("size")).first()[0]
    splitters, totals = sharding.split(rows, total, 4000)
    assert sum(t[1] for t in totals) == 4000 and sum(t[2] for t in totals) == total
    limit = sharding.OVERFULL * 2 * total / sharding.RANGES
    assert max(b + n * total / 4000 for _, n, b in totals if n > 1) <= max(limit, 3 * 3000)


def test_totals_belong_to_the_last_splitters(spark, monkeypatch):
    """Rounds that end while ranges are still being cut: no row is lost or placed twice."""
    monkeypatch.setattr(sharding, "ROUNDS", 1)
    rng = random.Random(12)
    rows = [(i, f"{i} " + "x" * rng.randrange(100)) for i in range(3000)] + [(5000 + i, f"{i} " + "long " * 1500) for i in range(30)]
    rows += [(7, "copy " * 20)] * 1500
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sharding.shard_rows(df).collect()
    assert len(got) == len(rows)
    _check_shards(got, rows)


# ---- 6
def _check_packing(got, rows, capacity=4096):
    ids = [np.array(brute.word_ids(t), "<u4") for _, t in rows]
    want, have = defaultdict(int), defaultdict(int)
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    for (d, _), x in zip(rows, ids, strict=True):
        for start in range(0, len(x), capacity):
            part = x[start : start + capacity]
            want[d, len(x), start, len(part), zlib.crc32(part.tobytes())] += 1
    for (d, n), found in pieces.items():
        for start, length, crc in found:
            have[d, n, start, length, crc] += 1
    assert have == want
    windows = defaultdict(list)
    for r in got:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(windows)


def test_packed_documents(edge, edge_rows, small_docs, small_rows):
    _check_packing(packing.pack_documents(edge).collect(), edge_rows)
    n = _check_packing(packing.pack_documents(small_docs).collect(), small_rows)
    tokens = sum(len(brute.word_ids(t)) for _, t in small_rows)
    assert n <= 1.05 * tokens / 4096 + 1


def test_leftovers_merge_over_levels(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("wort" for _ in range(rng.randrange(1, 700)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    path = packing.public_tokenizers.path(packing.TOKENIZER_FILE)
    got = packing.pack(df, lambda: packing.word_encoder(path), capacity=512, open_windows=4, fan_in=2)
    out = got.select("*", F.crc32("ids").alias("ids_crc32")).collect()
    n = _check_packing(out, rows, 512)
    tokens = sum(len(brute.word_ids(t)) for _, t in rows)
    assert n <= 1.2 * tokens / 512 + 4
    assert all(len(r["ids"]) == 4 * r["length"] for r in out)


def test_packer_is_bounded_and_emits_the_fullest():
    p = packing.Packer(10, 2)
    put = lambda n: list(p.place((1, 0, b"\0" * 4 * n, n)))
    assert put(6) == [] and put(7) == []
    assert [w for w, _, _ in put(8)] == [1]  # nothing has room: the fullest (7 of 10) goes
    assert [w for w, _, _ in put(2)] == [2]  # best fit fills the window of 8
    assert len(list(p.rest())) == 1


# ---- 10
def _top(rows, k=10, every=100):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    out = []
    for q, v in whole:
        if q % every == 0:
            scored = [(-sum(a * b for a, b in zip(v, c, strict=False)), i) for i, c in whole if i != q]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=12) * rng.lognormal(0, 1.5)).astype(np.float32).tolist(), 0) for i in range(700)]
    rows += [(700 + i, rows[3][1], 1) for i in range(15)]  # ties
    rows += [(900, None, 0), (901, [1.0, None], 0), (902, [float("nan")] * 12, 0), (903, [float("inf")] * 12, 0)]
    rows += [(None, [9.0] * 12, 0), (905, [], 0), (906, [3.0, -2.0], 0), (-100, [0.5] * 12, 0), (1000, [0.0] * 12, 0)]
    got = sorted(tuple(r) for r in topk.top_rows(_vectors(spark, rows)).collect())
    assert got == _top([(i, v) for i, v, _ in rows])


def test_top_k_in_several_blocks_and_few_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist(), 0) for i in range(300)]
    vectors = topk.as_integers(_vectors(spark, rows))
    out = topk.search(vectors, vectors.filter("vec_id % 10 = 0"), k=4, block=7)
    assert sorted(tuple(r) for r in out.collect()) == _top([(i, v) for i, v, _ in rows], 4, 10)
    few = [(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0), (100, [0.0, -1.0], 0)]
    assert sorted(tuple(r) for r in topk.top_rows(_vectors(spark, few)).collect()) == _top([(i, v) for i, v, _ in few])


def test_pruning_skips_short_vectors():
    rng = np.random.default_rng(7)
    exact = rng.integers(-50, 50, (4000, 8)) * np.linspace(100, 1, 4000).astype(int)[:, None]
    order = np.argsort(-np.linalg.norm(exact, axis=1))
    exact = exact[order]
    rotation = np.linalg.svd(exact.T.astype(float) @ exact)[0]
    queries = topk.Rotated(exact[:5], rotation, 2)
    found = topk.Search(np.arange(-5, 0), queries, 3)
    found.add(np.arange(4000), topk.Rotated(exact, rotation, 2))
    assert not len(found.open(1.0)) or found.best()[0].size
    q, c, s = found.best()
    for i in range(5):
        scores = exact @ exact[i]
        assert sorted(s[q == i].tolist(), reverse=True) == sorted(scores.tolist(), reverse=True)[:3]


def test_long_vectors_read_after_short_ones(spark):
    """Several files to a task: the few long vectors compress well, so their files are read last."""
    rng = np.random.default_rng(8)
    long = [(rng.random(16) * 500).astype(np.float32).tolist() for _ in range(5)]
    rows = [(i, long[i % 5] if i % 3 == 1 else (rng.random(16) * rng.random()).astype(np.float32).tolist(), 0) for i in range(6000)]
    # all files in one task, the largest first, in many batches
    options = {"spark.sql.files.minPartitionNum": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "200"}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        vectors = topk.as_integers(_vectors(spark, rows))
        out = sorted(tuple(r) for r in topk.search(vectors, vectors.filter("vec_id % 500 = 0"), k=4).collect())
    finally:
        for name in options:
            spark.conf.unset(name)
    assert out == _top([(i, v) for i, v, _ in rows], 4, 500)


def test_components_beyond_a_long_are_an_error(spark):
    rows = [(0, [1e17, 2.0**-10]), (100, [1.0, 1.0]), (3, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_rows(df).collect()


def test_clashing_columns_of_vectors(spark):
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(300)], "vec_id bigint, embedding array<float>")
    plain = sorted(map(tuple, topk.top_rows(df).collect()))
    more = df.selectExpr("*", "1 AS v", "2 AS length2", "3 AS score", "4 AS rank")
    assert sorted(map(tuple, topk.top_rows(more).collect())) == plain


def test_large_components(spark):
    rows = [(i, [2e6 * (-1) ** (i // 50), float(i), -3.0], 0) for i in range(0, 300, 50)]
    assert sorted(tuple(r) for r in topk.top_rows(_vectors(spark, rows)).collect()) == _top([(i, v) for i, v, _ in rows])
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_rows(_vectors(spark, [(0, [1e15, 1.0], 0), (1, [1e15, 2.0], 0)])).collect()


@pytest.mark.parametrize("rows", [sharding.shard_rows, packing.pack_documents])
def test_empty_tables(empty, rows):
    assert rows(empty).collect() == []


def test_empty_vectors(spark):
    assert topk.top_rows(_vectors(spark, [(0, [1.0], 0)]).limit(0)).collect() == []
