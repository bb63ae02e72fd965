"""Operators 1, 4 and 7: one result per row, against plain versions."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from stockroom.llm import bytebpe, packing, quality, secrets


def _by_text(rows):
    """Rows in an order that the row's own columns fix."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


# ---- 1
def test_secret_rows(spark, edge, edge_rows, small_docs, small_rows):
    for df, rows in ((edge, edge_rows), (small_docs, small_rows)):
        got = secrets.secret_rows(df).collect()
        want = []
        for d, t in rows:
            spans = brute.secrets(t)
            text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
            n = [sum(k == kind for k, _, _ in spans) for kind in ("assign", "access", "hex")]
            want.append((d, *n, brute.sha(text.encode())))
        assert _by_text([tuple(r[:5]) for r in got]) == _by_text(want)
        assert all(set(x.split(":")[0] for x in r["spans"].split(",") if x) <= set(secrets.KINDS) for r in got)


def test_markov_finds_random_tokens_and_leaves_words(edge):
    got = {r["doc_id"]: r["spans"] for r in secrets.secret_rows(edge).collect()}
    text = dict(edge.select("doc_id", "text").collect())
    s = text[15].index("q7Zk")
    assert f"markov:{s}:{s + 24}" in got[15].split(",")
    assert sum(x.startswith("markov") for v in got.values() for x in v.split(",")) == 1


def test_markov_model_separates_held_out_samples():
    count = lambda tokens: np.bincount(secrets._pairs(tokens), minlength=secrets.STATES**2)
    model = secrets.fit(count(secrets.drawn_strings()), count(secrets.composed_identifiers()))
    random = secrets.drawn_strings(400, 24, seed=99)
    ordinary = [x for x in secrets.composed_identifiers(2000, seed=98) if len(x) >= secrets.MIN_TOKEN]
    assert np.mean([model.is_random(x) for x in random]) > 0.97
    assert np.mean([model.is_random(x) for x in ordinary]) < 0.01


def test_rest_of_a_random_token_beside_a_base_span():
    count = lambda tokens: np.bincount(secrets._pairs(tokens), minlength=secrets.STATES**2)
    model = secrets.fit(count(secrets.drawn_strings()), count(secrets.composed_identifiers()))
    code, rest = "1beb58b8af68854f0e01b4ad", "q7Zk29xLwP0vT3mRb8YcN5dJWs61Ku"
    found = lambda t: [(secrets.KINDS[k], t[s:e]) for s, k, e in secrets.spans_of(t, model)]
    assert found(f"a {code}{rest} b") == [("hex", code), ("markov", rest)]
    assert found(f"{rest}{code}{rest}") == [("markov", rest), ("hex", code), ("markov", rest)]
    assert found(f"a {code}{rest[:9]}, b") == [("hex", code), ("markov", rest[:9])]  # too short for a token
    assert found(f"{rest}_token={rest}") == [("markov", f"{rest}_"), ("assign", f"token={rest}")]
    for name in ("order_document_", "files/archive2/"):  # names before a code
        assert found(name + code) == [("hex", code)]
    assert found(f"user_session_token={rest}") == [("assign", f"token={rest}")]
    whole = f"a {rest[:5]}{code}{rest} b"
    assert secrets.mask_spans(whole, secrets.spans_of(whole, model), "#") == "a # b"


def test_redaction_masks_spans_and_keeps_rows(edge, edge_rows):
    out = secrets.redact_documents(edge)
    assert out.columns == edge.columns and out.count() == len(edge_rows)
    texts = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] is not None}
    assert "1beb58" not in texts[14] and "hunter2" not in texts[14] and "API_KEY=abc" in texts[14]
    assert "AKIA" not in texts[15] and texts[1] is None and texts[2] == ""


def test_masked_spans_are_merged():
    assert secrets.mask_spans("abcdef", [(1, 0, 3), (2, 1, 4), (4, 2, 5)], "#") == "a#f"
    assert secrets.mask_spans("abcdef", [(0, 0, 1), (5, 3, 6)], "#") == "#bcde#"


# ---- 4
def _tiktoken():
    ranks = bytebpe.read_ranks(public_tokenizers.path(bytebpe.RANK_FILE))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec_rows_equal_tiktoken(edge, edge_rows, small_docs, small_rows):
    enc = _tiktoken()
    for df, rows in ((edge, edge_rows), (small_docs, small_rows)):
        want = []
        for d, t in rows:
            ids = enc.encode_ordinary(t or "")
            want.append((d, len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha((t or "").encode())))
        assert _by_text([tuple(r) for r in bytebpe.codec_rows(df).collect()]) == _by_text(want)


def test_odd_characters_and_white_space_equal_tiktoken():
    enc, codec = _tiktoken(), bytebpe.Codec(public_tokenizers.path(bytebpe.RANK_FILE))
    points = [*range(0, 0x600), *range(0x1600, 0x1700), *range(0x1F00, 0x2100), *range(0x2FF0, 0x3010), 0xFEFF, 0x1F642, 0xE0100]
    for x in points:
        text = f"a{chr(x)} b 1{chr(x)}{chr(x)}c !{chr(x)}.\n {chr(x)}"
        assert codec.encode(text) == enc.encode_ordinary(text), hex(x)
    for text in ("   ", "\n\n a", "a\t b \t\n  c", "aaaa" * 50, " " * 70 + "x", "\r\n\r\n"):
        assert codec.encode(text) == enc.encode_ordinary(text), repr(text)


def test_offsets_and_split_characters():
    codec = bytebpe.Codec(public_tokenizers.path(bytebpe.RANK_FILE))
    text = "Ein 🙂 in 漢字, dann mehr 𐍈."
    ids, offsets = codec.encode_with_offsets(text)
    assert ids == codec.encode(text) and len(offsets) == len(ids)
    assert offsets[0][0] == 0 and offsets[-1][1] == len(text) and all(a <= b for a, b in offsets)
    assert any(codec.bytes_of[i].decode("utf-8", "ignore").encode() != codec.bytes_of[i] for i in ids)  # a split character
    assert "".join(codec.decode_pieces(ids)) == text


def test_encode_then_decode_columns(edge):
    path = public_tokenizers.path(bytebpe.RANK_FILE)
    out = bytebpe.decode(bytebpe.encode(edge, "ids", path), "back", path)
    for r in out.select("text", F.decode("back", "utf-8").alias("back")).collect():
        assert r["back"] == (r["text"] or "")
    spans = bytebpe.encode(edge, "got", path, offsets=True).select("text", "got.*").collect()
    assert all(len(r["ids"]) == len(r["starts"]) == len(r["ends"]) for r in spans)


# ---- 7
def test_quality_rows(edge, edge_rows, small_docs, small_rows):
    for df, rows in ((edge, edge_rows), (small_docs, small_rows)):
        got = quality.quality_rows(df).collect()
        names = list(brute.quality(""))
        want = [(d, *brute.quality(t).values()) for d, t in rows]
        assert _by_text([(r["doc_id"], *(r[n] for n in names)) for r in got]) == _by_text(want)


def test_quality_filter_keeps_columns(edge, edge_rows):
    out = quality.filter_quality(edge)
    assert out.columns == edge.columns
    assert out.count() == sum(brute.quality(t)["kept"] for _, t in edge_rows)


def test_repetition_is_the_same_in_any_block(small_rows, monkeypatch):
    texts = [t for _, t in small_rows]
    whole = quality.repetition(texts, [5, 7])
    monkeypatch.setattr(quality, "_BLOCK_WORDS", 50)
    parts = quality.repetition(texts, [5, 7])
    assert all((whole[k] == parts[k]).all() for k in whole)


@pytest.mark.parametrize("rows", [secrets.secret_rows, bytebpe.codec_rows, quality.quality_rows])
def test_empty_tables(empty, rows):
    assert rows(empty).collect() == []


# ---- long texts and bounded memories
def test_secrets_of_a_long_text_take_linear_time():
    import time

    model = secrets.fit(np.bincount(secrets._pairs(secrets.drawn_strings()), minlength=secrets.STATES**2),
                        np.bincount(secrets._pairs(secrets.composed_identifiers()), minlength=secrets.STATES**2))
    part = "token=abcdefgh12 user_name_of_the_row x9Kq2LmZ7vTrB4nWp0YdQ8sC aa11bb22cc33dd44ee55ff66 zZ9 "
    small, large = part * 1_000, part * 120_000  # 10 MB
    want = secrets.spans_of(small, model)
    assert sum(k == 3 for _, k, _ in want) >= 1_000
    start = time.process_time()
    got = secrets.spans_of(large, model)
    inside = secrets._outside(large, secrets.base_spans(large), secrets._IDENTIFIER)
    assert time.process_time() - start < 120
    assert got[: len(want) - 5] == want[: len(want) - 5] and len(got) == 120 * len(want)
    assert inside and all(not (s < e2 and s2 < e) for (s, e), (s2, _, e2) in zip(inside[:50], secrets.base_spans(large)[:50], strict=False))


def test_outside_equals_every_pair():
    rng = random.Random(6)
    for _ in range(60):
        text = "".join(rng.choice("abcdefgh12345678_ ") for _ in range(400))
        spans = sorted((s, 0, min(s + rng.randrange(1, 60), 400)) for s in rng.sample(range(400), rng.randrange(6)))
        want = [m.span() for m in secrets._IDENTIFIER.finditer(text) if not any(s < m.end() and m.start() < e for s, _, e in spans)]
        assert secrets._outside(text, spans, secrets._IDENTIFIER) == want


def test_planted_random_tokens_of_a_table_are_found(spark, small_docs):
    """Held-out strings, drawn apart from the training sample, in the table's own texts."""
    planted = secrets.drawn_strings(400, 30, seed=99)
    plain = secrets.composed_identifiers(400, seed=98)
    rows = [(r["doc_id"], r["text"]) for r in small_docs.select("doc_id", "text").collect()]
    given = [(d, f"{t or ''} {planted[i % 400]} {plain[i % 400]} end") for i, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(given, "doc_id bigint, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.secret_rows(df).select("doc_id", "spans").collect()}
    hit = wrong = 0
    for i, (d, t) in enumerate(given):
        spans = [tuple(map(int, s.split(":")[1:])) for s in got[d].split(",") if s]
        covered = lambda word: any(s <= t.index(word) and t.index(word) + len(word) <= e for s, e in spans)  # noqa: B023, E731
        hit += covered(planted[i % 400])
        wrong += covered(plain[i % 400])
    assert hit >= 0.95 * len(given) and wrong <= 0.02 * len(given)


def test_word_memories_are_bounded_by_bytes():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.WordEncoder(path, 2_000)
    codec = bytebpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rng = random.Random(4)
    for i in range(300):
        text = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(200)) + f"\nword{i} of number {i}"
        assert np.frombuffer(encoder(text), "<u4").tolist() == brute.word_ids(text)[:-1]
        codec.encode(text)
        assert encoder._bytes <= packing.WORD_BYTES * 2_000 and max(map(len, encoder._memory)) <= packing.LONGEST_WORD
    assert max(map(len, codec._memory)) <= bytebpe.LONGEST_PIECE and codec._bytes < 1_000_000


def test_a_text_of_20_mb_without_blanks():
    text = "abcdefghij" * 2_000_000
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    codec = bytebpe.Codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    short = text[:200_000]
    assert codec.decode_bytes(codec.encode(short)).decode() == short
    assert np.frombuffer(encoder(short), "<u4").tolist() == brute.word_ids(short)[:-1]
    assert len(encoder(text)) > 0 and encoder._bytes < 1_000 and codec._bytes < 1_000
