"""The pipeline against plain versions of its stages, and the registered queries against DuckDB."""

from collections import defaultdict

import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stockroom.compare import compare, duck_connect
from stockroom.llm import secrets
from stockroom.llm.queries import ORACLE_SQL, QUERIES
from stockroom.session import ensure_checkpoint_dir

from paths import SF_SMALL as SMALL  # noqa: E402


def _rows(df):
    return sorted((r["doc_id"], r["text"], r["n_chars"]) for r in df.collect())


def test_every_stage_against_a_plain_version(spark, small_docs):
    ensure_checkpoint_dir(spark)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "SimHash near-dedup", "secret scans", "packing"]
    docs = small_docs
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]

    out = stages["quality rules"](spark, docs, SMALL)
    kept = [(d, t) for d, t in given if brute.quality(t)["kept"]]
    assert out.columns == docs.columns and _rows(out) == sorted((d, t, len(t)) for d, t in kept)

    docs = corpus_pipeline.materialize(out, "test-quality")
    out = stages["line dedup"](spark, docs, SMALL)
    kept = [(d, t) for (d, _), (_, _, t) in zip(kept, brute.line_dedup(kept), strict=True)]
    assert out.columns == docs.columns and _rows(out) == sorted((d, t, len(t)) for d, t in kept)

    docs = corpus_pipeline.materialize(out, "test-lines")
    out = stages["SimHash near-dedup"](spark, docs, SMALL)
    kept = [(d, t) for (d, t), (_, c, _) in zip(kept, brute.simhash_components(kept), strict=True) if d == c]
    assert out.columns == docs.columns and _rows(out) == sorted((d, t, len(t)) for d, t in kept)

    docs = corpus_pipeline.materialize(out, "test-near")
    out = stages["secret scans"](spark, docs, SMALL)
    model = secrets.train(docs)
    masked = []
    for d, t in kept:
        chars = list(t)
        covered = set()
        for s, _, e in secrets.spans_of(t, model):
            covered.update(range(s, e))
        text = "".join("" if i in covered and i - 1 in covered else "[secret]" if i in covered else c for i, c in enumerate(chars))
        masked.append((d, text, len(text)))
    assert out.columns == docs.columns and _rows(out) == sorted(masked)

    docs = corpus_pipeline.materialize(out, "test-secrets")
    got = stages["packing"](spark, docs, SMALL).collect()
    lengths = defaultdict(int)
    for r in got:
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {d: len(brute.word_ids(t)) for d, t, _ in masked}


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, edge, empty, stage):
    ensure_checkpoint_dir(spark)
    run = dict(corpus_pipeline.STAGES)[stage]
    for docs in (edge, empty):
        out = run(spark, docs, SMALL)
        rows = out.collect()
        if stage != "packing":
            assert out.columns == docs.columns and out.schema == docs.schema.fromJson(out.schema.jsonValue())
        assert len(rows) == 0 or docs is edge


def test_entry_registers_the_queries():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, key):
    ok, msg = compare(QUERIES[key](spark, SMALL), duck_connect(SMALL), ORACLE_SQL[key])
    assert ok, msg
