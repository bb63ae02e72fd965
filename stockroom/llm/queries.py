"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockroom.llm import (
    bytebpe, lines, packing, paragraphs, passages, phrases, quality, secrets, sharding, simhash, sketches, suffixes,
    topk, variants,
)
from stockroom.llm.common import documents
from stockroom.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(rows: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return rows(documents(spark, sf_dir))

    return query


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return topk.top_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    "op1_secret_scan": _over_documents(secrets.secret_rows),
    "op2_paragraph_dedup": _over_documents(paragraphs.paragraph_rows),
    "op2_line_paragraphs": _over_documents(paragraphs.line_rows),
    "op2_passage_dedup": _over_documents(passages.passage_rows),
    "op3_sharding": _over_documents(sharding.shard_rows),
    "op4_byte_bpe": _over_documents(bytebpe.codec_rows),
    "op5_line_dedup": _over_documents(lines.line_rows),
    "op6_packing": _over_documents(packing.pack_documents),
    "op7_quality_rules": _over_documents(quality.quality_rows),
    "op8_suffix_dedup": _over_documents(suffixes.substring_rows),
    "op9_simhash": _over_documents(simhash.simhash_rows),
    "op10_topk": _top,
    "op11_fast_sketch_dedup": _over_documents(sketches.near_rows),
    "op12_collocations": _over_documents(phrases.phrase_rows),
    "op13_spelling_variants": _over_documents(variants.variant_rows),
}

# Blanks of the contracts as a DuckDB character list.
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS k FROM lines
), holders AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= {lines.MIN_LENGTH}
  GROUP BY k HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCUMENTS}
), judged AS (
  SELECT keyed.doc_id, pos, line, keeper IS NOT NULL AND keeper <> keyed.doc_id AS dropped
  FROM keyed LEFT JOIN holders ON keyed.k = holders.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_COVERS = "".join(
    f""", cover_{n} AS (
  SELECT doc_id, sum(chars) AS c FROM words WHERE EXISTS (
    SELECT 1 FROM repeated_{n} r WHERE r.doc_id = words.doc_id AND words.i BETWEEN r.i AND r.i + {n - 1}
  ) GROUP BY doc_id
)"""
    for n in quality.COVER_PERCENT
)
_REPEATED = "".join(
    f""", repeated_{n} AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM (
      SELECT doc_id, i, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM split WHERE len(w) >= {n})
    )
  ) WHERE c >= 2
)"""
    for n in quality.COVER_PERCENT
)
_QUALITY = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM docs
), words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, length(unnest(w)) AS chars FROM split
){_REPEATED}{_COVERS}, repeat_words AS (
  SELECT doc_id, count(*) AS c FROM words WHERE EXISTS (
    SELECT 1 FROM repeated_5 r WHERE r.doc_id = words.doc_id AND words.i BETWEEN r.i AND r.i + 4
  ) GROUP BY doc_id
), text_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs
), line_counts AS (
  SELECT doc_id, line, count(*) - 1 AS again FROM text_lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL
), dup_lines AS (
  SELECT doc_id, sum(again) AS c, sum(again * length(line)) AS chars FROM line_counts GROUP BY doc_id
), counted AS (
  SELECT d.doc_id, length(d.text) AS n_chars, len(s.w) AS n_words,
    coalesce(list_sum(list_transform(s.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(l.c, 0)::BIGINT AS n_dup_lines, coalesce(r.c, 0)::BIGINT AS n_repeat_words,
    coalesce(l.chars, 0)::BIGINT AS dup_line_chars,
    {", ".join(f"coalesce(c{n}.c, 0)::BIGINT AS cover_{n}" for n in quality.COVER_PERCENT)}
  FROM docs d JOIN split s USING (doc_id) LEFT JOIN dup_lines l USING (doc_id) LEFT JOIN repeat_words r USING (doc_id)
  {" ".join(f"LEFT JOIN cover_{n} c{n} USING (doc_id)" for n in quality.COVER_PERCENT)}
), judged AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.BASE_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * dup_line_chars <= {quality.LINE_PERCENT} * n_chars
  {" ".join(f"AND 100 * cover_{n} <= {p} * word_chars" for n, p in quality.COVER_PERCENT.items())} AS kept,
  dup_line_chars, {", ".join(f"cover_{n}" for n in quality.COVER_PERCENT)}
FROM judged
"""

_TOPK = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % {topk.EVERY} = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= {topk.K}
"""

_N = suffixes.LENGTH
_SUBSTRINGS = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h,
         octet_length(encode(coalesce(text, ''))) AS n
  FROM documents
), starts AS (
  SELECT rid, i, md5(substr(h, 2 * i + 1, {2 * _N})) AS w
  FROM (SELECT rid, h, unnest(range(n - {_N - 1})) AS i FROM docs WHERE n >= {_N})
), repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY w) AS c FROM starts) WHERE c > 1
), numbered AS (
  SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS island FROM (
    SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + {_N} THEN 0 ELSE 1 END AS fresh FROM repeated
  )
), spans AS (
  SELECT rid, min(i) AS a, max(i) + {_N} AS b FROM numbered GROUP BY rid, island
), gaps AS (
  SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM spans
), kept AS (
  SELECT rid, sum(b - a) AS removed, count(*) AS runs,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest
  FROM gaps JOIN docs USING (rid) GROUP BY rid
)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""

_PARAGRAPHS = f"""
WITH RECURSIVE lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS paragraph
  FROM documents WHERE text IS NOT NULL
), placed AS (
  SELECT *, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY paragraph) - length(line) - 1)::BIGINT AS start,
         list_filter(regexp_split_to_array(translate(line, '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM lines
), paragraphs AS (
  SELECT row_number() OVER (ORDER BY doc_id, paragraph) AS id, doc_id, paragraph::INTEGER AS paragraph, start,
         start + length(line) AS "end", len(w)::INTEGER AS n_words, w
  FROM placed WHERE len(w) >= {paragraphs.MIN_WORDS}
), grams AS (
  SELECT DISTINCT id, array_to_string(list_slice(w, i, i + {paragraphs.SHINGLE_WORDS - 1}), ' ') AS gram
  FROM (SELECT id, w, unnest(range(1, len(w) - {paragraphs.SHINGLE_WORDS - 2})) AS i FROM paragraphs)
), sizes AS (SELECT id, count(*) AS n FROM grams GROUP BY id),
linked AS (
  SELECT x.id AS a, y.id AS b FROM grams x JOIN grams y ON x.gram = y.gram AND x.id <> y.id
  JOIN sizes sx ON sx.id = x.id JOIN sizes sy ON sy.id = y.id
  GROUP BY x.id, y.id, sx.n, sy.n HAVING count(*) >= {paragraphs.SIMILARITY} * (sx.n + sy.n - count(*)) - 1e-9
), reach AS (
  SELECT DISTINCT a, a AS b FROM linked UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
), classes AS (SELECT a AS id, min(b) AS first FROM reach GROUP BY a)
SELECT p.doc_id, p.paragraph, p.start, p."end", p.n_words, f.doc_id AS class_doc, f.paragraph AS class_paragraph,
       p.id <> f.id AS removed
FROM classes JOIN paragraphs p USING (id) JOIN paragraphs f ON f.id = classes.first
"""

_NEAR_TEXTS = f"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS id, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT id, array_to_string(list_slice(w, i, i + {sketches.SHINGLE_WORDS - 1}), ' ') AS gram
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - {sketches.SHINGLE_WORDS - 1}, 1) + 1)) AS i FROM texts WHERE len(w) > 0)
), sizes AS (SELECT id, count(*) AS n FROM grams GROUP BY id),
linked AS (
  SELECT x.id AS a, y.id AS b FROM grams x JOIN grams y ON x.gram = y.gram AND x.id <> y.id
  JOIN sizes sx ON sx.id = x.id JOIN sizes sy ON sy.id = y.id
  GROUP BY x.id, y.id, sx.n, sy.n HAVING 100 * count(*) >= {sketches.PERCENT} * (sx.n + sy.n - count(*))
), reach AS (
  SELECT id AS a, id AS b FROM texts UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
), classes AS (SELECT a AS id, min(doc_id) AS component_id FROM reach JOIN texts ON texts.id = reach.b GROUP BY a)
SELECT t.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, t.doc_id = c.component_id AS kept
FROM texts t JOIN classes c USING (id) LEFT JOIN sizes s USING (id)
"""

_PHRASES = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{phrases.NO_LANGUAGE}') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, (VALUES (1), (2), (3)) orders(k) WHERE len(w) >= k)
), counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
candidates AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND f >= {phrases.MIN_COUNT}
), cuts AS (
  SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r, (({phrases.SCALE}::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), covered AS (
  SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN (
    SELECT lang, a, array_to_string(w[1:2], ' ') AS inner_phrase FROM candidates WHERE k = 3
    UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM candidates WHERE k = 3
  ) t ON t.lang = s.lang AND t.inner_phrase = s.phrase WHERE 100 * t.a >= {phrases.COVER_PERCENT} * s.a
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best ANTI JOIN covered USING (lang, phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {phrases.TOP}
"""

ORACLE_SQL: dict[str, str] = {
    "op2_line_paragraphs": _PARAGRAPHS,
    "op8_suffix_dedup": _SUBSTRINGS,
    "op5_line_dedup": _LINE_DEDUP,
    "op7_quality_rules": _QUALITY,
    "op10_topk": _TOPK,
    "op11_fast_sketch_dedup": _NEAR_TEXTS,
    "op12_collocations": _PHRASES,
}
