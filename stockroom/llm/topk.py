"""Exact top-k inner products (operator 10), by descending vector length.

Vectors become integers, floor(1024 * x), and are stored sorted by length.  A
rotation from the singular value decomposition of a bounded sample moves most
of their weight into the first coordinates.  Queries are searched in blocks of
bounded size: every task goes through its files, each from the longest vector
down, passes over batches and queries for which the product of the lengths
(Cauchy-Schwarz) cannot reach the k-th best score, bounds the rest by the product over the first rotated coordinates
plus the product of the residual lengths, and computes the integer products of
what remains.  The k-th best over some of the longest vectors, found first,
starts every task with a good bound.  Bounds are compared with a margin for
rounding, scores are integers, so the result is exact whatever the sample.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without a vec_id, which no result could name; a
shorter vector counts as padded with zeros; rows with the query's own vec_id
are its own; repeated query rows are one query, repeated candidates count each;
an empty table gives an empty result; extra columns are not read.  Products
of large components are computed in unbounded integers; a score that does not
fit a long is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.llm.common import col, materialize, shuffle_partitions

SCALE = 1024
K = 10
EVERY = 100
# Rows sampled for the rotation, queries per block, vectors that start the bounds,
# and the share of coordinates in the partial product.
ROTATION_SAMPLE = 4096
QUERY_BLOCK = 2048
HEAD = 2048
PARTIAL = 0.25
_STEP = 1024


def as_integers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v, length2) of the vectors that take part; a component whose scaled value does not fit a long is an error."""
    v = col(vector)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.filter(col(vec_id).isNotNull() & v.isNotNull() & F.coalesce(whole, F.lit(False)))

    def whole_number(x: Column) -> Column:
        # floor to a long would clamp without a word
        y = x.cast("double") * scale
        too_large = F.raise_error(F.lit("a scaled component does not fit a long")).cast("bigint")
        return F.when(F.abs(y) >= F.lit(2.0**63), too_large).otherwise(F.floor(y))

    return kept.select(
        col(vec_id).cast("long").alias("vec_id"), F.transform(v, whole_number).alias("v")
    ).withColumn("length2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of int64, padded with zeros to ``width``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = np.asarray(vectors.flatten()).astype(np.int64)
    sizes = np.asarray(vectors.value_lengths()).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Rotated:
    """Queries or candidates with rotated first coordinates and residual lengths."""

    def __init__(self, exact: np.ndarray, rotation: np.ndarray, first: int):
        self.exact = exact
        self.most = int(np.abs(exact.astype(np.float64)).max(initial=0.0))
        turned = exact.astype(np.float64) @ rotation
        self.first = np.ascontiguousarray(turned[:, :first])
        self.rest = np.sqrt((turned[:, first:] ** 2).sum(axis=1))
        self.length = np.sqrt((turned**2).sum(axis=1))


def _products(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Row by row integer inner products; ``most`` bounds the product of two components."""
    if most * a.shape[1] < 1 << 62:
        return np.einsum("ij,ij->i", a, b)
    wide = [sum(x * y for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
    if any(abs(x) >= 1 << 63 for x in wide):
        raise OverflowError("a score does not fit a long")
    return np.array(wide, np.int64)


class Search:
    """The k best candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, queries: Rotated, k: int, bound: np.ndarray | None = None):
        self.ids, self.queries, self.k = ids, queries, k
        n = len(ids)
        self.bound = np.full(n, -np.inf) if bound is None else bound.copy()
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._held = 0
        # relative rounding of the rotated products, generously
        self.margin = 1e-9 * queries.length

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, candidate id, score) of the k best per query; bounds follow them."""
        if not self.found:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty
        q, c, s = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.lexsort((c, -s, q))
        q, c, s = q[order], c[order], s[order]
        starts = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - starts
        kept = rank < self.k
        last = rank == self.k - 1
        self.bound[q[last]] = np.maximum(self.bound[q[last]], s[last])
        self.found = [(q[kept], c[kept], s[kept])]
        self._held = int(kept.sum())
        return self.found[0]

    def open(self, length: float) -> np.ndarray:
        """Queries that a vector of this length could still serve."""
        return np.flatnonzero((self.queries.length + self.margin) * length * (1 + 1e-9) >= self.bound)

    def add(self, ids: np.ndarray, candidates: Rotated) -> None:
        """Look at candidates that come by descending length."""
        for i in range(0, len(ids), _STEP):
            some = slice(i, i + _STEP)
            lengths = candidates.length[some]
            live = self.open(float(lengths.max(initial=0.0)))
            if not len(live):
                continue
            q = self.queries
            upper = q.first[live] @ candidates.first[some].T
            upper += q.rest[live][:, None] * candidates.rest[some][None, :]
            upper += (self.margin[live][:, None] + 1e-9 * q.length[live][:, None]) * lengths[None, :] + 1e-6
            pick, at = np.nonzero(upper >= self.bound[live][:, None])
            qs, cs = live[pick], at + i
            other = self.ids[qs] != ids[cs]
            qs, cs = qs[other], cs[other]
            for j in range(0, len(qs), 1 << 18):
                a, b = qs[j : j + (1 << 18)], cs[j : j + (1 << 18)]
                score = _products(q.exact[a], candidates.exact[b], q.most * candidates.most)
                good = score >= self.bound[a]
                self.found.append((a[good], ids[b[good]], score[good]))
                self._held += int(good.sum())
            if self._held > 4 * self.k * len(self.ids):
                self.best()


def search(
    vectors: DataFrame, queries: DataFrame, k: int = K, block: int = QUERY_BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of ``vectors`` per row of ``queries``.

    Both hold (vec_id, v, length2) as ``as_integers`` gives them.
    """
    spark = vectors.sparkSession
    out_schema = "query_id bigint, query_row bigint, vec_id bigint, score bigint"
    tasks = shuffle_partitions(spark)
    by_length = vectors.repartitionByRange(tasks, F.desc("length2"), "vec_id").sortWithinPartitions(F.desc("length2"), "vec_id")
    stored = materialize(by_length, "by-length")
    asked = materialize(
        queries.select("vec_id", "v").distinct().withColumn("query_row", F.xxhash64("vec_id", "v")), "queries"
    )
    width = max(stored.agg(F.max(F.size("v"))).first()[0] or 1, asked.agg(F.max(F.size("v"))).first()[0] or 1, 1)
    count = stored.count()
    # a Bernoulli sample: about ROTATION_SAMPLE rows reach the driver
    sample = stored.select("v", "length2").sample(min(1.0, ROTATION_SAMPLE / max(count, 1)), 10).toArrow()
    example = _matrix(sample["v"], width).astype(np.float64)
    rotation = np.linalg.svd(example.T @ example)[0] if len(example) else np.eye(width)
    first = max(1, int(width * PARTIAL))
    # HEAD rows at most, of about the longest: any rows give valid bounds
    lengths = np.sort(np.asarray(sample["length2"]))[::-1]
    least = float(lengths[min(len(lengths) - 1, HEAD * len(lengths) // max(count, 1))]) if len(lengths) else 0.0
    head = stored.filter(F.col("length2") >= least).select("vec_id", "v").take(HEAD)
    head_ids = np.array([r["vec_id"] for r in head], np.int64)
    head_rows = Rotated(_matrix(pa.array([r["v"] for r in head], pa.list_(pa.int64())), width), rotation, first)

    total = asked.count()
    blocks = -(-total // block)
    results = spark.createDataFrame([], out_schema)
    for number in range(blocks):
        # a block holds about ``block`` queries: a fixed size, sent to every task
        part = asked.filter(F.pmod(F.xxhash64("query_row"), F.lit(blocks)) == number).toArrow()
        ids, rows = np.asarray(part["vec_id"]), np.asarray(part["query_row"])
        exact = _matrix(part["v"], width)
        start = Search(ids, Rotated(exact, rotation, first), k)
        start.add(head_ids, head_rows)
        start.best()
        bound = start.bound

        def scan(batches: Iterator[pa.RecordBatch], ids=ids, rows=rows, exact=exact, bound=bound) -> Iterator[pa.RecordBatch]:
            here = Search(ids, Rotated(exact, rotation, first), k, bound)
            for batch in batches:
                # order holds within a file only, and a task reads several: later batches may be longer
                if not len(here.open(float(np.sqrt(np.asarray(batch.column(2)).max(initial=0.0))))):
                    continue
                here.add(np.asarray(batch.column(0)), Rotated(_matrix(batch.column(1), width), rotation, first))
            q, c, s = here.best()
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (ids[q], rows[q], c, s)],
                names=["query_id", "query_row", "vec_id", "score"],
            )

        got = stored.select("vec_id", "v", "length2").mapInArrow(scan, out_schema)
        results = results.unionAll(materialize(got, "block-results") if blocks > 1 else got)
    ranked = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (
        results.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_rows(vectors: DataFrame) -> DataFrame:
    """The digest of the contract: queries are the rows whose vec_id is divisible by 100."""
    rows = as_integers(vectors.select("vec_id", "embedding"))
    return search(rows, rows.filter(F.col("vec_id") % EVERY == 0))
