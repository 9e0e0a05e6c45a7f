"""Exact top-k inner product search by norm-bucketed retrieval.

Vectors are turned into integers, floor(scale * x).  Candidates are grouped by
length into geometric buckets (a pure function of the squared norm, so at most a
few hundred); a bucket with many rows, for instance where a third of all vectors
are alike, is split by a hash of the id into parts of about ``PART_ROWS``.

For a query q with a known lower bound t of its k-th best score, a bucket whose
longest vector has length l can only matter at a cosine of t / (|q| * l) or more.
Above 1 the bucket is skipped.  At a high local threshold the bucket is pruned
by coordinates: a unit vector within that cosine of q lies in a known interval on
each of q's largest coordinates.  At a lower one it is pruned by length: only
vectors of length t / |q| or more remain.  What is left is verified by exact
inner products.  The first bound of each query comes from the ``SEEDS`` longest
candidates (a bounded set that is broadcast).

Queries are dealt into blocks of about ``BLOCK_ROWS`` by the length t / |q| that they need (one
quantile for each block comes to the driver), so a block of queries that need long vectors opens few buckets.
Only (candidate part, query block) pairs that some query of the block needs are formed, and both sides are
matched with the list of these pairs before any vector is copied.  Each pair is one group, so a task
holds two bounded arrays.  With no bound to prune by, every part meets every block.  Partial winners
(at most k for each query and group) are merged by a window per query.

Pruning works in floating point with a slack far above its rounding error; scores
are exact integers (binary floating point below 2**53, else Python integers).

Defined results: vectors that are NULL, empty or hold NULL, NaN or infinite
components take no part, as do NULL ids; vectors of different dimension do not meet;
an all-zero query scores 0 everywhere; ties go to the smaller id; rows that
repeat an id are one row each; extra columns are ignored.  Scores beyond a long
are cut to its range, and components beyond 1e300 (after scaling) count as that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut

SCALE = 1024
K = 10
PART_ROWS = 4096
BLOCK_ROWS = 2048
SEEDS = 2048
BUCKET_BASE = 1.1
FOCUS = 4  # coordinates used by coordinate pruning
COORDINATE_COSINE = 0.5  # local threshold from which coordinate pruning is used
SLACK = 1e-9
_LONG = 2**63 - 1
_LARGEST = 1e300


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id, v`` (floor(scale * x) as doubles), ``dim`` and ``norm``, valid rows only."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.coalesce(finite, F.lit(False)))
        .select(
            "vec_id",
            F.transform("embedding", lambda x: _floor(F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), x * scale)))).alias("v"),
            F.size("embedding").alias("dim"),
        )
        .withColumn("norm", _norm(F.col("v")))
    )


def _norm(v: Column) -> Column:
    """Length, by a scaled sum where squares could overflow."""
    peak = F.array_max(F.transform(v, F.abs))
    squares = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    scaled = F.aggregate(v, F.lit(0.0), lambda s, x: s + (x / peak) * (x / peak))
    return F.when(peak < 1e150, F.sqrt(squares)).otherwise(peak * F.sqrt(scaled))


def _floor(x: Column) -> Column:
    """floor() as a double; from 2**53 on a double is whole already."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def exact_products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued rows as longs."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * queries.shape[1]
    if bound < 2**53:
        return (queries @ candidates.T).astype(np.int64)
    big = [[sum(int(a) * int(b) for a, b in zip(q, c)) for c in candidates] for q in queries]
    return np.array([[max(-_LONG, min(_LONG, x)) for x in row] for row in big], dtype=np.int64).reshape(
        len(queries), len(candidates)
    )


class Part:
    """Candidates of one bucket part, by falling length."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, norms: np.ndarray):
        order = np.lexsort((ids, -norms))
        self.ids, self.v, self.norms = ids[order], v[order], norms[order]
        with np.errstate(invalid="ignore", divide="ignore"):
            self.unit = np.where(self.norms[:, None] > 0, self.v / self.norms[:, None], 0.0)

    def survivors(self, q: np.ndarray, q_norm: float, bound: float) -> np.ndarray:
        """Rows that can reach ``bound`` with the query ``q``."""
        n = len(self.ids)
        if bound <= 0 or q_norm == 0:
            return np.arange(n)
        cosine = bound / (q_norm * self.norms[0]) if self.norms[0] else math.inf
        if cosine > 1 + SLACK:
            return np.arange(0)
        if cosine < COORDINATE_COSINE:
            # Length pruning: a prefix of the rows.
            return np.arange(np.searchsorted(-self.norms, -(bound / q_norm) * (1 - SLACK), side="right"))
        unit_q = q / q_norm
        cosine = min(cosine, 1.0)
        keep = np.ones(n, dtype=bool)
        for f in np.argsort(-np.abs(unit_q))[:FOCUS]:
            x = unit_q[f]
            spread = math.sqrt(max(0.0, 1 - x * x) * (1 - cosine * cosine)) + 1e-7
            # Any c with cos(q, c) >= cosine keeps its coordinate within these, up to the pole.
            low = -math.inf if x <= -cosine else x * cosine - spread
            high = math.inf if x >= cosine else x * cosine + spread
            keep &= (self.unit[:, f] >= low) & (self.unit[:, f] <= high)
        return np.flatnonzero(keep)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _search(k: int):
    out = ["query_id", "vec_id", "score"]

    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(queries):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in out})
        part = Part(
            candidates["vec_id"].to_numpy(np.int64), np.stack(candidates["v"].to_numpy()), candidates["norm"].to_numpy()
        )
        found = []
        for q_id, q, q_norm, bound in zip(queries["vec_id"], queries["v"], queries["norm"], queries["bound"]):
            at = part.survivors(q, q_norm, -math.inf if bound is None or math.isnan(bound) else bound)
            if not len(at):
                continue
            scores = exact_products(q[None, :], part.v[at])[0]
            ids = part.ids[at]
            other = ids != q_id
            if not other.all():
                ids, scores = ids[other], scores[other]
            top = best(ids, scores, k)
            found.append((np.full(len(top), q_id), ids[top], scores[top]))
        if not found:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in out})
        return pd.DataFrame(dict(zip(out, map(np.concatenate, zip(*found)))))

    return search


def _first_bounds(vec_id: Column, v: Column, seeds, k: int) -> Column:
    """A lower bound of each query's k-th score: its k-th best among the seeds."""

    def bounds(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        by_dim: dict[int, list[int]] = {}
        ids, vectors = seeds.value
        for at, x in enumerate(vectors):
            by_dim.setdefault(len(x), []).append(at)
        matrices = {d: (np.asarray([ids[i] for i in at]), np.stack([vectors[i] for i in at])) for d, at in by_dim.items()}
        for q_ids, qs in batches:
            out = []
            for q_id, q in zip(q_ids, qs):
                scores = np.zeros(0)
                if len(q) in matrices:
                    rows, matrix = matrices[len(q)]
                    scores = exact_products(np.asarray(q)[None, :], matrix)[0][rows != q_id]
                out.append(float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None)
            yield pd.Series(out, dtype="float64")

    return F.pandas_udf(bounds, "double")(vec_id, v)


def _block_of(needing: DataFrame) -> Column:
    """Blocks of about ``BLOCK_ROWS`` queries with like needs; equal needs are spread by a tiny share of the id's hash."""
    blocks = -(-needing.count() // BLOCK_ROWS)
    if blocks < 2:
        return F.lit(0)
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) / F.lit(1e12)
    place = F.col("need") * (1 + spread) + spread
    at = [i / blocks for i in range(1, blocks)]
    edges = needing.agg(F.percentile_approx(place, at, 100_000).alias("edges")).first()["edges"]
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge < place))


def live_pairs(bounded: DataFrame, sizes: DataFrame) -> DataFrame:
    """``block, dim, bucket, part, longest``: the parts that the least demanding query of a block leaves open."""
    return (
        bounded.groupBy("block", "dim")
        .agg(F.min("need").alias("least"))
        .join(sizes, "dim")
        .where(F.col("least") <= F.col("longest") * (1 + 1e-6))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("block", "dim", "bucket", "part", "longest")
    )


def top_k(vectors: DataFrame, is_query: Column, *, k: int = K, scale: int = SCALE) -> DataFrame:
    """The ``k`` best-scoring other vectors of each query: ``query_id, rank, vec_id, score``.

    ``is_query`` selects the queries by ``vec_id``; every valid row is a candidate.
    """
    spark = vectors.sparkSession
    rows = cut(integer_vectors(vectors, scale).withColumn("bucket", _bucket(F.col("norm"))))
    # A few hundred rows for each dimension.
    sizes = cut(
        rows.groupBy("dim", "bucket").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("parts"), F.max("norm").alias("longest"))
    )
    queries = rows.where(is_query)
    seeds = rows.orderBy(F.desc("norm"), "vec_id").limit(SEEDS).select("vec_id", "v").collect()
    shared = spark.sparkContext.broadcast(([r.vec_id for r in seeds], [np.asarray(r.v) for r in seeds]))
    need = F.when(F.col("bound") > 0, F.col("bound") / F.greatest("norm", F.lit(1e-300)))
    needing = cut(
        queries.withColumn("bound", _first_bounds(F.col("vec_id"), F.col("v"), shared, k)).withColumn(
            "need", F.coalesce(need, F.lit(0.0))
        )
    )
    bounded = needing.withColumn("block", _block_of(needing)).select("vec_id", "v", "norm", "bound", "need", "block", "dim")
    dealt = rows.join(sizes.select("dim", "bucket", "parts"), ["dim", "bucket"]).withColumn(
        "part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts"))
    )
    live = cut(live_pairs(bounded, sizes))
    left = dealt.select("vec_id", "v", "norm", "dim", "bucket", "part").join(live.select("dim", "bucket", "part", "block"), ["dim", "bucket", "part"])
    # A query meets the open parts of its block that its own bound leaves open.
    right = (
        bounded.join(live, ["dim", "block"])
        .where(F.col("need") <= F.col("longest") * (1 + 1e-6))
        .select("vec_id", "v", "norm", "bound", "block", "dim", "bucket", "part")
    )
    keys = ["dim", "bucket", "part", "block"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.toDF(*right.columns).groupBy(*keys))  # both come from one table: new attributes
        .applyInPandas(_search(k), "query_id bigint, vec_id bigint, score bigint")
    )
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_query).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _bucket(norm: Column) -> Column:
    """Geometric length bucket: BUCKET_BASE ** bucket <= norm < BUCKET_BASE ** (bucket + 1)."""
    return F.when(norm < 1, F.lit(-1)).otherwise(F.floor(F.log(norm) / math.log(BUCKET_BASE))).cast("int")
