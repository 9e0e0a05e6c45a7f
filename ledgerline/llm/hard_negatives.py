"""Hard-negative mining by coordinate pruning inside length buckets.

For every anchor the ``positives`` best rows of its own label are its positives.  For each
(anchor, positive) the ``k`` best rows of other labels are wanted whose score lies in a
band around the positive's: ``low * p <= 100 * score <= high * p`` (percent).  Both are
exact inner-product searches with a lower bound, done alike:

* vectors become integers, floor(scale * x), and are grouped by length into geometric
  buckets, which are cut by a hash of the row into parts of about ``PART_ROWS`` rows (a bucket,
  label or vector that a third of all rows share is many parts);
* an anchor q with lower bound t needs nothing from a bucket whose longest vector is
  shorter than t / |q|.  Anchors are dealt into blocks by that
  length (one quantile for each block comes to the driver), and only (part, block) pairs that some anchor of the block needs are formed: both
  sides are matched with the list of these pairs *before* any vector is copied;
* inside a part, unit vectors are indexed by a sorted list for each coordinate.  With the local
  threshold c = t / (|q| * longest), a unit vector within cosine c of q has on each
  coordinate a feasible range of values.  The ranges of q's ``FOCUS`` largest
  coordinates are cut from the sorted lists by binary search, the sets intersected
  by counting, and what is left is verified by exact integer products.

Lower bounds.  For positives: the anchor's own result among ``SEEDS`` rows, the longest ones (a
bounded set, broadcast).  For negatives: the lower ends of the bands, raised where the
seeds already hold ``k`` scores of a band.  Each pair of part and block returns at most
``positives`` rows, or ``k`` for each band, of an anchor, and a window merges them.

The work between anchors and rows is exact, so with no bound to prune by it is every anchor block
against every part; blocks and parts are of bounded size, and nothing is dropped.

Defined results: rows with a NULL id, label or vector, with an empty vector or one with NULL or non-finite
components take no part; vectors of different dimension do not meet; ties go to the
smaller id; rows that repeat an id are one row each, never each other's positive or negative, and each
of them that is an anchor has its own results; a positive with a negative score has no negatives (its
band is empty), one with score 0 those with score 0.  Scores beyond a long are cut to its range.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import written
from ledgerline.llm.topk import exact_products

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # band of a negative's score, in percent of the positive's
PART_ROWS = 32_768
BLOCK_ROWS = 32_768
SEEDS = 2048
BUCKET_BASE = 1.1
FOCUS = 5
SLACK = 1e-9
_LARGEST = 1e300


def prepared(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """``row, vec_id, label, v, dim, norm, bucket`` of the rows that take part."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)  # noqa: E731  a double is whole from there on
    rows = (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            label.alias("label"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        )
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0))
        .where(F.coalesce(usable, F.lit(False)))
        .select(
            "vec_id",
            "label",
            F.transform("embedding", lambda x: whole(F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), x * scale)))).alias("v"),
        )
    )
    # The length by a scaled sum: squares of large components do not overflow.
    peak = F.array_max(F.transform("v", F.abs))
    spread = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("peak")) * (x / F.col("peak"))))
    return (
        rows.withColumn("peak", peak)
        .withColumn("norm", F.when(F.col("peak") == 0, 0.0).otherwise(F.col("peak") * spread))
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            "label",
            "v",
            F.size("v").alias("dim"),
            "norm",
            F.when(F.col("norm") < 1, -1).otherwise(F.floor(F.log("norm") / math.log(BUCKET_BASE))).cast("int").alias("bucket"),
        )
    )


class CoordinateLists:
    """Unit vectors of one part, with a sorted list of values for each focus coordinate."""

    def __init__(self, v: np.ndarray, norms: np.ndarray):
        self.longest = float(norms.max(initial=0.0))
        with np.errstate(invalid="ignore", divide="ignore"):
            self.unit = np.where(norms[:, None] > 0, v / norms[:, None], 0.0)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def candidates(self, q: np.ndarray, q_norm: float, bound: float) -> np.ndarray:
        """Rows that can have an inner product of ``bound`` or more with ``q``."""
        n = len(self.unit)
        if bound <= 0 or q_norm == 0:
            return np.arange(n) if bound <= 0 else np.arange(0)
        cosine = bound / q_norm / self.longest if self.longest else math.inf
        if cosine > 1 + SLACK:
            return np.arange(0)
        cosine = min(cosine, 1.0)
        unit_q = q / q_norm
        met, wanted = np.zeros(n, dtype=np.int8), 0
        for f in np.argsort(-np.abs(unit_q))[:FOCUS].tolist():
            x = unit_q[f]
            spread = math.sqrt(max(0.0, 1 - x * x) * (1 - cosine * cosine)) + 1e-7
            # Feasible values of the coordinate; beyond q's own pole there is no end.
            low = -math.inf if x <= -cosine else x * cosine - spread
            high = math.inf if x >= cosine else x * cosine + spread
            if low <= -1 and high >= 1:
                continue
            order, values = self.sorted_list(f)
            met[order[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]] += 1
            wanted += 1
        return np.flatnonzero(met == wanted)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores in order, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(scores) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _matrix(v: pd.Series) -> np.ndarray:
    return np.stack(v.to_numpy()).astype(np.float64, copy=False)


_POSITIVE = "anchor bigint, vec_id bigint, score bigint"
_NEGATIVE = "anchor bigint, slot int, vec_id bigint, score bigint"


def _frame(schema: str, found: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    if not found:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in names})
    return pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*found)))))


def _positives_in(k: int):
    def search(part: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(part) and len(anchors):
            ids, labels, v = part["vec_id"].to_numpy(), part["label"].to_numpy(), _matrix(part["v"])
            # Only rows of the anchor's label can be its positives: one index for each label.
            index = {x: np.flatnonzero(labels == x) for x in pd.unique(anchors["label"])}
            lists = {x: CoordinateLists(v[at], part["norm"].to_numpy()[at]) for x, at in index.items()}
            for row, q_id, label, q, norm, bound in anchors[["row", "vec_id", "label", "v", "norm", "bound"]].itertuples(index=False):
                at = index[label][lists[label].candidates(q, norm, -math.inf if math.isnan(bound) else bound)]
                at = at[ids[at] != q_id]
                if len(at):
                    scores = exact_products(q[None, :], v[at])[0]
                    top = _best(ids[at], scores, k)
                    found.append((np.full(len(top), row), ids[at][top], scores[top]))
        return _frame(_POSITIVE, found)

    return search


def _negatives_in(k: int):
    def search(part: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(part) and len(anchors):
            ids, labels, v = part["vec_id"].to_numpy(), part["label"].to_numpy(), _matrix(part["v"])
            lists = CoordinateLists(v, part["norm"].to_numpy())
            columns = ["row", "vec_id", "label", "v", "norm", "bound", "lows", "highs", "floors"]
            for row, q_id, label, q, norm, bound, lows, highs, floors in anchors[columns].itertuples(index=False):
                at = lists.candidates(q, norm, bound)
                at = at[(labels[at] != label) & (ids[at] != q_id)]
                if not len(at):
                    continue
                scores = exact_products(q[None, :], v[at])[0]
                inside = (scores >= bound) & (scores <= max(highs))
                at, scores = at[inside], scores[inside]
                order = np.lexsort((ids[at], -scores))
                falling, by_score = -scores[order], ids[at][order]
                for slot, (low, high, floor) in enumerate(zip(lows, highs, floors)):
                    begin = np.searchsorted(falling, -high, "left")
                    stop = min(begin + k, np.searchsorted(falling, -max(low, floor), "right"))
                    if begin < stop:
                        found.append((np.full(stop - begin, row), np.full(stop - begin, slot, dtype=np.int32), by_score[begin:stop], -falling[begin:stop]))
        return _frame(_NEGATIVE, found)

    return search


class _Seeds:
    """The broadcast seeds as matrices by dimension."""

    def __init__(self, rows):
        self.by_dim = {}
        for dim in {len(r.v) for r in rows}:
            own = [r for r in rows if len(r.v) == dim]
            self.by_dim[dim] = np.array([r.vec_id for r in own]), np.array([r.label for r in own]), np.array([list(r.v) for r in own])

    def scores(self, q_id, label, q, same: bool) -> np.ndarray:
        """The anchor's scores with the seeds of its own label, or of the others."""
        if len(q) not in self.by_dim:
            return np.zeros(0, dtype=np.int64)
        ids, labels, v = self.by_dim[len(q)]
        return exact_products(np.asarray(q)[None, :], v[((labels == label) == same) & (ids != q_id)])[0]


def _first_bounds(seeds, k: int):
    """For each anchor its k-th best score among seeds of its label (NULL: fewer)."""

    def bounds(vec_id: pd.Series, label: pd.Series, v: pd.Series) -> pd.Series:
        known, out = seeds.value, []
        for q_id, own, q in zip(vec_id, label, v):
            scores = known.scores(q_id, own, q, True)
            out.append(float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(bounds, "double")


def _band_floors(seeds, k: int):
    """For each band the k-th best score in it among the seeds of other labels, at least its low end."""

    def floors(vec_id: pd.Series, label: pd.Series, v: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.Series:
        known, out = seeds.value, []
        for q_id, own, q, low, high in zip(vec_id, label, v, lows, highs):
            scores = known.scores(q_id, own, q, False)
            found = []
            for a, b in zip(low, high):
                inside = scores[(scores >= a) & (scores <= b)]
                found.append(int(np.partition(inside, len(inside) - k)[len(inside) - k]) if len(inside) >= k else int(a))
            out.append(found)
        return pd.Series(out)

    return F.pandas_udf(floors, "array<bigint>")


def _blocks(anchors: DataFrame) -> Column:
    """Blocks of about ``BLOCK_ROWS`` anchors with like needs: anchors that need long vectors only
    share blocks, which then open few buckets.  Equal needs are spread by a tiny share of the row's hash."""
    n_blocks = -(-anchors.count() // BLOCK_ROWS)
    if n_blocks < 2:
        return F.lit(0)
    spread = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / F.lit(1e12)
    place = F.col("need") * (1 + spread) + spread
    shares = [i / n_blocks for i in range(1, n_blocks)]
    cuts = anchors.agg(F.percentile_approx(place, shares, 100_000).alias("cuts")).first()["cuts"]
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < place))


def _searched(rows: DataFrame, sizes: DataFrame, anchors: DataFrame, search, schema: str) -> DataFrame:
    """``search(part, anchors)`` over the pairs of part and anchor block that can hold a result."""
    need = F.when(F.col("bound") > 0, F.col("bound") / F.greatest(F.col("norm"), F.lit(1e-300))).otherwise(0.0)
    needing = written(anchors.drop("bucket").withColumn("need", F.coalesce(need, F.lit(0.0))), "anchors")
    blocked = needing.withColumn("block", _blocks(needing))
    live = (
        blocked.groupBy("block", "dim").agg(F.min("need").alias("need"))
        .join(sizes, "dim")
        .where(F.col("need") <= F.col("longest") * (1 + 1e-6))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("block", "dim", "bucket", "part")
    )
    live = written(live, "live-pairs")
    left = rows.select("vec_id", "label", "v", "norm", "dim", "bucket", "part").join(live, ["dim", "bucket", "part"])
    # An anchor meets the open buckets of its block that its own bound leaves open.
    open_parts = live.join(sizes.select("dim", "bucket", "longest"), ["dim", "bucket"])
    right = blocked.join(open_parts, ["block", "dim"]).where(F.col("need") <= F.col("longest") * (1 + 1e-6)).drop("longest")
    keys = ["dim", "bucket", "part", "block"]
    return left.groupBy(*keys).cogroup(right.toDF(*right.columns).groupBy(*keys)).applyInPandas(search, schema)


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    label: Column | None = None,
    positives: int = POSITIVES,
    k: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` selects the anchors by ``vec_id``; ``label`` (an integer or text expression over
    the input; by default its column ``label``) replaces the labels.
    """
    spark = vectors.sparkSession
    wide = prepared(vectors, F.col("label") if label is None else label, scale)
    rows = written(wide, "vectors")
    sizes = written(
        rows.groupBy("dim", "bucket").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("parts"), F.max("norm").alias("longest")),
        "buckets",
    )
    dealt = rows.join(sizes.select("dim", "bucket", "parts"), ["dim", "bucket"]).withColumn(
        "part", F.pmod(F.xxhash64("row"), F.col("parts"))
    )
    longest = rows.orderBy(F.desc("norm"), "vec_id", "row").limit(SEEDS).select("vec_id", "label", "v").collect()
    seeds = spark.sparkContext.broadcast(_Seeds(longest))

    anchors = rows.where(is_anchor)
    bound = _first_bounds(seeds, positives)("vec_id", "label", "v")
    found = _searched(dealt, sizes, anchors.withColumn("bound", bound), _positives_in(positives), _POSITIVE)
    best_first = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("slot", (F.row_number().over(best_first) - 1).cast("int")).where(F.col("slot") < positives)
    ranked = written(ranked.withColumnRenamed("vec_id", "positive_id").withColumnRenamed("score", "positive_score"), "positives")

    # Of every anchor its bands, in the order of its positives.
    score = F.col("positive_score").cast("decimal(20,0)")
    ends = ranked.select(
        "anchor",
        F.struct(
            "slot",
            F.ceil(score * low / 100).cast("long").alias("low"),
            F.floor(score * high / 100).cast("long").alias("high"),
        ).alias("band"),
    )
    bands = ends.groupBy("anchor").agg(F.sort_array(F.collect_list("band")).alias("bands"))
    banded = anchors.join(bands.withColumnRenamed("anchor", "row"), "row").withColumns(
        {"lows": F.col("bands")["low"], "highs": F.col("bands")["high"]}
    )
    floors = _band_floors(seeds, k)("vec_id", "label", "v", "lows", "highs")
    # An anchor needs what its lowest band needs; empty bands need nothing.
    open_floors = F.filter(F.zip_with("floors", "highs", lambda f, h: F.when(f <= h, f)), lambda x: x.isNotNull())
    wanted = (
        banded.withColumn("floors", floors)
        .withColumn("bound", F.array_min(open_floors).cast("double"))
        .where(F.col("bound").isNotNull())
        .drop("bands")
    )
    met = _searched(dealt, sizes, wanted, _negatives_in(k), _NEGATIVE)
    in_band = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    negatives = met.withColumn("rank", F.row_number().over(in_band).cast("int")).where(F.col("rank") <= k)
    return (
        negatives.join(ranked, ["anchor", "slot"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
    )
