"""Conversation prefix trie by range minima over sorted common prefixes.

A conversation is its sequence of turns (role, text).  The nodes of the trie are the
distinct prefixes of all conversations, from the root (no turn) down.  The method:

* conversations are sorted by their sequence of turn digests, equal ones by id.  The
  members of a prefix are then one interval of the order, and ``L[i]``, the number of
  leading turns that conversation i shares with the one before it, tells where it ends;
* every (i, d) with d > L[i] is a candidate prefix.  Its right extent, and the left
  extent of the prefix one turn shorter (its parent), are found by binary search on a
  sparse table of minima over ``L``, each candidate on its own: there is no stack and no
  order between candidates, so a block's candidates are searched as one array.
  Further sparse tables and prefix sums over the candidates (which come in preorder)
  give the smallest member and the sums over subtrees.

Blocks.  The sorted order is cut by range partitioning on (sequence, id) into blocks of
about ``BLOCK_ROWS`` conversations; the id splits a conversation that a third of all rows
repeat.  Only the prefixes of a block's last conversation can go on in the next block.
For these *open* prefixes, and for those that enter a block, each block writes one
summary row for each depth; an entering prefix belongs to the last block that opened one
of its depth, and totals are sums over these rows.  The tables that join blocks hold a few
rows for each block and depth, never rows of all conversations.

The hash over a node's ends is sequential by definition.  Ends inside one block are hashed
there; those of a sequence that crosses blocks travel as one string for each block,
and one task feeds them to the hash in order, holding one string at a time.

Defined results: NULL ``conv_id`` takes no part; NULL role or text is empty; a NULL turn
number comes first, turns with one number in the order of their digests; verbatim repeated
rows are turns of their own.  Turns are told apart by the 128-bit digest of role and text, so texts of
any length take part with all their characters.  A conversation's digests (16 bytes a turn) must fit in a row.
Other columns are ignored.  No conversation gives no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import written

BLOCK_ROWS = 65_536
WIDTH = 16  # bytes of a turn's digest
NO_ENDS = hashlib.sha256(b"").hexdigest()

# A block's rows: its own prefixes ("node"), the part that it holds of prefixes opened
# earlier ("in"), and lists of ends that touch its first or last conversation ("ends").
# side: of a node, where its parent is ("local", or an "in" or "out" prefix of this block);
# of ends, whether the prefix is an "in" or "out" one.
_PARTS = (
    "kind string, block bigint, depth bigint, closed boolean, conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved bigint, last_length bigint, side string, parent_conv_id bigint, ends string"
)


def turn_sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as (turn, digest, length) structs."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    one = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            "turn",
            F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
            F.length(text).alias("length"),
        ).alias("one"),
    )
    return one.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


class RangeMinimum:
    """Minima of any range of an array, from those of all ranges of 2**k elements."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= self.n:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The minimum of values[low..high], both ends included."""
        out = np.empty(len(low), dtype=self.levels[0].dtype)
        power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(power):
            at = np.flatnonzero(power == k)
            level = self.levels[k]
            out[at] = np.minimum(level[low[at]], level[high[at] - (1 << k) + 1])
        return out

    def right_extent(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last r with values[at+1..r] >= bound."""
        r = at.copy()
        for k in reversed(range(len(self.levels))):
            step = 1 << k
            fits = r + step < self.n
            fits &= self.levels[k][np.minimum(r + 1, self.n - step)] >= bound
            r[fits] += step
        return r

    def left_extent(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first l with values[l+1..at] >= bound."""
        left = at.copy()
        for k in reversed(range(len(self.levels))):
            step = 1 << k
            fits = left >= step
            fits &= self.levels[k][np.maximum(left - step + 1, 0)] >= bound
            left[fits] -= step
        return left


def common_turns(a: bytes, b: bytes) -> int:
    """The number of leading turns that two sequences share."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    if a[: high * WIDTH] == b[: high * WIDTH]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * WIDTH : mid * WIDTH] == b[low * WIDTH : mid * WIDTH]:
            low = mid
        else:
            high = mid
    return low


def _block_parts(table: pa.Table) -> pa.Table:
    """The rows of ``_PARTS`` for one block (its conversations, and the sequence before them)."""
    block = table["block"][0].as_py()
    before = [s for s, first in zip(table["sequence"].to_pylist(), table["before"].to_pylist()) if first]
    table = table.filter(pc.invert(table["before"])).combine_chunks()
    sequences, ids = table["sequence"].to_pylist(), table["conv_id"].to_pylist()
    n = len(ids)
    order = sorted(range(n), key=lambda i: (sequences[i], ids[i]))
    sequences, conv = [sequences[i] for i in order], np.asarray(ids, dtype=np.int64)[order]
    lengths = table["lengths"].combine_chunks()
    length_at = lengths.offsets.to_numpy()[:-1][order].astype(np.int64)
    length_of = lengths.values.to_numpy(zero_copy_only=False)

    size = np.array([len(s) // WIDTH for s in sequences], dtype=np.int64)
    shared = np.array([common_turns(a, b) for a, b in zip([*(before or sequences[:1]), *sequences], sequences)], dtype=np.int64)
    if not before:
        shared[0] = -1  # the root begins here

    # Candidates in preorder: by conversation, then by depth.
    first = np.concatenate([[0], np.cumsum(size - shared)])
    total = int(first[-1])
    start = np.repeat(np.arange(n), size - shared)
    depth = shared[start] + 1 + np.arange(total) - first[start]
    minima = RangeMinimum(shared)
    end = minima.right_extent(start, depth)
    closed = end < n - 1
    smallest_id = RangeMinimum(conv)
    smallest = smallest_id.between(start, end)
    n_convs = end - start + 1

    # Parents: the candidate before, or for a conversation's first one the prefix that it leaves.
    parent = np.arange(total) - 1
    leaving = np.flatnonzero((depth == shared[start] + 1) & (depth > 0))
    bound = depth[leaving] - 1
    left = minima.left_extent(start[leaving], bound)
    parent[leaving] = np.where(shared[left] >= bound, -2, first[left] + bound - shared[left] - 1)
    entering = parent == -2
    n_children = np.bincount(parent[parent >= 0], minlength=total)
    last_length = np.where(depth > 0, 0, 0)
    deep = depth > 0
    last_length[deep] = length_of[length_at[start[deep]] + depth[deep] - 1]

    leaf_sums = np.concatenate([[0], np.cumsum(closed & (n_children == 0))])
    saved_sums = np.concatenate([[0], np.cumsum(np.where(closed, (n_convs - 1) * last_length, 0))])
    after = first[end + 1]
    here = np.arange(total)

    ends = np.where(closed, NO_ENDS, None).astype(object)
    touching = []
    run_starts = np.flatnonzero(shared != size)
    if not len(run_starts) or run_starts[0] > 0:  # the first conversation repeats the one before the block
        stop = run_starts[0] if len(run_starts) else n
        touching.append(("in", size[0], ",".join(map(str, conv[:stop].tolist()))))
    id_texts = list(map(str, conv.tolist()))
    for s, stop in zip(run_starts.tolist(), [*run_starts[1:].tolist(), n]):
        joined = ",".join(id_texts[s:stop])
        if stop < n:
            node = first[s + 1] - 1
            if closed[node]:
                ends[node] = hashlib.sha256(joined.encode()).hexdigest()
                continue
        touching.append(("out", size[s], joined))

    side = np.where(entering, "in", "local").astype(object)
    local = parent >= 0
    side[local & ~closed[np.maximum(parent, 0)]] = "out"
    side[parent == -1] = "root"
    parent_conv = np.where(local, smallest[np.maximum(parent, 0)], 0)

    def part(kind, m, **given):
        columns = {"kind": np.full(m, kind, dtype=object), "block": np.full(m, block)} | given
        return pa.table([pa.array(columns[f.name], f.type, from_pandas=True) if f.name in columns else pa.nulls(m, f.type) for f in _ARROW], _ARROW)

    out = [
        part(
            "node", total, depth=depth, closed=closed, conv_id=smallest, n_convs=n_convs, n_children=n_children,
            n_leaves=leaf_sums[after] - leaf_sums[here], saved=saved_sums[after] - saved_sums[here],
            last_length=last_length, side=side, ends=ends,
            parent_conv_id=pa.array(parent_conv, pa.int64(), mask=side != "local"),
        )
    ]
    if before:
        depths = np.arange(shared[0] + 1)
        zero = np.zeros(len(depths), dtype=np.int64)
        stop = minima.right_extent(zero, depths)
        out.append(
            part(
                "in", len(depths), depth=depths, closed=stop < n - 1, conv_id=smallest_id.between(zero, stop), n_convs=stop + 1,
                n_children=np.bincount(depth[entering] - 1, minlength=len(depths))[: len(depths)],
                n_leaves=leaf_sums[first[stop + 1]], saved=saved_sums[first[stop + 1]],
            )
        )
    if touching:
        sides, depths, texts = zip(*touching)
        out.append(part("ends", len(sides), side=np.array(sides, dtype=object), depth=np.array(depths), ends=np.array(texts, dtype=object)))
    return pa.concat_tables(out)


_ARROW = pa.schema(
    [
        (name, {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}[kind])
        for name, kind in (column.split() for column in _PARTS.split(", "))
    ]
)


def _hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the comma-joined strings of each (owner, depth), which come in order."""
    key, state = None, None

    def done():
        return pa.RecordBatch.from_pydict({"block": [key[0]], "depth": [key[1]], "ends": [state.hexdigest()]})

    for batch in batches:
        for owner, depth, text in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "ends"))):
            if (owner, depth) != key:
                if state is not None:
                    yield done()
                key, state = (owner, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
    if state is not None:
        yield done()


def trie_nodes(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie over ``sequences`` (``conv_id, turns`` as ``turn_sequences`` gives
    them; one row for each conversation):
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = sequences.sparkSession
    keyed = written(
        sequences.select(
            "conv_id",
            F.unhex(F.array_join(F.col("turns")["digest"], "")).alias("sequence"),
            F.col("turns")["length"].alias("lengths"),
        ),
        "conversations",
    )
    n_blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keyed.count() // BLOCK_ROWS))
    ordered = written(
        keyed.repartitionByRange(n_blocks, "sequence", "conv_id").withColumn("block", F.spark_partition_id().cast("long")),
        "sorted-conversations",
    )
    # The sequence before each block: one row for each block.
    lasts = ordered.groupBy("block").agg(F.max("sequence").alias("last"))
    before = lasts.select(
        "block", F.lag("last").over(Window.orderBy("block")).alias("sequence"), F.lit(True).alias("before")
    ).where("sequence is not null")
    blocks = ordered.withColumn("before", F.lit(False)).unionByName(before, allowMissingColumns=True)
    parts = written(blocks.groupBy("block").applyInArrow(_block_parts, _PARTS), "trie-blocks")
    return _joined(parts)


def _joined(parts: DataFrame) -> DataFrame:
    """All nodes, with the open ones completed from the later blocks."""
    nodes = parts.where("kind = 'node'")
    opened = nodes.where("not closed")
    entering = parts.where("kind = 'in'")

    # An entering prefix belongs to the last block that opened one of its depth.
    events = entering.withColumn("opener", F.lit(None).cast("long")).unionByName(opened.withColumn("opener", F.col("block")))
    in_order = Window.partitionBy("depth").orderBy("block", F.asc_nulls_first("opener"))
    owned = events.withColumn("owner", F.last("opener", ignorenulls=True).over(in_order)).where("kind = 'in'")
    owned = written(owned.drop("opener"), "trie-entering")

    members = owned.groupBy("owner", "depth").agg(
        F.sum("n_convs").alias("more_convs"), F.min("conv_id").alias("least_conv"), F.sum("n_children").alias("more_children")
    )
    counted = (
        opened.join(members.withColumnRenamed("owner", "block"), ["block", "depth"], "left")
        .withColumns(
            {
                "n_convs": F.col("n_convs") + F.coalesce("more_convs", F.lit(0)),
                "conv_id": F.least("conv_id", "least_conv"),
                "n_children": F.col("n_children") + F.coalesce("more_children", F.lit(0)),
            }
        )
        .withColumns(
            {
                "own_saved": (F.col("n_convs") - 1) * F.col("last_length"),
                "own_leaf": (F.col("n_children") == 0).cast("long"),
            }
        )
    )
    counted = written(counted.drop("more_convs", "least_conv", "more_children"), "trie-open")

    # Below an open prefix: what closed in its own block, the deeper open ones there, and the same
    # of every block it enters (the open ones only where it stays open itself).
    deeper = Window.partitionBy("block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    whole = counted.groupBy("block").agg(F.sum("own_saved").alias("open_saved"), F.sum("own_leaf").alias("open_leaves"))
    stays = (~F.col("closed")).cast("long")
    below = (
        owned.join(whole, "block", "left")
        .groupBy("owner", "depth")
        .agg(
            F.sum(F.col("saved") + F.coalesce(F.col("open_saved") * stays, F.lit(0))).alias("more_saved"),
            F.sum(F.col("n_leaves") + F.coalesce(F.col("open_leaves") * stays, F.lit(0))).alias("more_leaves"),
        )
        .withColumnRenamed("owner", "block")
    )
    ends = parts.where("kind = 'ends'")
    in_ends = ends.where("side = 'in'").select("block", "depth", "ends").join(owned.select("block", "depth", "owner"), ["block", "depth"])
    all_ends = (
        in_ends.unionByName(ends.where("side = 'out'").select("block", "depth", "ends", F.col("block").alias("owner")))
        .repartition("owner", "depth")
        .sortWithinPartitions("owner", "depth", "block")
    )
    hashes = all_ends.mapInArrow(_hash_in_order, "block bigint, depth bigint, ends string").withColumnRenamed("ends", "hash")
    complete = (
        counted.withColumns(
            {"n_leaves": F.col("n_leaves") + F.sum("own_leaf").over(deeper), "saved": F.col("saved") + F.sum("own_saved").over(deeper)}
        )
        .join(below, ["block", "depth"], "left")
        .join(hashes, ["block", "depth"], "left")
        .withColumns(
            {
                "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)),
                "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
                "ends": F.coalesce("hash", F.lit(NO_ENDS)),
            }
        )
        .select(*parts.columns)
    )

    # Parents that are open: by block, depth and side, so a root's many children meet in their own blocks.
    out_side = counted.select("block", "depth", F.lit("out").alias("side"), F.col("conv_id").alias("open_conv"))
    in_side = owned.select("block", "depth", "owner").join(
        counted.select(F.col("block").alias("owner"), "depth", F.col("conv_id").alias("open_conv")), ["owner", "depth"]
    ).select("block", "depth", F.lit("in").alias("side"), "open_conv")
    parents = out_side.unionByName(in_side).withColumn("depth", F.col("depth") + 1)
    every = nodes.where("closed").unionByName(complete)
    beside = every.where("side in ('local', 'root')")
    across = every.where("side in ('in', 'out')").join(parents, ["block", "depth", "side"]).withColumn("parent_conv_id", F.col("open_conv"))
    return beside.unionByName(across.select(*parts.columns)).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The prefix trie of the conversations in ``turns`` (conv_id, turn, role, text)."""
    return trie_nodes(turn_sequences(turns))


def with_shared_heads(sequences: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation c - c % group.

    h is crc32(c as text) % most; fewer turns there are all taken, none if there is no such
    conversation; c's own turns follow after its first h.
    """
    c = F.col("conv_id")
    heads = sequences.where(c % group == 0).select(
        c.alias("head_id"), F.slice("turns", 1, most - 1).alias("head")
    )
    h = (F.crc32(c.cast("string").cast("binary")) % most).cast("int")
    keyed = sequences.withColumns({"head_id": c - c % group, "h": h})
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return keyed.join(heads, "head_id", "left").select("conv_id", F.concat(head, own).alias("turns"))
