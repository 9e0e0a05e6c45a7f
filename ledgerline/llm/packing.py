"""Best-two-fit packing of token sequences into bins of a fixed length.

Each document's ids (with an end id) are cut into pieces of at most ``capacity``
tokens, the first piece taking the remainder.  Packing needs only the number of
pieces of each length: a histogram of at most ``capacity`` rows, which is all that
reaches the driver.  The plan is made on that histogram:

* fill greedily: a bin takes the longest remaining piece that fits, again and again;
* best-two-fit: the bin's smallest piece is replaced by the two remaining pieces
  that fill the gap it leaves more tightly, if there are two;
* a bin's pattern is repeated as long as the remaining counts allow, which is what
  the one-bin-at-a-time method would do, since its choices depend only on which
  lengths remain.

Each pattern uses up at least one length, so there are at most ``capacity`` patterns,
each of fewer than ``sqrt(2 * capacity)`` different lengths.  Pieces of one length are
interchangeable: they are numbered inside (length, salt) groups, and their number
decides bin and offset.

Defined results: a NULL text counts as empty (its only id is the end id); equal
texts and repeated rows are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut
from ledgerline.llm.tokenizers_cached import byte_level_encoder, public_path

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 0
ROWS_PER_GROUP = 20_000  # pieces numbered by one task at a time

_PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: the first takes the remainder."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _pieces(text: Column, path: str, capacity: int, end_id: int) -> Column:
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = byte_level_encoder(path)
        for texts in batches:
            rows = []
            for x in texts:
                ids = encoder.ids(x) + end
                rows.append(
                    [
                        (i, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]))
                        for i, (s, n) in enumerate(cut_points(len(ids) // 4, capacity))
                    ]
                )
            yield pd.Series(rows)

    return F.pandas_udf(pieces, _PIECES)(text)


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-two-fit on a histogram: patterns ([(length, times), ...] by length, bins)."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    while True:
        present = np.flatnonzero(left)
        if not len(present):
            return plan
        free = left.copy()
        bin_: list[int] = []
        gap = capacity
        while True:
            fits = present[: np.searchsorted(present, gap, side="right")]
            fits = fits[free[fits] > 0]
            if not len(fits):
                break
            length = int(fits[-1])
            times = min(gap // length, int(free[length]))
            bin_ += [length] * times
            free[length] -= times
            gap -= times * length
        if gap and len(bin_) > 1:
            smallest = bin_[-1]
            room = gap + smallest
            lengths = np.flatnonzero(free[:room])
            # For each a the longest b with a + b <= room; a pair of one length needs two pieces.
            best, pair = smallest, None
            for a in map(int, lengths):
                upto = lengths[: np.searchsorted(lengths, min(room - a, a), side="right")]
                if len(upto) and upto[-1] == a and free[a] < 2:
                    upto = upto[:-1]
                if len(upto) and a + int(upto[-1]) > best:
                    best, pair = a + int(upto[-1]), [a, int(upto[-1])]
            if pair:
                bin_ = bin_[:-1] + pair
        lengths, times = np.unique(np.asarray(bin_), return_counts=True)
        bins = int((left[lengths] // times).min())
        left[lengths] -= times * bins
        plan.append((list(zip(map(int, lengths), map(int, times))), bins))


def segments(plan: list[tuple[list[tuple[int, int]], int]]) -> dict[int, np.ndarray]:
    """For each length: rows (first number, times in a bin, first bin, first offset), by number."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    first_bin = 0
    for pattern, bins in plan:
        offset = 0
        for length, times in pattern:
            at = used.get(length, 0)
            rows.setdefault(length, []).append((at, times, first_bin, offset))
            used[length] = at + times * bins
            offset += times * length
        first_bin += bins
    return {length: np.asarray(r, dtype=np.int64) for length, r in rows.items()}


def _place(length: Column, number: Column, table) -> Column:
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        by_length = table.value
        for lengths, numbers in batches:
            out = np.zeros((2, len(lengths)), dtype=np.int64)
            lens, nums = lengths.to_numpy(), numbers.to_numpy()
            for n in np.unique(lens):
                mine = np.flatnonzero(lens == n)
                seg = by_length[int(n)]
                at = seg[np.searchsorted(seg[:, 0], nums[mine], side="right") - 1]
                nth = nums[mine] - at[:, 0]
                out[0, mine] = at[:, 2] + nth // at[:, 1]
                out[1, mine] = at[:, 3] + nth % at[:, 1] * n
            yield pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    return F.pandas_udf(place, "struct<sequence_id:bigint,offset:bigint>")(length, number)


def numbered(pieces: DataFrame, n_rows: int) -> DataFrame:
    """``pieces`` with ``number``: 0, 1, ... inside each length, without gaps.

    Groups are (length, salt), so a length that a third of all pieces share is
    numbered by many tasks.
    """
    salts = max(1, -(-n_rows // ROWS_PER_GROUP))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    offsets = (
        salted.groupBy("length", "salt")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            "before",
            F.coalesce(
                F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .drop("n")
    )
    local = salted.withColumn("local", F.row_number().over(order) - 1)
    return local.join(offsets, ["length", "salt"]).withColumn("number", F.col("before") + F.col("local"))


def pack_documents(
    docs: DataFrame, *, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    path = tokenizer_path or public_path(TOKENIZER)
    text = F.coalesce(F.col("text"), F.lit(""))
    pieces = cut(
        docs.select("doc_id", _pieces(text, path, capacity, end_id).alias("pieces")).select(
            # Not inline(): that infers a filter on the pieces, which would tokenize every text twice.
            "doc_id",
            F.inline_outer("pieces"),
        )
    )
    counts = {int(r.length): r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = docs.sparkSession.sparkContext.broadcast(segments(plan_bins(counts, capacity)))
    placed = numbered(pieces, sum(counts.values())).withColumn("at", _place(F.col("length"), F.col("number"), table))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
