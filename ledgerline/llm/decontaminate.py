"""Benchmark decontamination: one word-level Aho-Corasick scan per text.

Test items become windows of ``window`` consecutive normalised words (a
shorter item is one window).  The windows form an Aho-Corasick automaton over
word numbers; each text is read once, left to right, and every occurrence of
every window is reported by the automaton's output links.  Word positions map
back to code point offsets of the original text.

Normalisation: A-Z in lower case; words are runs of ``[0-9a-z]`` and of
characters from U+0080 on.

The automaton lives in the tasks, so its size is bounded: the benchmark is
dealt by item into shards of about ``SHARD_BYTES`` of text, each with its own
automaton, and each text passes all shards inside one task (no shuffle).  An
item is never split, so a shard holds at most SHARD_BYTES plus its longest item.

Defined results: NULL and empty texts have no words and no hits; items that
are NULL, empty or lack words have no windows; equal items all count as hit;
an empty benchmark hits nothing; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 13
SHARD_BYTES = 4_000_000

# Bytes of UTF-8: letters in lower case, digits and non-ASCII stay, all else is a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(rb"[^\x20]+")

_SCAN = "struct<n_words:bigint,runs:array<struct<lo:int,hi:int>>,items:array<string>>"
_PLACE = "struct<n_hit:bigint,spans:array<struct<start:int,end:int>>>"


def benchmark_words(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


class Windows:
    """The automaton of a shard and the length of its shortest window."""

    def __init__(self, words, shortest: int):
        self.words, self.shortest = words, shortest


@lru_cache(maxsize=4)
def _automaton(items: tuple[tuple[str, str], ...], window: int):
    """(word numbers, automaton, item ids of each window number) of one shard."""
    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = {}
    for item_id, text in items:
        words = [numbers.setdefault(w, len(numbers) + 1) for w in benchmark_words(text)]
        for i in range(max(1, len(words) - window + 1) if words else 0):
            owners.setdefault(tuple(words[i : i + window]), set()).add(item_id)
    if not owners:
        return numbers, None
    words = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window_words, ids in owners.items():
        words.add_word(window_words, (len(window_words), tuple(sorted(ids))))
    words.make_automaton()
    return numbers, Windows(words, min(map(len, owners)))


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Inclusive word ranges, overlapping or touching ones joined."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def scan_words(words: list[bytes], numbers: dict[bytes, int], automaton) -> tuple[list[tuple[int, int]], set[str]]:
    """Hit word ranges and the items hit.

    A word of no item (number 0) sends the automaton back to its start, so it is run on the
    stretches between such words, and only on those as long as the shortest window.
    """
    if automaton is None or not words:
        return [], set()
    ids = np.zeros(len(words) + 2, dtype=np.int64)
    ids[1:-1] = np.fromiter(map(numbers.get, words, repeat(0)), dtype=np.int64, count=len(words))
    turns = np.flatnonzero(np.diff(ids != 0))
    starts, ends = turns[::2], turns[1::2]
    long = ends - starts >= automaton.shortest
    runs, items = [], set()
    for start, end in zip(starts[long].tolist(), ends[long].tolist()):
        for last, (length, owners) in automaton.words.iter(tuple(ids[start + 1 : end + 1].tolist())):
            items.update(owners)
            runs.append((start + last - length + 1, start + last))
            if len(runs) > 4096:
                runs = merge_runs(runs)
    return merge_runs(runs), items


def _scan(text: Column, shard, window: int) -> Column:
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        numbers, automaton = _automaton(shard.value, window)
        for texts in batches:
            rows = []
            for x in texts:
                words = benchmark_words(x) if x else []
                runs, items = scan_words(words, numbers, automaton)
                rows.append((len(words), runs, sorted(items)))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "items"])

    return F.pandas_udf(scan, _SCAN)(text)


def _place(text: Column, runs: Column) -> Column:
    """Hit words and code point spans of the word ranges ``runs``."""

    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, all_runs in batches:
            rows = []
            for x, found in zip(texts, all_runs):
                merged = merge_runs([(r["lo"], r["hi"]) for r in found]) if found is not None else []
                spans = []
                if merged:
                    data = x.encode()
                    at = [m.span() for m in _WORD.finditer(data.translate(_WORD_BYTES))]
                    # Code points before each byte: bytes that are not UTF-8 continuations.
                    before = np.concatenate(
                        ([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80, dtype=np.int64))
                    )
                    spans = [(int(before[at[lo][0]]), int(before[at[hi][1]])) for lo, hi in merged]
                rows.append((sum(hi - lo + 1 for lo, hi in merged), spans))
            yield pd.DataFrame(rows, columns=["n_hit", "spans"])

    return F.pandas_udf(place, _PLACE)(text, runs)


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Per row of ``docs``: its words, hit words, spans and items found in ``benchmark``.

    Returns the columns ``keep`` (default: ``doc_id``) and ``n_words``,
    ``n_hit``, ``spans`` (code points, end exclusive), ``item_ids`` (strings,
    sorted) and ``contaminated`` (at least one hit word and 5 % of the words).
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text")).where(
        "item_id is not null and text is not null"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item_id"), F.lit(shards)))
    broadcasts = [
        spark.sparkContext.broadcast(
            tuple(sorted((r.item_id, r.text) for r in dealt.where(F.col("shard") == s).collect()))
        )
        for s in range(shards)
    ]
    keep = keep or ["doc_id"]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").alias("text"))
    scanned = row.select("row", "text", *[_scan(F.col("text"), b, window).alias(f"s{i}") for i, b in enumerate(broadcasts)])
    names = [f"s{i}" for i in range(shards)]
    together = scanned.select(
        "row",
        "text",
        F.col("s0.n_words").alias("n_words"),
        F.concat(*[F.col(f"{n}.runs") for n in names]).alias("runs"),
        F.array_sort(F.array_distinct(F.concat(*[F.col(f"{n}.items") for n in names]))).alias("item_ids"),
    )
    hit = F.size("runs") > 0
    placed = together.withColumn("placed", _place(F.when(hit, F.col("text")), F.when(hit, F.col("runs"))))
    return placed.select(
        "row.*",
        "n_words",
        F.col("placed.n_hit").alias("n_hit"),
        F.col("placed.spans").alias("spans"),
        "item_ids",
        ((F.col("placed.n_hit") > 0) & (20 * F.col("placed.n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    names = {c.lower() for c in docs.columns}
    # The row travels as one struct, so clashing names in docs stay apart.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col("text").alias("text"))
    assert "text" in names
    found = benchmark_hits(packed, benchmark, keep=["document"], **options)
    return found.where(~F.col("contaminated")).select("document.*")
