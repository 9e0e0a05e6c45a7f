"""MinHash near-duplicates through a multi-index Hamming join.

A document is its set of distinct shingles (five consecutive words; fewer words make
one shingle).  Documents are linked when the Jaccard similarity of their sets is at
least ``percent`` / 100, and every component keeps its smallest id.

1. One row for each different set (a digest of the sorted shingles); exact copies
   follow their representative, the smallest id, and are never paired.
2. Each set gets ``HASHES`` MinHash values of ``BITS`` bits.  Of two sets with
   similarity s, a value differs with probability 1 - s.  The radius is the smallest
   number that at s = ``percent`` / 100 is exceeded by at most ``MISSED`` of the pairs:
   23 of 64 values for 0.85, 28 for 0.80.
3. Multi-index: the signature is split into ``radius // 2 + 1`` chunks (12 and 15).  If at
   most ``radius`` values differ, some chunk has at most one difference.  Each
   chunk is indexed once for each place that the difference may have (that value left
   out), so two chunks within one difference share a key: all pairs within the
   radius meet.
4. Pairs that met are judged by their signatures, and only those within the radius tie sets
   together.  First every set of a key is held against the key's smallest one (a star, so a
   group of copies costs one look for each member).  Keys whose other members still hang apart are then compared among
   these, in pairs of blocks of ``SIGNATURE_BLOCK`` sets; keys with the very same members count once.
   A task skips pairs that hang together already and returns fewer ties than it has sets.
   The components of these ties are the families: every pair within the radius lies in one,
   and sets that only share a key by chance do not.
5. A family is compared on full sets in pairs of bounded blocks.  A task ties each of its sets
   to the smallest one first, skips pairs that are connected already, and checks the
   others within the radius.  It returns the links that it used (fewer
   than its sets), never all pairs.  These links join exactly the sets that all
   links would join.

Defined results: NULL and empty texts have no shingles and are linked with nothing;
repeated texts are one set; rows that share an id are one document for linking; a
row with NULL id is linked with nothing, its component is NULL and it is kept; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, free_name, written
from ledgerline.llm.components import connected_components

WORDS = 5
PERCENT = 85
HASHES = 64
BITS = 16
MISSED = 1e-5
KEY_VALUES = 3  # fewer values of a key are shared by chance
SIGNATURE_BLOCK = 1024
BLOCK_SETS = 256
BLOCK_SHINGLES = 500_000
WORD_MEMO = 250_000

_ODD = (np.random.default_rng(20_011).integers(1, 2**63, size=HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = np.random.default_rng(20_012).integers(0, 2**63, size=HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.random.default_rng(20_013).integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)


def radius_of(percent: int) -> int:
    """Differing values that at most ``MISSED`` of the pairs with this similarity exceed."""
    differs = 1 - percent / 100
    beyond = 1.0
    for radius in range(HASHES):
        beyond -= comb(HASHES, radius) * differs**radius * (1 - differs) ** (HASHES - radius)
        if beyond <= MISSED:
            return radius
    return HASHES


def chunks_of(percent: int) -> int:
    """So many chunks that one of them has at most one of ``radius_of(percent)`` differences."""
    return radius_of(percent) // 2 + 1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose high bits depend on all bits."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(_words) > WORD_MEMO:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(1, len(h) - width + 1)
    total = np.full(n, min(len(h), width), dtype=np.uint64)
    for i in range(min(width, len(h))):
        total = total * np.uint64(31) + mix(h[i : i + n] * _PLACE[i])
    return np.unique(mix(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values, cut to BITS bits."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 1024):
        part = hashes[i : i + 1024, None] * _ODD
        part += _ADD
        np.minimum(low, part.min(axis=0), out=low)
    return (mix(low) >> np.uint64(64 - BITS)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """One key for each (chunk, place left out): rows of signatures to rows of HASHES keys."""
    values = mix(signatures.astype(np.uint64) * _PLACE[:HASHES] + _ADD)
    keys = np.empty_like(values)
    chunks = chunks_of(percent)
    chunk_of = np.arange(HASHES) * chunks // HASHES
    for c in range(chunks):
        mine = np.flatnonzero(chunk_of == c)
        whole = values[:, mine].sum(axis=1, dtype=np.uint64)
        for place in mine:
            keys[:, place] = mix(whole - values[:, place] + _PLACE[place])
    return keys.astype(np.int64)


def _signature_column(text: Column) -> Column:
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for x in texts:
                s = shingles(x)
                if len(s):
                    data = s.astype("<u8").tobytes()
                    rows.append((len(s), xxhash.xxh128_digest(data), signature(s).astype("<u2").tobytes()))
                else:
                    rows.append((0, None, None))
            yield pd.DataFrame(rows, columns=["n_shingles", "digest", "sig"])

    return F.pandas_udf(sign, "struct<n_shingles:bigint,digest:binary,sig:binary>")(text)


def _keys_column(sig: Column, percent: int) -> Column:
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sigs in batches:
            if len(sigs):
                matrix = np.frombuffer(b"".join(sigs), dtype="<u2").reshape(len(sigs), HASHES)
                yield pd.Series(list(chunk_keys(matrix, percent)))
            else:
                yield pd.Series([], dtype=object)

    return F.pandas_udf(keys, "array<bigint>")(sig)


def _shingles_column(text: Column, digest: Column) -> Column:
    """The sorted shingles of a text whose set has this digest, else NULL."""

    def all_shingles(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, digests in batches:
            data = [shingles(x).astype("<u8").tobytes() for x in texts]
            yield pd.Series(
                [d if xxhash.xxh128_digest(d) == bytes(of) else None for d, of in zip(data, digests)], dtype=object
            )

    # It reads both sides of the join, so it runs after it, on the joined rows only.
    return F.pandas_udf(all_shingles, "binary")(text, digest)


def block_links(ids, blocks, signatures: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what the qualifying pairs of one task connect.

    ``blocks`` holds one or two block numbers: pairs inside the one, or across the two.
    """
    order = np.argsort(ids, kind="stable")
    ids = [int(ids[i]) for i in order]
    blocks = np.asarray(blocks)[order]
    signatures = signatures[order]
    sets = [sets[i] for i in order]
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    across = len(np.unique(blocks)) > 1
    radius = radius_of(percent)
    root = np.arange(len(ids))  # flattened after each link
    links = []

    def similar(i: int, j: int) -> bool:
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)

    def tie(i: int, j: int) -> None:
        links.append((ids[i], ids[j]))
        a, b = sorted((int(root[i]), int(root[j])))
        root[root == b] = a

    for i in range(len(ids) - 1):
        rest = slice(i + 1, None)
        fits = 100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])
        near = fits & ((signatures[rest] != signatures[i]).sum(axis=1) <= radius)
        if across and i:  # the first ties to all, so that most pairs are connected already
            near &= blocks[rest] != blocks[i]
        for j in np.flatnonzero(near) + i + 1:
            if root[i] != root[j] and similar(i, int(j)):
                tie(i, int(j))
    return links


def signature_ties(ids, blocks, groups, signatures: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Ties that join, over one or two blocks, what all pairs of signatures within the radius join.

    ``groups`` numbers what hangs together already.
    """
    blocks = np.asarray(blocks)
    across = len(np.unique(blocks)) > 1
    root = np.unique(np.asarray(groups), return_inverse=True)[1]
    ties = []
    for i in range(len(ids) - 1):
        apart = root[i + 1 :] != root[i]
        if across:
            apart &= blocks[i + 1 :] != blocks[i]
        at = np.flatnonzero(apart) + i + 1
        for j in at[(signatures[at] != signatures[i]).sum(axis=1) <= radius].tolist():
            if root[i] != root[j]:
                ties.append((int(ids[i]), int(ids[j])))
                root[root == root[j]] = root[i]
    return ties


def _signatures_of(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["sig"]), dtype="<u2").reshape(len(rows), HASHES)


def _within_column(sig: Column, other: Column, percent: int) -> Column:
    """Whether two signatures differ in at most ``radius_of(percent)`` values."""
    radius = radius_of(percent)

    def within(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(c), dtype="<u2").reshape(len(c), HASHES) for c in (a, b))
        return pd.Series((x != y).sum(axis=1) <= radius, dtype=bool)

    return F.pandas_udf(within, "boolean")(sig, other)


def _by_task(group: str, links_of):
    """Rows arrive sorted by task (``group``, lo, hi); each task's rows are gathered, compared and let go."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        task = None

        def finish() -> pd.DataFrame:
            rows = pd.concat(held) if held else None
            links = links_of(rows) if rows is not None and len(rows) > 1 else []
            return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

        for batch in batches:
            if not len(batch):
                continue
            key = batch[group].astype(str) + "/" + batch["lo"].astype(str) + "/" + batch["hi"].astype(str)
            for now, rows in batch.groupby(key.to_numpy(), sort=False):
                if now != task:
                    yield finish()
                    held, task = [], now
                held.append(rows)
        yield finish()

    return compare


def _compare_signatures(percent: int):
    radius = radius_of(percent)

    def ties(rows: pd.DataFrame) -> list[tuple[int, int]]:
        return signature_ties(rows["node"].to_numpy(), rows["block"].to_numpy(), rows["tied"].to_numpy(), _signatures_of(rows), radius)

    return _by_task("key", ties)


def _compare_sets(percent: int):
    def links(rows: pd.DataFrame) -> list[tuple[int, int]]:
        sets = [np.frombuffer(s, dtype="<u8") for s in rows["shingles"]]
        return block_links(rows["node"].to_numpy(), rows["block"].to_numpy(), _signatures_of(rows), sets, percent)

    return _by_task("family", links)


def _block_pairs(rows: DataFrame, group: str, *values: str) -> DataFrame:
    """Each row once for each pair (``lo``, ``hi``) of its ``group``'s ``blocks`` that its own block is in."""
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(group, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", *values)
    )


def _linked(tasks: DataFrame, group: str, compare, parts: int) -> DataFrame:
    dealt = tasks.repartition(parts, group, "lo", "hi").sortWithinPartitions(group, "lo", "hi")
    return dealt.mapInPandas(compare, "a bigint, b bigint")


def met_sets(sets: DataFrame, percent: int) -> DataFrame:
    """``key, node, pivot, n``: the keys that two or more sets share, and their ``n`` sets.

    Of keys with the same sets (128 bits of their digests) one stays: they make the same pairs meet.
    """
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark = F.xxhash64("digest").alias("mark")
    # Dealt once, read twice: for the keys' ends and for their members.
    keyed = sets.select("node", mark, F.explode(_keys_column(F.col("sig"), percent)).alias("key")).repartition(parts, "key")
    ends = keyed.groupBy("key").agg(
        F.min("node").alias("pivot"),
        F.max("node").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.bit_xor("mark").alias("members"),
        F.bit_xor(F.xxhash64("mark", F.lit(1))).alias("members2"),
    )
    shared = ends.where("pivot != last").groupBy("pivot", "last", "n", "members", "members2").agg(F.min("key").alias("key"))
    return keyed.drop("mark").join(shared.select("key", "pivot", "n"), "key")


def candidate_families(sets: DataFrame, percent: int) -> DataFrame:
    """``node, family`` of the sets (``node, digest, sig``) that met another one within the radius.

    Families are the components of all pairs that share a key and lie within the radius.
    """
    met = written(met_sets(sets, percent), "met")
    signed = sets.select("node", "sig")
    star = met.where("node != pivot").select("node", "pivot").distinct()
    judged = star.join(signed, "node").join(signed.toDF("pivot", "pivot_sig"), "pivot")
    tied = connected_components(
        judged.where(_within_column(F.col("sig"), F.col("pivot_sig"), percent)).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    )
    tied = written(tied, "tied")
    # All pairs with the pivot are judged.  The others of a key matter where they hang apart.
    others = met.where("n > 2 and node != pivot").join(tied, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("tied")
    )
    apart = (
        others.groupBy("key")
        .agg(F.min("tied").alias("low"), F.max("tied").alias("high"), F.ceil(F.count(F.lit(1)) / SIGNATURE_BLOCK).alias("blocks"))
        .where("low != high")
        .select("key", "blocks")
    )
    tasks = _block_pairs(others.join(apart, "key").join(signed, "node"), "key", "sig", "tied")
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = _linked(tasks, "key", _compare_signatures(percent), parts)
    stars = tied.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(stars.union(more)).withColumnRenamed("component", "family")


def near_duplicates(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    if percent > 100 or HASHES // chunks_of(percent) - 1 < KEY_VALUES:
        raise ValueError(f"at {percent} percent keys would have fewer than {KEY_VALUES} values")
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    signed = cut(plain.select("doc_id", _signature_column(F.col("text")).alias("s")).select("doc_id", "s.*"))
    sets = cut(
        signed.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
    )
    families = cut(candidate_families(sets, percent))
    members = families.join(sets.select("node", "digest", "sig", "n_shingles"), "node")
    blocks = members.groupBy("family").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).alias("blocks")
    )
    # The set itself is rebuilt from the text, for members of families only.
    full = (
        plain.join(members.select(F.col("node").alias("doc_id"), "family", "sig", "digest"), "doc_id")
        .withColumn("shingles", _shingles_column(F.col("text"), F.col("digest")))
        .where("shingles is not null")  # else another row with the same id
        .select(F.col("doc_id").alias("node"), "family", "sig", "shingles")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = _linked(_block_pairs(full.join(blocks, "family"), "family", "sig", "shingles"), "family", _compare_sets(percent), parts)
    component = connected_components(links)
    named = sets.select("digest", "node").join(component, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component")
    )
    linkable = F.col("doc_id").isNotNull()
    return (
        signed.withColumn("linkable", F.when(linkable, F.col("digest")))
        .join(named.withColumnRenamed("digest", "linkable"), "linkable", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_duplicates(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of near duplicates, with all their columns.

    Every row is a document of its own here, also where ids repeat: rows of different texts do not
    hang together by an id, and verbatim repeats are near duplicates.  Of a group the row with the smallest
    id stays.  Rows with NULL id and texts without words are in no group and stay.
    """
    row = free_name(docs, "row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    grouped = numbered.where("doc_id is not null").select(F.col(row).alias("doc_id"), "text")
    found = cut(near_duplicates(grouped, percent=percent).select(F.col("doc_id").alias("r"), "component_id"))
    several = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
    members = found.join(several, "component_id").join(numbered.select(F.col(row).alias("r"), "doc_id"), "r")
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "r")).alias("first"))
    gone = members.join(first, "component_id").where(F.col("r") != F.col("first.r")).select(F.col("r").alias("gone"))
    return numbered.join(gone, numbered[row] == gone["gone"], "left_anti").drop(row)
