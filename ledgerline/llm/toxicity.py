"""Toxicity scores on text restored by a noisy-channel decoder.

*Language model.*  Character trigrams counted over all training texts.

*Channel.*  A token that holds digits or symbols beside letters, or a letter three
times in a row, may be a disguised word.  Its characters become a lattice: a symbol
reads as one of the letters that it imitates or as nothing (punctuation between
letters); of a run of equal letters one or two may be meant.  Three or more single
characters in a row ("i d i o t!") are one lattice, too: each gap between them reads as
a border or as nothing, so that the stretch becomes one word or several.  Viterbi decoding
finds the path with the lowest cost, the sum of channel costs and of the trigram
model's negative log-probabilities.  A plain token has one path only, itself.

*Score.*  Features of a restored word are the word and its first 4, 5 and 6 letters
(compounds).  Documents are counted by feature and label over all labelled
training rows (one merge join on the id at every size, so the plan does not change with
the input); all features with significant positive evidence (likelihood ratio above
``MIN_G``) get their log odds, and a document's score is the logistic of the prior
plus the log odds of the distinct features that it has.  Up to ``BROADCAST_FEATURES`` weights
are broadcast, by their counted number; a larger model stays a table that is joined with the
documents' features.  Both ways give the same scores.

Tokens recur, so each Python worker remembers their decoded features.

Defined results: NULL and empty texts score the prior; rows with NULL label are not
learned from; with no labelled rows every score is 0; a row that several labels
match is learned once for each; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, fold

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SIZE = 64  # symbols of the character model: 0 border, letters, 63 any other letter
MIN_G = 20.0
BROADCAST_FEATURES = 2_000_000  # weights up to here are broadcast (some 200 MB), more are joined
MEMO = 300_000
CHANNEL_COST = 1.5  # of reading a symbol as a letter
DROP_COST = 1.0  # of reading a symbol as nothing
BORDER_COST = 1.0  # of reading a gap between single characters as a border
REPEAT_COST = 0.7  # of reading a run of letters as shorter than it is

# Letters that digits and symbols commonly stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l", "¡": "i",
}

_SYMBOL = {ch: i + 1 for i, ch in enumerate(LETTERS)}
_DISGUISED = re.compile(r"(?=.*[^\W\d_])(?:.*[\W\d_]|.*([^\W\d_])\1\1)", re.S)
_EDGE = re.compile(r"^[^\w@$!|+€£¡*]+|([.,;:!?)\]}\"'»&%#*=_/\\-]|(.)\2\2+)+$", re.S)
_ONE = r"[^\W_]|[@$!|+€£¡(]"
_SPACED = re.compile(rf"(?<![^\s(\[{{\"'])(?:(?:{_ONE})(?:\s+|[._*-])){{2,}}(?:{_ONE})(?=[.,;:!?)\]}}\"'…]*(?:\s|$))")
_TRIPLE = re.compile(r"(.)\1\1")
_FILLER = re.compile(r"\s+|[._*-]")
_REPEATED_TAIL = re.compile(r"([^\w])\1\1+$")


def _symbols_table() -> np.ndarray:
    table = np.zeros(0x10000, dtype=np.uint8)
    for c in range(0x10000):
        if chr(c).isalpha():
            table[c] = _SYMBOL.get(chr(c), SIZE - 1)
    table[0xFFFF] = SIZE - 1
    return table


def trigram_counts(texts) -> np.ndarray:
    """Counts of symbol trigrams, borders included, as a flat array."""
    table = _table()
    counts = np.zeros(SIZE**3, dtype=np.int64)
    held: list[str] = []
    size = 0

    def add() -> None:
        # Two borders before each text and one after it; the borders between texts are counted, too.
        joined = "\n\n" + "\n\n".join(held) + "\n"
        s = table[np.minimum(np.frombuffer(joined.lower().encode("utf-32-le"), dtype=np.uint32), 0xFFFF)].astype(np.int32)
        np.add(counts, np.bincount((s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:], minlength=SIZE**3), out=counts)
        held.clear()

    for t in texts:
        if t:
            held.append(t)
            size += len(t)
            if size > 2_000_000:
                add()
                size = 0
    if held:
        add()
    return counts


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    return _symbols_table()


class CharModel:
    """Add-one-smoothed trigram costs (negative natural logarithms)."""

    def __init__(self, counts: np.ndarray):
        grid = counts.reshape(SIZE * SIZE, SIZE).astype(np.float64) + 0.5
        self.cost = (-np.log(grid / grid.sum(axis=1, keepdims=True))).astype(np.float32).reshape(SIZE, SIZE, SIZE)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each place, the strings that it may stand for and their channel costs."""
    places: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        ch = token[i]
        run = 1
        while i + run < len(token) and token[i + run] == ch:
            run += 1
        if ch.isalpha():
            if run <= 2:
                places.append([(ch * run, 0.0)] if run == 1 else [(ch * 2, 0.0), (ch, REPEAT_COST)])
            else:
                places.append([(ch, REPEAT_COST), (ch * 2, REPEAT_COST)])
        else:
            looks = LOOKS_LIKE.get(ch, "")
            reads = [(x, CHANNEL_COST) for x in looks]
            if run > 1:
                reads += [(x * 2, CHANNEL_COST) for x in looks]
            if not ch.isdigit():
                reads.append(("", DROP_COST))
            places.append(reads or [("", DROP_COST)])
        i += run
    return places


def spaced_lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """Places of single characters and of the gaps between them; " " is a border."""
    places: list[list[tuple[str, float]]] = []
    for ch in _FILLER.split(stretch):
        if places:
            places.append([("", 0.0), (" ", BORDER_COST)])
        places += lattice(ch)
    return places


def viterbi(places: list[list[tuple[str, float]]], model: CharModel) -> str:
    """The letters and borders with the lowest channel plus language model cost."""
    cost = model.cost
    # State: the last two symbols. Value: cost so far and what was read, last first.
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for reads in places:
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (so_far, text) in states.items():
            for letters, channel in reads:
                x, y, total = a, b, so_far + channel
                for ch in letters:
                    z = 0 if ch == " " else _SYMBOL.get(ch, SIZE - 1)
                    total += float(cost[x, y, z])
                    x, y = y, z
                old = after.get((x, y))
                if old is None or total < old[0]:
                    after[x, y] = (total, (letters, text))
        states = after
    return min((total + float(cost[a, b, 0]), _read(text)) for (a, b), (total, text) in states.items())[1]


def _read(text: tuple | None) -> str:
    parts = []
    while text is not None:
        letters, text = text
        parts.append(letters)
    return "".join(reversed(parts))


def spaced_words(stretch: str, model: CharModel) -> list[str]:
    """A stretch of single characters as the words that it most likely stands for."""
    bare = _FILLER.sub("", stretch)
    return [bare] if bare.isdigit() else viterbi(spaced_lattice(stretch), model).split()


def restore(token: str, model: CharModel) -> str:
    """A lower-case token as the word that it most likely stands for."""
    plain = token.rstrip(".,;:?)")
    if plain.isalpha() and not _TRIPLE.search(plain):
        return plain
    token = _REPEATED_TAIL.sub("", token)
    bare = _EDGE.sub("", token)
    if bare.isalpha() and not _DISGUISED.match(bare):
        # Symbols at the end only: punctuation, unless they imitate letters.
        return bare
    if not any(ch.isalpha() for ch in bare) and sum(ch in LOOKS_LIKE for ch in bare) < len(bare) or bare.isdigit():
        return bare
    return viterbi(lattice(bare), model)


def prefix_hash(word: str) -> int:
    return xxhash.xxh32_intdigest(word[:4].encode())


def feature_hashes(word: str, prefix: int) -> tuple[int, ...]:
    """Hashes of a restored word and its beginnings; the high half is that of the first four letters."""
    names = {f"w{word}"} | {f"p{word[:n]}" for n in (4, 5, 6) if len(word) >= n}
    high = (prefix - 2**31) << 32
    return tuple(high + xxhash.xxh32_intdigest(x.encode()) for x in names)


class Features:
    """Feature hashes of texts; ``known`` limits them to the features of a fitted model."""

    def __init__(self, model: CharModel, known: frozenset[int] | None = None):
        self.model, self.known, self.memo = model, known, {}
        self.prefixes = None if known is None else {(h >> 32) + 2**31 for h in known}

    def of_stretch(self, stretch: str) -> tuple[int, ...]:
        return tuple(h for word in spaced_words(stretch, self.model) for h in self.of_word(word))

    def of_token(self, token: str) -> tuple[int, ...]:
        return self.of_word(restore(token, self.model))

    def of_word(self, word: str) -> tuple[int, ...]:
        prefix = prefix_hash(word)
        if len(word) < 3 or self.prefixes is not None and prefix not in self.prefixes:
            return ()
        found = feature_hashes(word, prefix)
        return found if self.known is None else tuple(h for h in found if h in self.known)

    def of_text(self, text: str | None) -> set[int]:
        if not text:
            return set()
        text = text.lower()
        tokens = set(text.split())
        stretches = {h for m in set(_SPACED.findall(text)) for h in self.of_stretch(m)}
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        listed = list(tokens)
        found = list(map(memo.get, listed))
        if None in found:
            new = {token: self.of_token(token) for token, known in zip(listed, found) if known is None}
            memo.update(new)
            found += new.values()
        return stretches.union(*filter(None, found))


def fit_char_model(texts: DataFrame) -> CharModel:
    """Counts trigrams of all rows of ``text``; at most SIZE ** 3 sums reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIZE**3, dtype=np.int64)
        for rows in batches:
            total += trigram_counts(rows["text"])
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    sums = texts.select("text").mapInPandas(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    rows = sums.toPandas()
    counts = np.zeros(SIZE**3, dtype=np.int64)
    counts[rows["at"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return CharModel(counts)


def _feature_counts(labelled: DataFrame, model) -> DataFrame:
    """``feature, n0, n1``: documents of each label that have the feature; feature NULL: all."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(model.value)

        def rows(counts: dict) -> pd.DataFrame:
            return pd.DataFrame(
                {
                    "feature": pd.array(list(counts), dtype="Int64"),
                    "n0": [c[0] for c in counts.values()],
                    "n1": [c[1] for c in counts.values()],
                }
            )

        counts: dict[int | None, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"]):
                for h in (None, *features.of_text(text)):
                    counts.setdefault(h, [0, 0])[int(label)] += 1
                if len(counts) > 500_000:
                    yield rows(counts)
                    counts = {}
        if counts:
            yield rows(counts)

    parts = labelled.select("text", "toxic").mapInPandas(count, "feature bigint, n0 bigint, n1 bigint")
    return parts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _likelihood_ratio(n0: Column, n1: Column, all0: int, all1: int) -> Column:
    """G statistic of a feature's two by two table (presence by label)."""

    def term(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    n, total = n0 + n1, all0 + all1
    rest0, rest1 = F.lit(all0) - n0, F.lit(all1) - n1
    return 2 * (
        term(n0, n * all0 / total)
        + term(n1, n * all1 / total)
        + term(rest0, (total - n) * all0 / total)
        + term(rest1, (total - n) * all1 / total)
    )


class ToxicityModel:
    """Prior and weights of features; a large model has them in ``table`` (``feature, weight``) instead."""

    def __init__(self, chars: CharModel, prior: float, weights: dict[int, float], table: DataFrame | None = None):
        self.chars, self.prior, self.weights, self.table = chars, prior, weights, table

    def score(self, found: set[int]) -> float:
        x = self.prior + sum(self.weights[h] for h in found)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, is_training: Column) -> ToxicityModel | None:
    """Learns characters from all training texts and features from all labelled ones."""
    training = docs.select("doc_id", "text").where(is_training & F.col("text").isNotNull())
    chars = fit_char_model(training)
    shared = docs.sparkSession.sparkContext.broadcast(chars)
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    counts = cut(_feature_counts(training.join(marks.hint("merge"), "doc_id"), shared))
    every = counts.where("feature is null").first()
    if every is None:
        return None
    all0, all1 = every.n0, every.n1
    if not all0 or not all1:
        return ToxicityModel(chars, math.log((all1 + 0.5) / (all0 + 0.5)), {})
    # A share of label 1 above the prior's, by more than chance.
    chosen = (
        counts.where("feature is not null and n1 >= 3")
        .where(F.col("n1") * all0 > F.col("n0") * all1 * 3)
        .where(_likelihood_ratio(F.col("n0"), F.col("n1"), all0, all1) > MIN_G)
    )
    prior = math.log((all1 + 0.5) / (all0 + 0.5))
    if chosen.count() > BROADCAST_FEATURES:
        odds = F.log((F.col("n1") + 0.5) / (all1 + 1)) - F.log((F.col("n0") + 0.5) / (all0 + 1))
        return ToxicityModel(chars, prior, {}, cut(chosen.select("feature", odds.alias("weight"))))
    weights = {
        r.feature: math.log((r.n1 + 0.5) / (all1 + 1)) - math.log((r.n0 + 0.5) / (all0 + 1)) for r in chosen.collect()
    }
    return ToxicityModel(chars, prior, weights)


def toxicity_column(docs: DataFrame, model: ToxicityModel | None) -> Column:
    """Score in [0, 1] of the column ``text``, by a model whose weights are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = shared.value
        features = Features(fitted.chars, frozenset(fitted.weights)) if fitted else None
        for texts in batches:
            yield pd.Series([fitted.score(features.of_text(x)) if fitted else 0.0 for x in texts], dtype="float64")

    return F.pandas_udf(score, "double")(F.col("text"))


def _joined_scores(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """``rows`` with ``score``, their features joined with the table of weights."""
    shared = rows.sparkSession.sparkContext.broadcast(model.chars)

    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(shared.value)
        for texts in batches:
            yield pd.Series([sorted(features.of_text(x)) for x in texts])

    numbered = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    owned = numbered.select("row", F.explode(F.pandas_udf(found, "array<bigint>")("text")).alias("feature"))
    # One partial sum for each row and task before the sums meet.
    sums = owned.join(model.table, "feature").groupBy("row").agg(F.sum("weight").alias("x"))
    x = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.lit(model.prior) + F.coalesce("x", F.lit(0.0))))
    return numbered.join(sums, "row", "left").withColumn("score", 1 / (1 + F.exp(-x)))


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``; learns from rows whose fold is not 0."""
    held_out = fold(F.col("doc_id"), folds) == 0
    model = fit_toxicity(docs, labels, ~held_out)
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    if model is not None and model.table is not None:
        scored = _joined_scores(rows, model)
    else:
        scored = rows.withColumn("score", toxicity_column(rows, model))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
