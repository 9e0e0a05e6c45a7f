"""Log-probabilities of texts under a weighted backoff automaton of word bigrams.

*Model.*  Unigrams are add-one smoothed: P(w) = (c(w) + 1) / (N + V + 1).  A word
after h has P(w | h) = (c(h w) + M * P(w)) / (c(h) + M) (Dirichlet smoothing, M =
``PRIOR``), a proper distribution.  As an automaton: one state for each word seen,
one for the start and the empty state.  A seen bigram is an arc h -> w that weighs
log10 P(w | h); every state has a failure arc to the empty state that weighs
log10(M / (c(h) + M)), from which the arc w weighs log10 P(w).  A text is read once,
left to right, from the start state to the end token.  An unseen word leads to the
empty state's unknown arc, 1 / (N + V + 1), and on to the empty state.

*At scale.*  All n-grams of all training texts are counted.  The automaton of the whole
corpus is never in one place: documents are dealt into blocks of bounded text, and
each block needs only the states and arcs that its own texts can follow.

1. Each block counts its distinct n-grams (64-bit keys, training counts) and sends them,
   sorted, to parts by key: a frequent n-gram is one entry for each block, however often it occurs.
2. Each part adds up its keys and returns to a block the totals (by place) that differ from the
   block's own counts (an n-gram that only this block has needs no answer).
3. Each block builds its slice of the automaton and walks its texts through it.

Keys of different n-grams are equal with probability 2**-64 a pair.

Defined results: a NULL or empty text is the end token alone; equal texts get equal
scores; rows with NULL id are scored, not learned from; with no training rows N = 0 and
every token is unknown; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fold

PRIOR = 100.0
BLOCK_BYTES = 12_000_000
START, END = b"\t", b"\n"  # no words: words hold no white space
_PAIR = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def tokens(text: str | None) -> list[bytes]:
    return [*(text.encode().lower().split() if text else ()), END]


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit keys of bigrams from the keys of their words."""
    x = a * _PAIR[0] + b * _PAIR[1]
    x = (x ^ (x >> np.uint64(32))) * _PAIR[0]
    return x ^ (x >> np.uint64(29))


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Block:
    """Texts of one block as word numbers, with their distinct n-grams."""

    def __init__(self, texts, training):
        numbers = _Numbers({START: 0})
        self.lengths = np.zeros(len(texts), dtype=np.int64)
        parts = []
        for i, text in enumerate(texts):
            words = tokens(text)
            self.lengths[i] = len(words)
            parts.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)))
        self.words = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        self.keys = np.fromiter(map(xxhash.xxh64_intdigest, numbers), dtype=np.uint64, count=len(numbers))
        self.starts = np.cumsum(self.lengths) - self.lengths
        # The state before each token: the word before it, or the start.
        self.states = np.zeros(len(self.words), dtype=np.int64)
        self.states[1:] = self.words[:-1]
        self.states[self.starts] = 0
        self.training = np.repeat(np.asarray(training, dtype=bool), self.lengths)
        self.texts_trained = int(np.count_nonzero(training))

    def word_counts(self) -> np.ndarray:
        """Training count of each word number; number 0 counts the training texts."""
        counts = np.bincount(self.words[self.training], minlength=len(self.keys))
        counts[0] = self.texts_trained
        return counts

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct bigrams: states, words, training counts; and the bigram of each token."""
        code = self.states * len(self.keys) + self.words
        distinct, place = np.unique(code, return_inverse=True)
        counts = np.bincount(place[self.training], minlength=len(distinct))
        return distinct // len(self.keys), distinct % len(self.keys), counts, place


def packed(counts: np.ndarray) -> bytes:
    """Counts as one byte each; from 255 on the value follows behind them, eight bytes each."""
    large = counts[counts >= 255]
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + large.astype("<u8").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", offset=n)
    return counts


def part_borders(sorted_keys: np.ndarray, parts: int) -> np.ndarray:
    step = np.uint64(2**64 // parts + 1)
    return np.searchsorted(sorted_keys // step, np.arange(parts + 1, dtype=np.uint64))


def to_parts(order: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[tuple]:
    """(part, order, keys, counts) as bytes, keys sorted, for the parts that get any."""
    at = np.argsort(keys, kind="stable")
    keys, counts = keys[at], counts[at]
    edges = part_borders(keys, parts)
    for p in np.flatnonzero(np.diff(edges)):
        lo, hi = edges[p], edges[p + 1]
        yield int(p), order, keys[lo:hi].astype("<u8").tobytes(), packed(counts[lo:hi])


def add_up(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Distinct keys and totals of one part and order; each row's places and own counts."""
    each = [np.frombuffer(k, dtype="<u8") for k in rows["keys"]]
    own = [unpacked(c, len(k)) for c, k in zip(rows["counts"], each)]
    keys, place = np.unique(np.concatenate(each), return_inverse=True)
    totals = np.zeros(len(keys), dtype=np.int64)
    np.add.at(totals, place, np.concatenate(own))
    places = np.split(place, np.cumsum([len(k) for k in each])[:-1])
    return keys, totals, places, own


_OUT = "block bigint, part int, n int, keys binary, counts binary"
_ANSWERS = "block bigint, part int, n int, steps binary, counts binary, size int"


def _count_blocks(parts: int, orders: tuple[int, ...]):
    def count(rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows["text"], rows["training"])
        out = []
        if 1 in orders:
            out += to_parts(1, block.keys, block.word_counts(), parts)
        if 2 in orders:
            states, words, counts, _ = block.pairs()
            out += to_parts(2, pair_key(block.keys[states], block.keys[words]), counts, parts)
        result = pd.DataFrame(out, columns=["part", "n", "keys", "counts"])
        result.insert(0, "block", int(rows["block"].iloc[0]))
        return result

    return count


def _add_parts(rows: pd.DataFrame) -> pd.DataFrame:
    keys, totals, places, own = add_up(rows)
    out = []
    for block, place, mine in zip(rows["block"], places, own):
        differs = np.flatnonzero(totals[place] != mine)
        if len(differs):
            # Where they stand among the block's keys of this part, and their totals.
            steps = np.diff(differs, prepend=0)
            out.append((block, rows["part"].iloc[0], rows["n"].iloc[0], packed(steps), packed(totals[place[differs]]), len(differs)))
    return pd.DataFrame(out, columns=["block", "part", "n", "steps", "counts", "size"])


def _corrected(keys: np.ndarray, counts: np.ndarray, answers: pd.DataFrame, parts: int) -> np.ndarray:
    """``counts`` with the totals that came back for the keys that other blocks have as well."""
    counts = counts.copy()
    if len(answers):
        order = np.argsort(keys, kind="stable")
        edges = part_borders(keys[order], parts)
        for part, steps, totals, size in zip(answers["part"], answers["steps"], answers["counts"], answers["size"]):
            counts[order[edges[part] + np.cumsum(unpacked(steps, size))]] = unpacked(totals, size)
    return counts


class Automaton:
    """A block's slice of the backoff automaton: arcs by (state, word), failure weights by state."""

    def __init__(self, block: Block, answers: pd.DataFrame, parts: int, n: int, v: int, prior: float):
        self.block = block
        one = answers[answers["n"] == 1] if len(answers) else answers
        two = answers[answers["n"] == 2] if len(answers) else answers
        self.counts = _corrected(block.keys, block.word_counts(), one, parts)
        states, words, counts, self.arc_of_token = block.pairs()
        counts = _corrected(pair_key(block.keys[states], block.keys[words]), counts, two, parts)
        root = (self.counts + 1.0) / (n + v + 1.0)
        self.root = np.log10(root)
        leaving = self.counts.astype(np.float64)
        self.failure = np.log10(prior / (leaving + prior))
        seen = np.log10((counts + prior * root[words]) / (leaving[states] + prior))
        # An arc exists where the bigram was seen, else the failure arc and the empty state's arc.
        self.arc = np.where(counts > 0, seen, self.failure[states] + self.root[words])

    def walk(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known tokens, base and model log10 probability of each text."""
        at = self.block.starts
        words = self.block.words
        known = np.add.reduceat((self.counts[words] > 0).astype(np.int64), at)
        return known, np.add.reduceat(self.root[words], at), np.add.reduceat(self.arc[self.arc_of_token], at)


_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _score_blocks(parts: int, n: int, v: int, prior: float):
    def score(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({c.split()[0]: [] for c in _SCORES.split(", ")})
        block = Block(rows["text"], rows["training"])
        known, base, score = Automaton(block, answers, parts, n, v, prior).walk()
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].array,
                "held_out": rows["held_out"].array,
                "n_tokens": block.lengths,
                "n_known": known,
                "base_score": base,
                "score": score,
            }
        )

    return score


def score_texts(docs: DataFrame, *, folds: int = 7, held_out_fold: int = 2, prior: float = PRIOR) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    of = fold(F.col("doc_id"), folds)
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").alias("text"),
        F.coalesce(of == held_out_fold, F.lit(False)).alias("held_out"),
        F.coalesce(of != held_out_fold, F.lit(False)).alias("training"),
    )
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    # Rows are dealt by id and text, so neither NULL ids nor repeated texts pile up.
    dealt = plain.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    parts = max(8, blocks)

    def counted(orders: tuple[int, ...], source: DataFrame) -> DataFrame:
        return source.groupBy("block").applyInPandas(_count_blocks(parts, orders), _OUT)

    # N and V first: they need the words of the training texts only.
    sums = (
        plain.where("training")
        .select("text", "training", F.lit(0).cast("bigint").alias("block"))
        .mapInPandas(_count_batches(parts), _OUT)
        .groupBy("part")
        .applyInPandas(_sum_words, "tokens bigint, words bigint")
        .agg(F.sum("tokens"), F.sum("words"))
        .first()
    )
    n, v = int(sums[0] or 0), int(sums[1] or 0)
    answers = counted((1, 2), dealt).groupBy("part", "n").applyInPandas(_add_parts, _ANSWERS)
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_score_blocks(parts, n, v, prior), _SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _count_batches(parts: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                block = Block(rows["text"], rows["training"])
                keys, counts = block.keys[1:], block.word_counts()[1:]
                out = pd.DataFrame(list(to_parts(1, keys, counts, parts)), columns=["part", "n", "keys", "counts"])
                out.insert(0, "block", 0)
                yield out

    return count


def _sum_words(rows: pd.DataFrame) -> pd.DataFrame:
    keys, totals, _, _ = add_up(rows)
    return pd.DataFrame({"tokens": [int(totals.sum())], "words": [len(keys)]})
