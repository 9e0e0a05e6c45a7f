"""Language identification with blended-spectrum string kernels.

The kernel of two texts is the number of character n-grams (n = 1, 2, 3) present in
both, divided by the geometric mean of their own numbers.  Nystroem landmarks turn
it into a feature map, and one-versus-rest kernel ridge regression is fitted on it.
The kernel is an inner product of presence vectors, so landmarks and regression
weights fold into one matrix of n-grams by languages: a batch of texts is scored by
one sparse-times-dense matrix product.

The fit uses at most ``PER_LANGUAGE`` rows of each language, chosen by a hash of the
id among its labelled rows (a bounded sample of labelled rows; the bound is a parameter).
Texts of more than ``FIT_CHARS`` characters are taken, whole, where a language has fewer
rows than that without them, so every language with a labelled row is learned.  Every text is scored whole.

Letters are lower-cased; anything else is a word border, runs of borders count once.

Defined results: a NULL text or one without letters is ``und`` with score 0; with no
labelled rows every text is ``und``; equal scores go to the first language by name;
rows are independent, so repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fold

PER_LANGUAGE = 300
LANDMARKS_PER_LANGUAGE = 60
FIT_CHARS = 20_000  # longer texts are sampled where a language has too few others
FIT_BLOCK = 256
RIDGE = 1e-2
SYMBOLS = 64  # 0: border, 1..62: the commonest letters of the sample, 63: any other letter
SHARPNESS = 6.0  # of the logistic that turns the margin into a score
UNDETERMINED = "und"

_LETTER = re.compile(r"[^\W\d_]")
_SIZES = (SYMBOLS, SYMBOLS**2, SYMBOLS**3)
_STARTS = (0, SYMBOLS, SYMBOLS + SYMBOLS**2)


@dataclass
class LanguageModel:
    languages: list[str]
    symbols: np.ndarray  # code point -> symbol, for the basic plane
    column: np.ndarray  # n-gram -> row of weights, or -1
    weights: np.ndarray  # n-grams x languages


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)


def grams(text: str, symbols: np.ndarray) -> list[np.ndarray]:
    """N-gram numbers of a text for n = 1, 2, 3, with repetitions."""
    points = codes(text)
    s = symbols[np.minimum(points, 0xFFFF)].astype(np.int32)
    keep = s > 0
    keep[1:] |= s[:-1] > 0
    s = np.concatenate(([0], s[keep], [0]))
    two = s[:-1] * SYMBOLS + s[1:]
    return [s, two + _STARTS[1], two[:-1] * SYMBOLS + s[2:] + _STARTS[2]]


def present(text: str, model_symbols: np.ndarray, column: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Distinct known n-grams of a text; ``flags`` is scratch, one longer than the n-grams."""
    for g in grams(text, model_symbols):
        flags[column[g]] = True  # unknown n-grams have column -1: the last flag
    flags[-1] = False
    at = np.flatnonzero(flags)
    flags[at] = False
    return at


def _symbols(texts: list[str]) -> np.ndarray:
    counts = np.zeros(0x10000, dtype=np.int64)
    for t in texts:
        counts += np.bincount(np.minimum(codes(t), 0xFFFF), minlength=0x10000)
    letters = np.fromiter((chr(c).isalpha() for c in range(0x10000)), dtype=bool, count=0x10000)
    table = np.where(letters, SYMBOLS - 1, 0).astype(np.uint8)
    seen = np.flatnonzero(letters & (counts > 0))
    common = seen[np.lexsort((seen, -counts[seen]))][: SYMBOLS - 2]
    table[common] = np.arange(1, len(common) + 1)
    table[0xFFFF] = SYMBOLS - 1  # stands for everything beyond the basic plane
    return table


def fit_texts(texts: list[str], langs: list[str]) -> LanguageModel:
    """Kernel ridge regression on a Nystroem map, folded into one weight per n-gram and language."""
    languages = sorted(set(langs))
    symbols = _symbols(texts)
    taken = {lang: 0 for lang in languages}
    landmarks = []
    for i, lang in enumerate(langs):
        if taken[lang] < LANDMARKS_PER_LANGUAGE:
            taken[lang] += 1
            landmarks.append(i)
    known = np.zeros(sum(_SIZES), dtype=bool)
    for i in landmarks:
        for g in grams(texts[i], symbols):
            known[g] = True
    column = np.full(len(known), -1, dtype=np.int32)
    column[known] = np.arange(known.sum())
    n = int(known.sum())
    flags = np.zeros(n + 1, dtype=bool)

    def vectors_of(part: list[str]) -> np.ndarray:
        x = np.zeros((len(part), n), dtype=np.float32)
        for i, t in enumerate(part):
            at = present(t, symbols, column, flags)
            x[i, at] = 1 / np.sqrt(max(1, len(at)))
        return x

    z = vectors_of([texts[i] for i in landmarks])
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # K_zz ** -1/2, up to a rotation
    # A block of texts at a time: only landmarks are held as whole vectors.
    blocks = [vectors_of(texts[i : i + FIT_BLOCK]) @ z.T for i in range(0, len(texts), FIT_BLOCK)]
    phi = np.concatenate(blocks).astype(np.float64) @ root
    y = np.where(np.asarray(langs)[:, None] == np.asarray(languages)[None, :], 1.0, -1.0)
    w = np.linalg.solve(phi.T @ phi + RIDGE * len(texts) * np.eye(phi.shape[1]) / 100, phi.T @ y)
    return LanguageModel(languages, symbols, column, (z.T @ (root @ w)).astype(np.float32))


def fit_language_model(docs: DataFrame, is_training: Column, *, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Fits on a bounded sample of the labelled rows that ``is_training`` selects."""
    labelled = docs.where(is_training & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select(
        "doc_id", "lang", "text", (F.length("text") > FIT_CHARS).alias("is_long")
    )
    sizes = {(r.lang, r.is_long): r.n for r in labelled.groupBy("lang", "is_long").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    # Rows wanted of each language and length class, and the share of its rows that gives them.
    wanted = {
        (lang, long): per_language - (min(per_language, sizes.get((lang, False), 0)) if long else 0) for lang, long in sizes
    }
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = F.create_map(
        *[
            x
            for (lang, long), n in sorted(sizes.items())
            for x in (F.lit(f"{int(long)}{lang}"), F.lit(int(1_000_000 * min(1.0, 1.3 * wanted[lang, long] / n)) + bool(wanted[lang, long])))
        ]
    )
    rows = (
        labelled.where(place < share[F.concat(F.col("is_long").cast("int").cast("string"), F.col("lang"))])
        .orderBy("is_long", place, "doc_id", "lang", "text")
        .limit(2 * per_language * len(sizes))
        .collect()
    )
    taken: dict[str, int] = {}
    sample = []
    for r in rows:
        taken[r.lang] = taken.get(r.lang, 0) + 1
        if taken[r.lang] <= per_language:
            sample.append(r)
    return fit_texts([r.text for r in sample], [r.lang for r in sample])


def known_share(text: str | None, model: LanguageModel) -> tuple[int, int]:
    """How many n-grams a text has, repetitions included, and how many of them the model knows."""
    found = [model.column[g] >= 0 for g in grams(text, model.symbols)] if text else []
    return sum(map(len, found)), sum(int(f.sum()) for f in found)


def score_texts(texts, model: LanguageModel | None) -> tuple[list[str], np.ndarray]:
    """Predicted language and score of each text of a batch."""
    langs = [UNDETERMINED] * len(texts)
    scores = np.zeros(len(texts))
    if model is None:
        return langs, scores
    flags = np.zeros(len(model.weights) + 1, dtype=bool)
    rows, found = [], []
    for i, t in enumerate(texts):
        if t is not None and _LETTER.search(t):
            rows.append(i)
            found.append(present(t, model.symbols, model.column, flags))
    if not rows:
        return langs, scores
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    # Presence matrix (sparse, row by row) times weights.
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    total = np.zeros((len(rows), len(model.languages)))
    full = sizes > 0
    if full.any():
        total[full] = np.add.reduceat(model.weights[np.concatenate(found)], starts[full], axis=0)
        total[full] /= np.sqrt(sizes[full])[:, None]
    best = total.argmax(axis=1)
    ordered = np.sort(total, axis=1)
    margin = ordered[:, -1] - (ordered[:, -2] if total.shape[1] > 1 else 0)
    for i, b in zip(rows, best):
        langs[i] = model.languages[b]
    scores[rows] = 1 / (1 + np.exp(-SHARPNESS * margin))
    return langs, scores


def language_column(docs: DataFrame, model: LanguageModel | None) -> Column:
    """``struct<lang_pred, score>`` of the column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores = [], []
            for i in range(0, len(texts), 256):
                a, b = score_texts(list(texts.iloc[i : i + 256]), shared.value)
                langs += a
                scores.append(b)
            yield pd.DataFrame({"lang_pred": langs, "score": np.concatenate(scores) if scores else []})

    return F.pandas_udf(identify, "struct<lang_pred:string,score:double>")(F.col("text"))


def known_language(docs: DataFrame, model: LanguageModel, min_grams: int, min_known: int) -> Column:
    """Whether the column ``text`` has a language that the model knows: it is not ``und``, and it has
    fewer than ``min_grams`` n-grams or knows at least ``min_known`` percent of them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # One function for both questions, so that a task needs one Python worker.
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for i in range(0, len(texts), 256):
                part = list(texts.iloc[i : i + 256])
                for lang, text in zip(score_texts(part, shared.value)[0], part):
                    n, n_known = known_share(text, shared.value) if lang != UNDETERMINED else (0, 0)
                    out.append(lang != UNDETERMINED and (n < min_grams or 100 * n_known >= min_known * n))
            yield pd.Series(out, dtype=bool)

    return F.pandas_udf(known, "boolean")(F.col("text"))


def identify_languages(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score``; learns from the rows whose fold is not 0."""
    # A NULL id has no fold: it is neither learned from nor held out.
    held_out = fold(F.col("doc_id"), folds) == 0
    model = fit_language_model(docs, ~held_out)
    return docs.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), language_column(docs, model).alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")
