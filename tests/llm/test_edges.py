"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm.components import connected_components
from ledgerline.llm.decontaminate import benchmark_hits, decontaminate
from ledgerline.llm.language_id import identify_languages
from ledgerline.llm.line_dedup import dedup_lines, without_repeated_lines
from ledgerline.llm.lm_score import score_texts
from ledgerline.llm.near_dedup import chunk_keys, chunks_of, near_duplicates, radius_of, shingles, signature
from ledgerline.llm.packing import pack_documents, plan_bins
from ledgerline.llm.pii import mask_personal_data, personal_data_digest
from ledgerline.llm.token_counts import token_counts
from ledgerline.llm.tokenizers_cached import byte_level_encoder, chunk_counter, load_tokenizer, public_path
from ledgerline.llm.topk import top_k
from ledgerline.llm.toxicity import CharModel, Features, feature_hashes, prefix_hash, restore, score_toxicity, spaced_words, trigram_counts
from ledgerline.session import scratch_path
from tests.llm.conftest import SF
from tests.llm.test_queries import check_spans

WORDS = [f"word{i}" for i in range(400)]


def prose(seed, n=120):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


LONG = " ".join(random.Random(9).choices(WORDS, k=60_000))
TEXTS = [None, "", "   ", "\n\n", "!!! 123", prose(1), prose(1), prose(2), LONG, "a", "x" * 200_000, "é" * 30 + "\n" + "é" * 30]
LABELS = "doc_id bigint, toxic int"


def _operators(spark):
    labels = spark.createDataFrame([(5, 1), (6, 1), (7, 0), (8, None), (8, 0), (None, 1)], LABELS)
    bench = spark.createDataFrame([(1, prose(2, 30)), (2, None), (None, "a b"), (3, ""), (3, "a")], "item_id bigint, text string")
    vectors = lambda d: d.select(F.col("doc_id").alias("vec_id"), F.array(F.length("text").cast("float")).alias("embedding"))
    return {
        "topk": lambda d: top_k(vectors(d), F.col("vec_id") % 2 == 0),
        "minhash": near_duplicates,
        "tokens": lambda d: token_counts(d, scratch_path(spark, "cache")),
        "toxicity": lambda d: score_toxicity(d, labels),
        "lines": dedup_lines,
        "lines stage": without_repeated_lines,
        "lm": score_texts,
        "language": identify_languages,
        "pii": personal_data_digest,
        "mask": mask_personal_data,
        "packing": pack_documents,
        "benchmark": lambda d: benchmark_hits(d, bench),
        "decontaminate": lambda d: decontaminate(d, bench),
    }


NAMES = [
    "topk", "minhash", "tokens", "toxicity", "lines", "lines stage", "lm", "language", "pii", "mask", "packing",
    "benchmark", "decontaminate",
]
PER_ROW = {"minhash", "tokens", "toxicity", "lines", "lm", "language", "pii", "mask", "benchmark"}


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, make_docs, name):
    docs = make_docs(TEXTS + [prose(1), prose(3)], langs=["en", None] * 7, ids=[*range(len(TEXTS)), None, 5])
    clashing = docs.select(
        "*", *[F.lit(1).alias(c) for c in ("n_words", "score", "key", "id", "block", "found", "digest", "SIG", "rank", "length")]
    )
    rows = _operators(spark)[name](clashing).collect()
    if name in PER_ROW:
        assert len(rows) == docs.count()


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, make_docs, name):
    assert _operators(spark)[name](make_docs([])).collect() == []


def test_topk_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.01, 1, 50])).tolist()) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(200)]  # a hot group of equal vectors
    rows += [(700, None), (701, [None] * 8), (702, [float("nan")] * 8), (None, rows[0][1]), (704, [0.0] * 8), (705, [1.0] * 3)]
    got = top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 8 == 0).toPandas()
    valid = {
        i: np.floor(1024 * np.asarray(v, dtype=np.float32).astype(float)).astype(np.int64)
        for i, v in rows
        if i is not None and v is not None and None not in v and np.isfinite(v).all()
    }
    for q, v in valid.items():
        if q % 8 == 0:
            best = sorted((-int(v @ c), i) for i, c in valid.items() if i != q and len(c) == len(v))[:10]
            mine = got[got.query_id == q].sort_values("rank")
            assert list(zip(-mine.score, mine.vec_id)) == best


def test_signatures_meet_within_radius():
    rng = np.random.default_rng(1)
    base = signature(shingles(prose(4, 500)))
    for _ in range(200):
        other = base.copy()
        other[rng.choice(64, size=23, replace=False)] ^= 1
        a, b = chunk_keys(np.stack([base, other]))
        assert set(a) & set(b)


def test_near_duplicates_hot_group(spark, make_docs):
    """A star of near copies around one text, exact copies, and brute force over all pairs."""
    rng = random.Random(8)
    texts = []
    for _ in range(350):
        words = prose(5, 150).split()
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(150)] = rng.choice(WORDS) + "x"
        texts.append(" ".join(words))
    texts += [prose(6)] * 40 + [prose(7, 3), prose(7, 3).upper(), "", None] + [prose(100 + i) for i in range(50)]
    got = near_duplicates(make_docs(texts)).toPandas().set_index("doc_id").sort_index()
    sets = [set(shingles(t).tolist()) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert [got.component_id[i] for i in range(len(texts))] == [find(i) for i in range(len(texts))]
    assert (got.n_shingles == pd.Series(map(len, sets))).all()


@pytest.mark.parametrize("percent", [80, 85, 90, 95, 100])
def test_signatures_meet_within_each_radius(percent):
    rng = np.random.default_rng(2)
    base = signature(shingles(prose(4, 500)))
    for _ in range(200):
        other = base.copy()
        other[rng.choice(64, size=radius_of(percent), replace=False)] ^= 1
        a, b = chunk_keys(np.stack([base, other]), percent)
        assert set(a) & set(b)


def test_radius_and_chunks():
    assert [(radius_of(p), chunks_of(p)) for p in (80, 85, 100)] == [(28, 15), (23, 12), (0, 1)]


def test_near_dedup_stage_against_brute_force(spark, make_docs):
    """Pairs on both sides of 0.80; the stage drops all that brute force over all pairs drops."""
    rng = random.Random(12)
    texts = []
    for i in range(150):
        words = prose(2000 + i, 140).split()
        texts.append(" ".join(words))
        for at in rng.sample(range(4, 136, 5), rng.randint(1, 4)):
            words[at] = "changed"
        texts.append(" ".join(words))
    sets = [set(shingles(t).tolist()) for t in texts]
    similarity = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    assert sum(0.80 <= s < 0.85 for s in similarity) >= 20 and sum(s < 0.80 for s in similarity) >= 20
    want = set()
    for j in range(len(texts)):
        if any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for i in range(j)):
            want.add(j)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert {r.doc_id for r in stage(spark, make_docs(texts), SF).collect()} == set(range(len(texts))) - want


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(64)] + [(None, 3), (5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    label = {x: x for pair in links if None not in pair and pair[0] != pair[1] for x in pair}
    for _ in label:
        for a, b in links:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_chunk_memo_equals_the_library():
    rng = random.Random(5)
    odd = [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "a", "B", "é", "é", "'s", "'ll", "foo", "bar.", "|", "!!!", "12", "\xa0",
           "\x1c", "\x85", "<|endoftext|>", "<|ENDOFTEXT|>", "H̱", "İ", "ΑΣ", "中文", "🙂", "\r\n", "\x00"]
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 12))) for _ in range(3000)]
    encoder, counter = byte_level_encoder(public_path("byte_bpe_50k.json")), chunk_counter(public_path("word_bpe_49k.json"))
    ids, words = load_tokenizer(public_path("byte_bpe_50k.json")), load_tokenizer(public_path("word_bpe_49k.json"))
    counts = counter.counts(texts)
    for t, n in zip(texts, counts):
        assert encoder.ids(t) == np.asarray(ids.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert n == len(words.encode(t, add_special_tokens=False).ids)


def test_very_long_white_space_equals_the_library():
    path = public_path("byte_bpe_50k.json")
    for t in (" " * 600_000, "a" + " " * 600_000 + "b", "x" * 300_000):
        want = np.asarray(load_tokenizer(path).encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert byte_level_encoder(path).ids(t) == want


def test_token_cache_is_used(spark, make_docs):
    path = scratch_path(spark, "cache")
    texts = [prose(1), prose(1).upper(), prose(2).replace(" ", "\n"), None, "<|endoftext|>", "<|ENDOFTEXT|>"]
    first = {r.doc_id: r.n_tokens for r in token_counts(make_docs(texts), path).collect()}
    stored = spark.read.parquet(path).count()
    again = {r.doc_id: r.n_tokens for r in token_counts(make_docs(texts), path).collect()}
    assert first == again and spark.read.parquet(path).count() == stored == 5
    library = load_tokenizer(public_path("word_bpe_49k.json"))
    assert first == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_packing_plan():
    rng = random.Random(1)
    counts = {}
    for _ in range(5000):
        n = rng.randint(1, 2048)
        counts[n] = counts.get(n, 0) + 1
    plan = plan_bins(counts, 2048)
    used: dict[int, int] = {}
    for pattern, bins in plan:
        assert sum(n * t for n, t in pattern) <= 2048
        for n, t in pattern:
            used[n] = used.get(n, 0) + t * bins
    assert used == counts
    total = sum(n * c for n, c in counts.items())
    assert sum(b for _, b in plan) <= total / 2048 * 1.02 + 1


def test_restored_words():
    model = CharModel(trigram_counts(["the stupid idiot is a loser and the clown lost " * 50]))
    for token, word in {"st00pid": None, "1d1ot": "idiot", "l0ser": "loser", "id.i.ot": "idiot", "idioooot": "idiot", "clown!!": "clown", "the": "the"}.items():
        if word:
            assert restore(token, model) == word


def test_spaced_out_words():
    model = CharModel(trigram_counts(["you are an idiot and a scum, kys. you are a stupid idiot, the scum of a town. " * 50]))
    features = Features(model)
    cases = {
        "s c u m.": "scum", "s c u m,": "scum", "i d i o t!": "idiot", "k y s": "kys", "i  d  i  o  t": "idiot", "(i d i o t)": "idiot",
        "1 d 1 0 t": "idiot", "i.d.i.o.t": "idiot", "you are a i d i o t": "idiot", "y o u a r e a n i d i o t": "idiot",
        "y o u  a r e  a n  i d i o t!!": "idiot", "s c u m you": "scum", "a\ts c u m": "scum",
    }
    for text, word in cases.items():
        assert set(feature_hashes(word, prefix_hash(word))) <= features.of_text(text), text
    assert spaced_words("y o u a r e a n i d i o t", model) == ["you", "are", "an", "idiot"]
    assert features.of_text("1 2 3 4") == set(feature_hashes("1234", prefix_hash("1234")))
    assert features.of_text("a " * 100_000) is not None


def test_lines(spark, make_docs):
    line = "the quick brown fox jumps over the lazy dog"
    texts = [f"{line}\nshort", f"x\n{line.upper()}  \n{line}s", f"{line} and more of it follows here\n{line.replace('fox', 'fix')}", "short\nshort"]
    got = {r.doc_id: r.text for r in dedup_lines(make_docs(texts)).collect()}
    assert got == {0: texts[0], 1: "x", 2: f"{line} and more of it follows here", 3: "short\nshort"}


def test_hits_map_to_the_text(spark, make_docs):
    item = "Alpha beta, gamma"
    bench = spark.createDataFrame([(7, item), (12, prose(2, 40))], "item_id bigint, text string")
    texts = ["é ALPHA--beta\ngamma!", prose(2, 40)[10:], "alpha beta"]
    for shard_bytes in (4_000_000, 20):
        rows = benchmark_hits(make_docs(texts), bench, shard_bytes=shard_bytes).orderBy("doc_id").collect()
        assert [texts[0][s.start : s.end] for s in rows[0].spans] == ["ALPHA--beta\ngamma"]
        assert [r.item_ids for r in rows] == [["7"], ["12"], []]
        assert [r.contaminated for r in rows] == [True, True, False]


PII = [
    "a@b..c@d.e x.y@z-1.co.uk, q@r", "a@b.c%d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255", "4111 1111 1111 1111-4111111111111111",
    "4111--1111111111111", "+1 (202) 555-0100 x +4-", "é🙂 a@b.c +49 30 1234567", "9" * 5000, "a" * 5000 + "@", "1 " * 3000, "a." * 3000 + "@b" + ".c" * 3000,
    "+1" + "2" * 30, "DE89 3704 0044 0532 0130 00 and ssn 123-45-6789", "account 123-45-6789",
]


def test_personal_data(spark, make_docs):
    rng = random.Random(4)
    texts = PII + ["".join(rng.choices("a@.1234567890+- ()é%\n", k=60)) for _ in range(400)] + [" ".join(["x4111111111111111 a@b.cc"] * 200)]
    got = personal_data_digest(make_docs(texts)).toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        check_spans(got.loc[i], t)
    assert "iban:0:27" in got.spans[12] and "ssn:36:47" in got.spans[12] and "ssn" not in got.spans[13]
    masked = mask_personal_data(make_docs(["mail a@b.cc now"])).first()
    assert masked.text == "mail <email> now"


NUMBERS = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"]
AFTER = [" Please pay", " I paid", " PAY 12", " 4711", " A1", ", X", "", "\nDE", " 0532 0130 00"]
NO_NUMBERS = ["DE8937040044053201300", "DE893704004405320130001", "DE88370400440532013000", "ZZ89370400440532013000", "xDE89370400440532013000"]


def test_account_numbers_before_capitals_and_digits(spark, make_docs):
    cases = [(n, f"IBAN {n}{after}") for n in NUMBERS for after in AFTER]
    docs = make_docs([t for _, t in cases] + NO_NUMBERS)
    spans = {r.doc_id: r.spans.split(",") for r in personal_data_digest(docs).collect()}
    for i, (number, text) in enumerate(cases):
        assert f"iban:5:{5 + len(number)}" in spans[i], text
    assert not any("iban" in s for i in range(len(cases), len(spans)) for s in spans[i])


def test_pipeline_on_odd_rows(spark, make_docs, tmp_path):
    docs = make_docs(TEXTS + [prose(1)], langs=["en"] * (len(TEXTS) + 1), ids=[*range(len(TEXTS)), None])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "pack":
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0


def test_pipeline_stages_against_their_operators(spark, make_docs):
    texts = [prose(1), prose(1), prose(2), "...", None, "b" * 5, prose(3) + " " + prose(4)]
    docs = make_docs(texts, langs=["en"] * len(texts))
    stages = dict(corpus_pipeline.STAGES)
    assert {r.doc_id for r in stages["language_id"](spark, docs, SF).collect()} == {0, 1, 2, 5, 6}
    assert {r.doc_id for r in stages["near_dedup"](spark, docs, SF).collect()} == {0, 2, 3, 4, 5, 6}
    assert {r.doc_id for r in stages["line_dedup"](spark, docs, SF).collect()} == {0, 2, 3, 4, 5, 6}
    assert {r.doc_id for r in stages["decontaminate"](spark, docs, SF).collect()} == set(range(7))
