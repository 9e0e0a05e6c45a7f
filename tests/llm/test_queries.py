"""The registered queries over their whole tables, against SQL or plain Python."""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from ledgerline.llm.catalog import LLM_QUERIES, ORACLE_SQL
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def result(spark):
    made = {}

    def get(name):
        if name not in made:
            made[name] = LLM_QUERIES[name](spark, SF).toPandas()
        return made[name]

    return get


def _fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(result, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name]).df()
    got = result(name)[list(want.columns)]
    assert sorted(got.columns) == sorted(result(name).columns)
    keys = [c for c in ("query_id", "anchor_id", "positive_id", "rank", "conv_id", "depth", "doc_id") if c in want]
    pd.testing.assert_frame_equal(
        got.sort_values(keys).reset_index(drop=True),
        want.sort_values(keys).reset_index(drop=True),
        check_dtype=False,
    )


def test_token_counts(result, documents):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {
        d["doc_id"]: (len(d["text"].encode()), len(e.ids))
        for d, e in zip(documents, tok.encode_batch([d["text"] for d in documents], add_special_tokens=False))
    }
    got = result("op3_token_counts")
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got.itertuples()} == want
    assert (got.over_limit == (got.n_tokens > 2048)).all()


def test_packing(result, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for d, e in zip(documents, tok.encode_batch([d["text"] for d in documents], add_special_tokens=False)):
        ids = np.asarray([*e.ids, 0], dtype="<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            want[d["doc_id"], i] = (lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes()))
    got = result("op9_packing")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    for _, rows in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        ends = np.cumsum(rows.length)
        assert ends.iloc[-1] <= 2048
        assert list(rows.offset) == [0, *ends[:-1]]
    bins = got.sequence_id.nunique()
    assert bins <= math.ceil(got.length.sum() / 2048 * 1.02) + 1


def _language_sets(result, documents):
    got = result("op7_language_id").set_index("doc_id")
    return [(d, got.loc[d["doc_id"]]) for d in documents]


def test_language_id(result, documents):
    pairs = _language_sets(result, documents)
    assert all(bool(g.held_out) == (_fold(d["doc_id"], 5) == 0) for d, g in pairs)
    held = [(d["lang"], g.lang_pred) for d, g in pairs if g.held_out]
    assert np.mean([a == b for a, b in held]) > 0.97


def test_toxicity(result, documents):
    import pyarrow.parquet as pq

    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    got = result("op4_toxicity").set_index("doc_id")
    assert len(got) == len(documents)
    held = [(labels[i], got.loc[i]) for i in labels if got.loc[i].held_out]
    assert np.mean([a == r.predicted for a, r in held]) > 0.95
    assert ((got.score >= 0) & (got.score <= 1)).all()


def test_lm_score(result, documents):
    words = {d["doc_id"]: [*re.findall(rb"[^\x20\x09-\x0D]+", d["text"].encode().lower()), None] for d in documents}
    train = [w for i, w in words.items() if _fold(i, 7) != 2]
    c = Counter(t for w in train for t in w)
    n, v = sum(c.values()), len(c)
    pairs = Counter(p for w in train for p in zip(["start", *w], w))
    states = Counter({"start": len(train)}) + c
    got = result("op6_lm_score").set_index("doc_id")
    gains = []
    for i, w in words.items():
        r = got.loc[i]
        root = [(c[t] + 1) / (n + v + 1) for t in w]
        base = sum(map(math.log10, root))
        model = sum(
            math.log10((pairs[h, t] + 100 * p) / (states[h] + 100)) for h, t, p in zip(["start", *w], w, root)
        )
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[t] > 0 for t in w), n)
        assert bool(r.held_out) == (_fold(i, 7) == 2)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, model, rel_tol=1e-9)
        if r.held_out:
            gains.append((model - base) / len(w))
    assert np.mean(gains) > 0


def _base_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        odd, even = d[::-1][::2], d[::-1][1::2]
        total = sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def test_personal_data(result, documents, spark, make_docs):
    got = result("op8_pii").set_index("doc_id")
    for d in documents:
        check_spans(got.loc[d["doc_id"]], d["text"])


def check_spans(r, text):
    spans = _base_spans(text)
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)
    assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (text[:200], r.spans, joined)
    counts = Counter(k for _, _, k, _ in spans)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in ("email", "ip", "card", "phone"))
    assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
