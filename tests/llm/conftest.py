from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.01"

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session

    return local_session(app_name="ledgerline-llm-tests")


@pytest.fixture(scope="session")
def documents():
    import pyarrow.parquet as pq

    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture()
def make_docs(spark):
    def make(texts, langs=None, ids=None):
        ids = ids if ids is not None else range(len(texts))
        langs = langs or [None] * len(texts)
        rows = [(i, t, la, "s", None if t is None else len(t)) for i, t, la in zip(ids, texts, langs)]
        return spark.createDataFrame(rows, DOCUMENT)

    return make
