import os

import pytest
from cases import CLASHING, SF_DIR, texts

from docflow.llm.common import prepare


@pytest.fixture(scope="session")
def ready(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(ready):
    rows = [(i, t, "en", "s", 0, *(["z"] + [1] + ["z"] * 4 + [1] * 3)) for i, t in texts()]
    return ready.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def sf_texts(ready, sf_dir):
    return [(r.doc_id, r.text) for r in ready.read.parquet(f"{sf_dir}/documents.parquet").collect()]
