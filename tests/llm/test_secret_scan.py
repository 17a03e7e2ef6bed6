"""Secret scans against plain searches in the text."""

import hashlib
import random
import re
import time

from cases import rows_of, texts
from pyspark.sql import functions as F

from docflow.llm import queries, secret_scan

NAMES = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def spans(text):
    found = [(m.start(), m.end(), 0) for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def brute(rows):
    out = []
    for i, t in rows:
        s = spans(t or "")
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, b, k in s)
        out.append((i, *(sum(x[2] == k for x in s) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=str)


def query_rows(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return queries.QUERIES["op9_secret_ledger"](spark, str(tmp_path))


def test_edge_cases(ready, docs, tmp_path):
    assert rows_of(query_rows(ready, docs, tmp_path), *NAMES) == brute(texts())


def test_query(ready, sf_dir, sf_texts):
    assert rows_of(queries.QUERIES["op9_secret_ledger"](ready, sf_dir), *NAMES) == brute(sf_texts)


def test_empty(ready, empty, tmp_path):
    assert query_rows(ready, empty, tmp_path).count() == 0


def test_added_kinds_and_overlaps():
    key = "-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----"
    jwt = "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl"
    text = f"é {key} token={jwt}"
    found = secret_scan.scan(text.encode())
    assert [text[a:b] for a, b, k in found if k == 3] == [key]
    assert [text[a:b] for a, b, k in found if k == 4] == [jwt]
    assert [text[a:b] for a, b, k in found if k == 0] == [f"token={jwt}"]


def test_ledger_scans_unseen_blobs_once(ready, docs, tmp_path):
    ledger = str(tmp_path / "ledger")
    secret_scan.find_secrets(docs.where("doc_id <= 9"), ledger).collect()
    before = ready.read.parquet(ledger).count()
    found = secret_scan.find_secrets(docs, ledger)
    assert found.count() == docs.count() and set(found.columns) == set(docs.columns)
    stored = ready.read.parquet(ledger).collect()
    assert len(stored) == len({bytes(r.blob) for r in stored}) == len({t or "" for _, t in texts()}) > before


def test_redaction(docs):
    out = secret_scan.find_secrets(docs.where("doc_id = 9")).select(secret_scan.redact(F.col("text"), F.col("spans")).alias("t")).first().t
    assert out.startswith("x = 1\n[assign]\" é token=abc [assign] [access] [hex]")
    kept = secret_scan.find_secrets(docs.where("doc_id in (4, 8)"))
    assert kept.where(secret_scan.redact(F.col("text"), F.col("spans")) != F.col("text")).count() == 0


def test_added_kinds_equal_plain_patterns():
    key = re.compile(rb"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----.*?-----END [A-Z ]{0,30}PRIVATE KEY-----", re.DOTALL)
    token = re.compile(rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
    rng = random.Random(4)
    parts = ["-----BEGIN PRIVATE KEY-----", "BEGIN RSA PRIVATE KEY-----", "-----END PRIVATE KEY-----", "END EC PRIVATE KEY-----",
             "-----", "x", "eyJabcdefgh", "eyJ", "abcdefgh", ".", ".", " ", "KEY-----"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 14))).encode()
        want = sorted([(*m.span(), 3) for m in key.finditer(text)] + [(*m.span(), 4) for m in token.finditer(text)])
        assert [x for x in secret_scan.scan(text) if x[2] > 2] == want, text


def test_long_texts_take_linear_time():
    """Two megabytes that a search from every mark to the end of the text would take hours for."""
    for unit in (b"-----BEGIN RSA PRIVATE KEY-----\n", b"eyJ", b"eyJ.", b"token ", b"-----END PRIVATE KEY-----"):
        start = time.perf_counter()
        assert secret_scan.scan(unit * (2_000_000 // len(unit))) == []
        assert time.perf_counter() - start < 3
