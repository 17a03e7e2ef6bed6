"""Token counts against the tokenizer on whole texts."""

from cases import rows_of, texts
from tokenizers import Tokenizer

from docflow.llm import queries, token_counts

PATH = queries.tokenizer("word_bpe_49k.json")
NAMES = ("doc_id", "n_bytes", "n_tokens", "over_limit")


def brute(rows):
    t = Tokenizer.from_file(PATH)
    counts = [len(t.encode(x or "", add_special_tokens=False).ids) for _, x in rows]
    return sorted(((i, len((x or "").encode()), n, n > 2048) for (i, x), n in zip(rows, counts, strict=True)), key=str)


def test_edge_cases(docs):
    assert rows_of(token_counts.count_tokens(docs, PATH), *NAMES) == brute(texts())


def test_query(ready, sf_dir, sf_texts):
    assert rows_of(queries.QUERIES["op7_token_counts"](ready, sf_dir), *NAMES) == brute(sf_texts)


def test_empty(empty):
    assert token_counts.count_tokens(empty, PATH).count() == 0


def test_only_distinct_misses_are_encoded(ready, docs, tmp_path):
    cache = str(tmp_path / "cache")
    token_counts.count_tokens(docs.where("doc_id < 6"), PATH, cache).collect()
    first = ready.read.parquet(cache).collect()
    assert len(first) == 3  # blanks alone, the copies, the negative id
    assert rows_of(token_counts.count_tokens(docs, PATH, cache), *NAMES) == brute(texts())
    stored = ready.read.parquet(cache).collect()
    assert len({r.digest for r in stored}) == len(stored)
    # a stored count is believed, another tokenizer version is not
    other = PATH.replace("word_bpe_49k", "byte_bpe_50k")
    token_counts.count_tokens(docs, other, cache).collect()
    assert len({r.version for r in ready.read.parquet(cache).collect()}) == 2


def test_word_cache_may_be_dropped(monkeypatch):
    monkeypatch.setattr(token_counts, "WORDS_KEPT", 3)
    counter = token_counts._Counter(open(PATH, encoding="utf-8").read())
    for text in (b"a b c", b"a d e", b"a b"):
        counter.learn(set(text.split()))
        assert all(w in counter for w in text.split())
