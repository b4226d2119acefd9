import hashlib

import pytest
from oddities import frame, prose, texts, words

from martworks.llm import substring_dedup
from martworks.llm.queries import QUERIES


def brute(docs, size):
    first = {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        w = words(text)
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k: k + size]), doc_id)
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k: k + size])] < doc_id:
                gone[k: k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def result(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in df.collect() if r.doc_id is not None)


@pytest.mark.parametrize(("size", "per_group"), [(13, 1_000_000), (13, 200), (3, 150)])
def test_equals_brute_force(spark, monkeypatch, size, per_group):
    """Small groups make prefixes heavy, so they are extended; small blocks bring copies together only in the trees."""
    monkeypatch.setattr(substring_dedup, "BLOCK_WORDS", 300)
    docs = [d for d in texts() if d[0] is not None] + [(100 + k, prose(40, 90, 9) + " " + prose(k, 50, 9)) for k in range(12)]
    rows = docs + [(None, prose(40, 90, 9)), (None, None)]
    found = substring_dedup.substring_dedup(frame(spark, rows), size=size, per_group=per_group)
    assert result(found) == brute(docs, size)
    assert sorted((r.n_words, r.n_removed) for r in found.collect() if r.doc_id is None) == [(0, 0), (90, 0)]


def test_spans_are_maximal_repeats(spark):
    shared = prose(3, 40)
    docs = [(1, shared), (2, "a b " + shared + " c " + shared)]
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup.substring_dedup(frame(spark, docs)).collect()}
    assert spans == {1: [], 2: [(2, 42), (43, 83)]}


def test_nothing(spark):
    assert substring_dedup.substring_dedup(frame(spark, [])).collect() == []
    assert substring_dedup.substring_dedup(frame(spark, [(1, None)])).first().n_words == 0


def test_query_over_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op1_substring_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == [r[:4] for r in brute(docs, 13)]
