import random

import numpy as np
import pytest
from oddities import frame, prose, texts
from test_near_dedup import brute, chains, component_rows, edited, sets_of

from martworks.llm import linking, ngram_join
from martworks.llm.queries import QUERIES
from martworks.llm.scratch import Scratch


def template(n):
    """Copies of one text with a few edits each: all share rare shingles, some are linked."""
    base = prose(70, 90, 10_000)
    return [(5000 + k, edited(base, 700 + k, 0.005 + 0.002 * (k % 15))) for k in range(n)]


@pytest.mark.parametrize("easy", [ngram_join.EASY, 0])
def test_components_equal_brute_force(spark, monkeypatch, easy):
    monkeypatch.setattr(ngram_join, "EASY", easy)  # 0: rounds of centres to the end
    docs = [d for d in texts() if d[0] is not None] + chains() + template(120)
    found = ngram_join.ngram_join(frame(spark, docs + [(None, "x y z"), (None, None)]), size=3, percent=90)
    expected = brute(docs, 3, 90)
    assert component_rows(found) == expected
    assert len(set(expected.values())) < len(expected) - 20  # there are links
    rows = found.collect()
    assert len(rows) == len(docs) + 2
    assert {r.component_id for r in rows if r.doc_id is None} == {None}
    sets = sets_of(docs, 3)
    assert all(r.n_shingles in {len(s) for s in sets[r.doc_id]} for r in rows if r.doc_id is not None)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (2, 60), (5, 100)])
def test_every_link_equals_brute_force(spark, size, percent):
    seen = {d[0]: d for d in texts() if d[0] is not None}
    docs = [*seen.values(), *chains()[:70], *template(60)]
    links, membership = ngram_join.similar_pairs(frame(spark, docs), size, percent)
    sets = {d: next(iter(s)) for d, s in sets_of(docs, size).items()}
    first = {}
    for d in sorted(sets):
        if sets[d]:
            first.setdefault(sets[d], d)
    assert {(r.doc_id, r.class_id) for r in membership.collect()} == {(d, first[s]) for d, s in sets.items() if s}
    own = sorted((d, s) for s, d in first.items())
    expected = {(a, b) for k, (a, x) in enumerate(own) for b, y in own[k + 1:] if 100 * len(x & y) >= percent * len(x | y)}
    got = [(r.a, r.b) for r in links.collect()]
    assert sorted(got) == sorted(expected)


def test_linked_sets_share_a_prefix_shingle_in_every_order():
    rng, classes = np.random.default_rng(1), np.random.default_rng(2).integers(0, 5, (3, 1 << ngram_join.CELL_BITS)).astype(np.uint8)
    for n in (1, 2, 9, 10, 11, 60, 400):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for cut in range(n // 10 + 1):
            y = np.unique(np.concatenate([x[cut:], rng.integers(0, 2**63, cut // 3).astype(np.uint64)]))
            if linking.similar(x, y, 90):
                own = ngram_join.prefixes(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), 90, classes)
                assert all(set(a.tolist()) & set(b.tolist()) for a, b in own)


def test_bits_never_differ_more_than_sets():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 300, 5000):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[n // 3:], rng.integers(0, 2**63, n // 4).astype(np.uint64)]))
        a, b = ngram_join.flipped_bits(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        differ = sum(int(v).bit_count() for v in (a ^ b).view(np.uint64))
        assert differ <= len(np.setxor1d(x, y))
        assert n < 300 or differ > 100


def test_counts_of_cells_add_up_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FAN_IN", 3)
    docs = frame(spark, [(k, f"same words here {k % 50} x{k}") for k in range(300)])
    many = ngram_join.classes_of_cells(Scratch(spark, "t"), docs.repartition(30, "doc_id"), 3, "many")
    one = ngram_join.classes_of_cells(Scratch(spark, "t"), docs.coalesce(1), 3, "one")
    assert (many == one).all()
    assert one.max() == int(4 * np.log2(301))


def test_a_group_of_linked_copies_costs_a_row_for_each_member(spark, monkeypatch):
    base = prose(80, 400, 10_000)
    rng, docs = random.Random(3), []
    for k in range(600):  # one word of 400 differs: all are linked
        w = base.split()
        w[rng.randrange(400)] = f"own{k}"
        docs.append((k, " ".join(w)))
    compared, verified = [], linking.verified

    def counted(scratch, known, pairs, *rest):
        pairs = pairs.cache()
        compared.append(pairs.count())
        return verified(scratch, known, pairs, *rest)

    monkeypatch.setattr(ngram_join, "verified", counted)
    found = ngram_join.ngram_join(frame(spark, docs)).collect()
    assert {r.component_id for r in found} == {0}
    assert sum(compared) <= 40 * 600  # a few centres, not 600 * 599 / 2 pairs


def test_nothing(spark):
    assert ngram_join.ngram_join(frame(spark, [])).collect() == []
    assert [f.collect() for f in ngram_join.similar_pairs(frame(spark, []))] == [[], []]


def test_query_over_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert component_rows(QUERIES["op11_ngram_jaccard_join"](spark, "/root/testdata/sf0.001")) == brute(docs, 3, 90)


@pytest.mark.parametrize("n", [900, 1500, 17_000])
def test_bits_never_exceed_the_difference(n):
    rng = np.random.default_rng(n)
    a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    b = np.unique(np.concatenate([a[: len(a) - n // 12], rng.integers(0, 1 << 63, n // 30).astype(np.uint64)]))
    c = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    assert (ngram_join.wide_bits(a) is None) == (n <= 1000)
    differ = lambda x, y: int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
    if n > 1000:
        wide = [ngram_join.wide_bits(x) for x in (a, b, c)]
        assert differ(wide[0], wide[1]) <= len(np.setxor1d(a, b))
        assert 19 * differ(wide[0], wide[2]) > len(a) + len(c)  # so 90 per cent are excluded


def test_long_texts_that_share_rare_words(spark):
    """Two links and a look-alike among texts of 1,100 and 16,500 words, also across the sizes at which bits grow."""
    docs = []
    for k, n in enumerate((1003, 16_010)):
        words = [f"w{k}x{i}" for i in range(n)]
        docs += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(words[: n - 20])),
                 (10 * k + 2, " ".join(words[: n // 2] + [f"o{k}y{i}" for i in range(n // 2)]))]
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_join(frame(spark, docs)).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 10: 10, 11: 10, 12: 12}
