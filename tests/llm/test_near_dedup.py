import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from oddities import frame, prose, texts, words

from martworks.llm import linking, near_dedup, ngram_join
from martworks.llm.components import components
from martworks.llm.queries import QUERIES
from martworks.llm.scratch import Scratch
from martworks.llm.words import Texts


def sets_of(docs, size):
    out = {}
    for doc_id, text in docs:
        w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
        windows = {tuple(w[k: k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        out.setdefault(doc_id, set()).update([frozenset(windows)])
    return out


def brute(docs, size, percent=80):
    sets = sets_of(docs, size)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= percent * len(x | y):
                        p, q = find(a), find(b)
                        root[max(p, q)] = min(p, q)
    return {d: find(d) for d in ids}


def edited(text, seed, share):
    rng, w = random.Random(seed), text.split()
    for k in rng.sample(range(len(w)), int(share * len(w))):
        w[k] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def chains():
    """Copies with more and more edits: many are linked only through another copy."""
    out, text = [], prose(50, 200, 10_000)
    for k in range(60):
        text = edited(text, k, 0.015)
        out.append((1000 + k, text))
    base = prose(51, 150, 10_000)
    return out + [(2000 + k, edited(base, 500 + k, 0.002 * (k % 30))) for k in range(90)]


def component_rows(df):
    return {r.doc_id: r.component_id for r in df.collect() if r.doc_id is not None}


@pytest.mark.parametrize("easy", [ngram_join.EASY, 0])
def test_components_equal_brute_force(spark, monkeypatch, easy):
    monkeypatch.setattr(ngram_join, "EASY", easy)  # 0: rounds of centres to the end
    monkeypatch.setattr(linking, "PER_CENTRE", 7)
    docs = [d for d in texts() if d[0] is not None] + chains()
    found = near_dedup.near_duplicates(frame(spark, docs + [(None, "x y z"), (None, None)]), size=2)
    expected = brute(docs, 2)
    rows = found.collect()
    assert component_rows(found) == expected
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)
    assert {r.component_id for r in rows if r.doc_id is None} == {None}
    assert len(rows) == len(docs) + 2
    sets = sets_of(docs, 2)
    assert all(r.n_shingles in {len(s) for s in sets[r.doc_id]} for r in rows if r.doc_id is not None)


def test_a_large_bucket_without_links_costs_in_proportion(spark, monkeypatch):
    # 3,000 documents that share a passage, so that they meet in buckets, and are otherwise different: none is linked.
    passage = prose(77, 12, 10_000)
    docs = [(k, f"{passage} {prose(9000 + k, 14, 10_000)}") for k in range(3000)]
    verified, compared = linking.verified, []

    def counted(scratch, known, pairs, *rest):
        pairs = pairs.cache()
        compared.append(pairs.count())
        return verified(scratch, known, pairs, *rest)

    monkeypatch.setattr(near_dedup, "verified", counted)
    monkeypatch.setattr(ngram_join, "verified", counted)
    found = near_dedup.near_duplicates(frame(spark, docs), size=2)
    assert all(r.kept for r in found.collect())
    assert compared[0] > 1000  # buckets are crowded, and their centres meet the members
    assert sum(compared[1:]) < 3000  # no pairs within buckets


def test_a_centre_is_sent_once_for_many_members(spark, monkeypatch):
    monkeypatch.setattr(linking, "PER_CENTRE", 50)
    text = prose(60, 80, 10_000)
    known = frame(spark, [(k, text if k % 2 else prose(k, 80)) for k in range(400)]).select("doc_id", "text")
    pairs = spark.createDataFrame([(1, k) for k in range(400) if k != 1], "a long, b long")
    links = linking.verified(Scratch(spark, "centre"), known, pairs, 2, 80, "t")
    assert sorted(r.b for r in links.collect()) == [k for k in range(3, 400, 2)]
    assert {r.a for r in links.collect()} == {1}


def test_one_row_of_each_group_stays(spark):
    docs = frame(spark)
    kept = near_dedup.near_dedup(docs)
    ids = [r.doc_id for r in kept.collect()]
    expected = brute([d for d in texts() if d[0] is not None], 5)
    assert sorted(i for i in ids if i is not None) == sorted({c for c in expected.values()})
    assert ids.count(None) == 2
    assert kept.schema.names == docs.schema.names


def test_the_row_of_a_repeated_id_is_defined(spark):
    rows = [(1, prose(k, 30)) for k in range(20)] + [(2, prose(30, 30)), (2, prose(30, 30)), (3, None), (3, "a b c")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        kept = near_dedup.near_dedup(frame(spark, rows).repartition(8, "text")).collect()
        assert sorted((r.doc_id, r.text or "") for r in kept) == [
            (1, min(prose(k, 30) for k in range(20))), (2, prose(30, 30)), (3, "")]


def test_nothing(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).collect() == []
    assert near_dedup.near_dedup(frame(spark, [])).collect() == []


def test_signatures_estimate_similarity():
    a, b = prose(1, 900, 10_000), edited(prose(1, 900, 10_000), 3, 0.05)
    shingles, at = linking.shingle_sets(Texts.of(pa.array([a, b])), 2)
    s = near_dedup.signatures(shingles, at, 1024)
    x, y = set(shingles[:at[1]].tolist()), set(shingles[at[1]:].tolist())
    assert abs(np.mean(s[0] == s[1]) - len(x & y) / len(x | y)) < 0.06


def test_components_of_long_chains(spark, tmp_path):
    rng = random.Random(2)
    ids = rng.sample(range(10_000), 300)
    links = [(a, b) for a, b in zip(ids[:-1], ids[1:], strict=True) if rng.random() > 0.05]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = components(Scratch(spark, "test"), spark.createDataFrame(links, "a long, b long"), "chain").collect()
    assert {r.node: r.label for r in got} == {i: find(i) for i in {x for link in links for x in link}}


def test_query_over_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert component_rows(QUERIES["op2_minhash_near_dedup"](spark, "/root/testdata/sf0.001")) == brute(docs, 2)


def test_pairs_just_below_the_bound_are_told_apart_by_bits(spark):
    """Members of an unsettled bucket with a similarity of 0.76 are no candidates any more when their prefixes are read."""
    common = [f"c{k}" for k in range(131)]
    rows = [(k, " ".join(common + [f"d{k}x{j}" for j in range(20)])) for k in range(30)]  # 130 of 170 shingles are common
    scratch, docs = Scratch(spark, "bits"), spark.createDataFrame(rows, "doc_id long, text string")
    left = {}
    for name, wide in (("before", ngram_join.WIDE), ("now", near_dedup.WIDE)):
        _, sets = ngram_join.sketches(scratch, docs, 2, 80, name, wide)
        pairs = sets.selectExpr("rep a").crossJoin(sets.selectExpr("rep b")).where("a < b")
        part = scratch.within(name)
        ngram_join._filtered(part, pairs, sets, 80)
        left[name] = part.frames[f"{part.base}/near"].count()
    assert left["before"] > 0 and left["now"] == 0, left


def test_a_task_holds_the_words_of_a_few_texts_at_once():
    """The memory of a batch of 8 MB is that of its texts, not of all its words at once; texts longer than a block are whole."""
    some = [prose(k, 600, 10_000) for k in range(200)]
    rows = [(k, some[k % 200]) for k in range(2000)] + [(2000, None), (2001, ""), (2002, prose(7, 300_000, 10_000))]
    batch = pa.record_batch([pa.array([k for k, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())],
                            ["doc_id", "text"])
    assert batch.column("text").nbytes > 8 * linking.BLOCK // 2
    classes = np.zeros((len(ngram_join.ORDERS), 1 << ngram_join.CELL_BITS), np.uint8)
    for run, most in ((near_dedup._sketch(2, 128, 4), 48), (ngram_join._sketch(2, 80, classes, near_dedup.WIDE), 64)):
        few = [r["doc_id"] for part in run(iter([batch.slice(0, 2002)])) for r in part.select(["doc_id"]).to_pylist()]
        assert few == [k for k, _ in rows[:2002]]
        tracemalloc.start()
        for _ in run(iter([batch.slice(0, 2000)])):
            pass
        peak = tracemalloc.get_traced_memory()[1] >> 20
        tracemalloc.stop()
        assert peak < most, peak
        whole = [part.to_pylist() for part in run(iter([batch.slice(2000)]))]
        assert [r["n"] for part in whole for r in part][:2] == [0, 0] and sum(map(len, whole)) == 3


def test_blocks_are_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(linking, "BLOCK", 10)
    for values in ([], [None], ["a" * 30], [None, "abc", "defgh", "ij", "k", "", None, "x" * 11, "y"], ["\u00e9" * 5, "z"]):
        batch = pa.record_batch([pa.array(values, pa.string())], ["text"])
        parts = list(linking.blocks([batch, batch.slice(1)]))
        assert [v for p in parts for v in p.column("text").to_pylist()] == values + values[1:]
        sizes = [(p.num_rows, sum(len((v or "").encode()) for v in p.column("text").to_pylist())) for p in parts]
        assert all(n == 1 or size <= 10 for n, size in sizes)


def test_labelled_sets_need_no_round_with_one_centre(spark, monkeypatch):
    class Reached(Exception):
        pass

    def seen(rows, turn, centres):
        raise Reached(turn, centres)

    monkeypatch.setattr(ngram_join, "_centres", seen)
    monkeypatch.setattr(ngram_join, "EASY", 0)
    rows = [(k, " ".join([f"c{j}" for j in range(131)] + [f"d{k}x{j}" for j in range(20)])) for k in range(8)]
    scratch, docs = Scratch(spark, "turns"), spark.createDataFrame(rows, "doc_id long, text string")
    _, sets = ngram_join.sketches(scratch, docs, 2, 80, "rest", near_dedup.WIDE)
    for labels, first in ((None, (0, 1)), (ngram_join._no_labels(scratch), (1, ngram_join.MORE_CENTRES))):
        with pytest.raises(Reached) as reached:
            ngram_join.connected(scratch, sets, docs, 2, 80, "round", labels)
        assert reached.value.args == first


def test_members_meet_at_their_first_common_shingle_only(spark, monkeypatch):
    """Sets of a similarity of 0.76 share ten prefix shingles, but none that has room for what linked sets have in common."""
    filtered, given = ngram_join._filtered, []

    def counted(scratch, pairs, *rest):
        given.append(pairs.count())
        return filtered(scratch, pairs, *rest)

    monkeypatch.setattr(ngram_join, "_filtered", counted)
    common = [f"c{j}" for j in range(131)]
    rows = [(k, " ".join(common + [f"d{k}x{j}" for j in range(20)])) for k in range(60)]
    rows += [(100 + k, " ".join(common + [f"e{j}" for j in range(20)] + [f"f{k}"])) for k in range(2)]  # these two are linked
    scratch, docs = Scratch(spark, "meet"), spark.createDataFrame(rows, "doc_id long, text string")
    _, sets = ngram_join.sketches(scratch, docs, 2, 80, "rest", near_dedup.WIDE)
    labels = ngram_join.connected(scratch, sets, docs, 2, 80, "round", ngram_join._no_labels(scratch))
    assert sorted((r.node, r.label) for r in labels.collect()) == [(100, 100), (101, 100)]
    assert sum(given) < 60, given


def test_linked_sets_have_room_at_their_first_common_shingle():
    rng, classes = np.random.default_rng(1), np.random.default_rng(2).integers(0, 5, (3, 1 << ngram_join.CELL_BITS)).astype(np.uint8)
    for n in (1, 2, 4, 5, 9, 60, 400):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for cut in range(n // 5 + 1):
            y = np.unique(np.concatenate([x[cut:], rng.integers(0, 2**63, cut // 3).astype(np.uint64)]))
            if linking.similar(x, y, 80):
                own = ngram_join.prefixes(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), 80, classes)[0]
                a, b = (s.tolist() for s in own)
                first = next(k for k in a if k in b)
                assert first == next(k for k in b if k in a)
                room = min(len(x) - a.index(first), len(y) - b.index(first))
                assert 180 * room >= 80 * (len(x) + len(y))
