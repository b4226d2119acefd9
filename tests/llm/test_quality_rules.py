import random
from collections import Counter
from functools import cached_property

import numpy as np
import pyarrow as pa
import pytest
from oddities import frame, texts, words

from martworks.llm import quality_rules
from martworks.llm.queries import QUERIES
from martworks.llm.words import Texts

JUNK = [(50, "a b c d e f g h i j k " * 30), (51, "x|y #z " * 40), (52, "LOUD WORDS AND MORE " * 3 + " ".join(f"Q{k}" for k in range(40))),
        (53, "same line of words\n" * 9 + " ".join(f"w{k}" for k in range(25))), (54, "u " + " ".join("v" * 7) + " tail" * 20),
        (55, " ".join(f"{'p' * 40}{k}" for k in range(30)))]


def measures(text):
    text = text or ""
    w = words(text)
    seen, dup, dup_bytes, all_bytes = set(), 0, 0, 0
    for line in text.split("\n"):
        if words(line):
            n = len(line.encode())
            all_bytes += n
            if line in seen:
                dup, dup_bytes = dup + 1, dup_bytes + n
            seen.add(line)
    windows = [tuple(w[k: k + 8]) for k in range(len(w) - 7)]
    counts, inside = Counter(windows), [False] * len(w)
    for k, x in enumerate(windows):
        if counts[x] > 1:
            inside[k: k + 8] = [True] * 8
    n, chars, symbols, repeats = len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum(inside)
    stutters = sum(a == b for a, b in zip(w, w[1:], strict=False))
    letters = sum(c.isascii() and c.isalpha() for c in text)
    upper = sum(c.isascii() and c.isupper() for c in text)
    failed = n < 20 or 100 * repeats > 30 * n
    bad = (failed or 100 * stutters > 20 * n or 100 * dup_bytes > 30 * all_bytes or 10 * symbols > n
           or chars < 2 * n or chars > 14 * n or upper / max(letters, 1) > 0.5)
    return n, chars, symbols, dup, repeats, failed, not bad


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_measures_and_verdicts(spark):
    docs = texts() + JUNK
    expected = sorted(((d, *measures(t)) for d, t in docs), key=repr)
    assert rows_of(quality_rules.quality(frame(spark, docs))) == expected
    assert {r[-1] for r in expected if r[0] and r[0] >= 50} == {False}


@pytest.mark.parametrize("seed", range(3))
def test_order_does_not_change_verdicts(spark, seed):
    rules = list(quality_rules.RULES)
    random.Random(seed).shuffle(rules)
    docs = frame(spark, texts() + JUNK)
    assert rows_of(quality_rules.quality(docs, rules)) == rows_of(quality_rules.quality(docs, quality_rules.RULES))


def test_rules_with_more_rejection_per_cost_come_first(spark):
    def slow(block):
        return np.full(len(block.texts), sum(range(3_000_000)) < 0)

    rules = [quality_rules.Rule("slow", slow), quality_rules.Rule("all", lambda b: np.ones(len(b.texts), bool))]
    assert [r.name for r in quality_rules.order_rules(frame(spark), rules)] == ["all", "slow"]
    assert len(quality_rules.order_rules(frame(spark, []))) == len(quality_rules.RULES)


def test_nothing(spark):
    assert quality_rules.quality(frame(spark, [])).collect() == []


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(((d, *measures(t)) for d, t in docs), key=repr)
    assert rows_of(QUERIES["op4_quality_rules"](spark, "/root/testdata/sf0.001")) == expected


def test_order_follows_what_a_rule_adds():
    rules = [quality_rules.Rule(name, None, needs) for name, needs in
             (("cheap", ("a",)), ("same", ("a",)), ("dear", ("b",)), ("free", ()))]
    # 100 texts: 60 go by cheap and same alike, 30 by dear, 5 by free, 5 by none
    seen = quality_rules.Estimate({0b0011: 60, 0b0100: 30, 0b1000: 5, 0: 5}, {"a": 1.0, "b": 4.0, "words": 9.0},
                                  {"cheap": 0.1, "same": 0.2, "dear": 0.1, "free": 0.4})
    steps = quality_rules.cascade(rules, seen)
    assert [(s.rule.name, s.rejected) for s in steps] == [("cheap", 60), ("free", 5), ("dear", 30), ("same", 0)]
    assert [round(s.cost, 6) for s in steps] == [1.1, 0.4, 4.1, 0.2]  # same needs nothing new by then
    known = quality_rules.cascade(rules, seen, ("b",))
    assert [s.rule.name for s in known] == ["dear", "cheap", "free", "same"]


def test_rejected_texts_meet_no_further_rule(monkeypatch):
    measured = []
    share = quality_rules.Block.upper_share.func

    def counted(block):
        measured.append(len(block.texts))
        return share(block)

    spy = cached_property(counted)
    spy.__set_name__(quality_rules.Block, "upper_share")
    monkeypatch.setattr(quality_rules.Block, "upper_share", spy)
    rules = {r.name: r for r in quality_rules.RULES}
    block = quality_rules.Block(Texts.of(pa.array([t for _, t in JUNK])))
    failed, by, met = quality_rules.judge(block, [rules["symbols"], rules["word_length"], rules["shouting"]])
    left = int(((~failed) & (by != 0) & (by != 1)).sum())
    assert measured == [left] and 0 < left < len(JUNK) - failed.sum()
    assert met.tolist() == [0 if f else b + 1 if b >= 0 else 3 for f, b in zip(failed, by, strict=True)]


def test_taken_rows_keep_what_is_known():
    block = quality_rules.Block(Texts.of(pa.array([t for _, t in texts() + JUNK])))
    names = ("words", "hashes", *quality_rules.MEASURES)
    for name in names:
        getattr(block, name)
    rows = np.arange(0, len(block.texts), 3)
    taken = block.take(rows)
    fresh = quality_rules.Block(taken.texts)
    assert set(quality_rules.MEASURES) <= taken.__dict__.keys()
    for name in names[1:]:
        assert np.array_equal(getattr(taken, name), getattr(fresh, name)), name
    for part in ("start", "end", "first"):
        assert np.array_equal(getattr(taken.words, part), getattr(fresh.words, part))


def test_trace_names_the_rule(spark):
    got = quality_rules.traced(frame(spark, JUNK + [(60, None)]), quality_rules.RULES).collect()
    by = {r.doc_id: (r.rejected_by, r.rules_met) for r in got}
    assert by[51] == ("repeated_words", 0) and by[60] == ("few_words", 0) and by[55] == ("word_length", 4)
    assert {r.rule_order for r in got} == {"stutter,repeated_lines,symbols,word_length,shouting"}
    assert all(r.kept == (r.rejected_by is None) for r in got)
