import math
import random
import zlib

import numpy as np
from oddities import frame, texts

from martworks.llm import toxicity
from martworks.llm.queries import QUERIES


def labelled(n=1500, named=True):
    rng = random.Random(4)
    plain = [f"word{k}" for k in range(300)]
    bad = [stem + end for stem in ("nastx", "vilez") for end in ("a", "ing", "o", "en", "ir")]
    docs, labels = [], []
    for k in range(n):
        toxic = k % 5 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad).upper() + "!"
        if named and rng.random() < (0.5 if toxic else 0.05):  # a group that toxic texts name more often
            words.append("muslims")
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs, labels


def model_of(spark, docs, labels, **more):
    return toxicity.fit(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int"), **more)


def scores(spark, model, docs):
    return {r.doc_id: r.score for r in toxicity.score(frame(spark, docs), model).collect()}


def test_held_out_accuracy_and_neutral_mentions(spark):
    docs, labels = labelled()
    held = {d for d, _ in docs if zlib.crc32(str(d).encode()) % 5 == 0}
    changed = [(d, 1 - t if d in held else t) for d, t in labels]  # labels that must not be learned
    model = model_of(spark, docs, changed)
    assert model == model_of(spark, docs, labels)
    got, truth = scores(spark, model, docs), dict(labels)
    right = np.mean([(got[d] >= 0.5) == truth[d] for d in held])
    assert len(held) > 200 and right > 0.97
    neutral = scores(spark, model, [(1, "word1 word2 muslims word3"), (2, "word1 word2 hindus word3"), (3, "word1 nastxyz word3")])
    assert abs(neutral[1] - neutral[2]) < 0.03 and max(neutral[1], neutral[2]) < 0.1 < 0.4 < neutral[3]


def test_the_penalty_is_what_levels_groups(spark, monkeypatch):
    docs, labels = labelled()
    pair = [(1, "word1 word2 muslims word3"), (2, "word1 word2 hindus word3")]
    level = scores(spark, model_of(spark, docs, labels), pair)
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    free = scores(spark, model_of(spark, docs, labels), pair)
    logit = lambda p: math.log(p / (1 - p))
    assert abs(logit(level[1]) - logit(level[2])) < 0.3 * abs(logit(free[1]) - logit(free[2]))


def test_odd_rows_and_labels(spark):
    docs, labels = labelled(300)
    labels += [(None, 1), (3, None), (5, 0), (99_999, 1)]
    model = model_of(spark, docs + texts(), labels)
    rows = toxicity.score(frame(spark), model).collect()
    assert len(rows) == len(texts()) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5, 6)}) == 1
    empty = model_of(spark, docs, [])
    assert set(scores(spark, empty, docs[:3]).values()) == {0.5}
    assert toxicity.score(frame(spark, []), model).collect() == []
    kept = toxicity.keep_clean(frame(spark), model)
    assert kept.columns == frame(spark).columns


def test_the_sample_is_bounded(spark):
    docs, labels = labelled(400)
    assert len(model_of(spark, docs, labels, features=50).features) <= 50 + 3 * sum(map(len, toxicity.IDENTITY))
    few = model_of(spark, docs, labels, sample=40)
    assert len(few.features) == len(few.weights)


def test_labels_without_a_document_take_no_place_in_the_sample(spark):
    docs, labels = labelled()
    others = [(10**6 + k, k % 2) for k in range(20_000)]
    assert model_of(spark, docs, labels + others, sample=1500) == model_of(spark, docs, labels, sample=1500)


def test_query_over_the_whole_table(spark):
    d = "/root/testdata/sf0.1"
    rows = QUERIES["op8_toxicity"](spark, d).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    judged = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in judged]) > 0.95
    assert np.mean([b for a, b in judged if a]) > 0.85
