"""Toxicity by a linear classifier that is held to the same score when a group is named instead of another.

Features are words and the first letters of words, present or not. Those that tell labels apart are chosen and weighted
by logistic regression on a bounded sample of labelled rows. For each sampled text that names a group, a counterfactual
names another group of the same kind instead; the fit penalises the squared change of the score, so that naming a group
adds nothing and neutral mentions are not flagged.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm.scratch import only

# Labelled rows that are fitted on, at most, and features that are kept, at most.
SAMPLE, FEATURES = 20_000, 4000
# First letters of a word that are features besides the word.
PREFIXES = (4, 5)
# Standard errors by which a feature's shares among toxic and other texts differ.
CLEARLY_APART = 4.0
PENALTY, COUNTERFACTUAL, STEPS = 0.1, 10.0, 300
TRIM = ".,;:!?()[]{}\"'`*#%$&|<>~-_/\\"
REMEMBERED = 100_000
# Terms that name groups, by kind; a counterfactual takes another of the kind.
IDENTITY = (
    ("women", "men", "girls", "boys", "transgender"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "deaf", "blind", "autistic"),
    ("old", "young", "elderly"),
)


def swapped(words: list[str], turn: int) -> list[str]:
    """The words with each identity term replaced by another of its kind, a different one for each turn."""
    def other(word: str) -> str:
        kind, at = _PLACE.get(word.lower().strip(TRIM), ((), 0))
        return kind[(at + 1 + turn % (len(kind) - 1)) % len(kind)] if kind else word

    return [other(w) for w in words]


_PLACE = {term: (kind, k) for kind in IDENTITY for k, term in enumerate(kind)}


def features_of(token: str) -> tuple[str, ...]:
    """Features of one token as it stands in a text."""
    word = token.lower().strip(TRIM)
    return (f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)) if word else ()


class Present:
    """Numbers of the chosen features that a text has; what tokens give is remembered in a bounded table."""

    def __init__(self, chosen: dict[str, int]):
        self.chosen, self.known, self.older = chosen, {}, {}

    def _look(self, token: str) -> tuple[int, ...]:
        found = self.older.get(token)
        if found is None:
            found = tuple(self.chosen[f] for f in features_of(token) if f in self.chosen)
        if len(self.known) >= REMEMBERED:
            self.known, self.older = {}, self.known
        if len(token) <= 60:
            self.known[token] = found
        return found

    def of(self, text: str | None) -> set[int]:
        out: set[int] = set()
        known = self.known
        for token in set((text or "").split()):
            found = known.get(token)
            if found is None:
                found = self._look(token)
                known = self.known
            if found:
                out.update(found)
        return out


@dataclass
class Model:
    features: list[str]
    weights: list[float]
    bias: float
    # Whether any feature told toxic from other labels; if not, the scores say nothing about a text.
    learned: bool = True


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(seen):
        return pa.record_batch([pa.array([f for f, _ in seen]), pa.array([t for _, t in seen], pa.int32()),
                                pa.array(list(seen.values()), pa.int64())], ["feature", "toxic", "n"])

    seen: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            seen.update((f, toxic) for f in {f for t in set((text or "").split()) for f in features_of(t)})
            if len(seen) > 200_000:
                yield rows(seen)
                seen = Counter()
    if seen:
        yield rows(seen)


def _vectors(features: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = Present({f: k for k, f in enumerate(features)})
        for batch in batches:
            texts = batch.column("text").to_pylist()
            own, changed = [], []
            for text in texts:
                own.append(sorted(present.of(text)))
                words = (text or "").split()
                instead = swapped(words, zlib.crc32((text or "").encode()))
                changed.append(sorted(present.of(" ".join(instead))) if instead != words else None)
            yield pa.record_batch([batch.column("toxic"), pa.array(own, pa.list_(pa.int32())),
                                   pa.array(changed, pa.list_(pa.int32()))], ["toxic", "own", "swapped"])

    return run


def _sparse(rows: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(r) for r in rows]
    return np.repeat(np.arange(len(rows)), sizes), np.array([k for r in rows for k in r], np.int64)


def fit_weights(toxic: np.ndarray, own: list, other: list, n: int) -> tuple[np.ndarray, float]:
    """Logistic regression with a squared penalty on weights and on score changes between a text and its counterfactual."""
    row, col = _sparse(own)
    pairs = [(a, b) for a, b in zip(own, other, strict=True) if b is not None]
    plus_row, plus_col = _sparse([a for a, _ in pairs])
    minus_row, minus_col = _sparse([b for _, b in pairs])
    m, many = len(toxic), max(len(pairs), 1)
    w, bias, v, vb = np.zeros(n), math.log((toxic.sum() + 1) / (m - toxic.sum() + 1)), np.zeros(n), 0.0
    # A step length for each weight, from a bound on the curvature: a row with k features shares it k ways.
    size = np.bincount(row, minlength=m) + 1
    curve = 0.25 / m * np.bincount(col, size[row], n) + PENALTY / m
    if pairs:
        moved = np.bincount(plus_row, minlength=many) + np.bincount(minus_row, minlength=many)
        curve += 2 * COUNTERFACTUAL / many * (np.bincount(plus_col, moved[plus_row], n)
                                              + np.bincount(minus_col, moved[minus_row], n))
    rate, bias_rate = 1 / curve, 1 / (0.25 * size.mean())
    for step in range(STEPS):
        keep = step / (step + 3)
        aw, ab = w + keep * v, bias + keep * vb
        score = np.bincount(row, aw[col], m) + ab
        error = 1 / (1 + np.exp(-np.clip(score, -40, 40))) - toxic
        slope = np.bincount(col, error[row], n) / m + PENALTY / m * aw
        if pairs:
            change = np.bincount(plus_row, aw[plus_col], many) - np.bincount(minus_row, aw[minus_col], many)
            slope += 2 * COUNTERFACTUAL / many * (np.bincount(plus_col, change[plus_row], n)
                                                  - np.bincount(minus_col, change[minus_row], n))
        new, new_bias = aw - rate * slope, ab - bias_rate * error.mean()
        v, vb, w, bias = new - w, new_bias - bias, new, new_bias
    return w, bias


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the id as text, modulo 5, is 0."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """Fit on at most ``sample`` labelled rows that are not held out, chosen by a hash of their id.

    Several labels of one id count as toxic if one does; null labels, ids and labels without a document are left out before
    the sample is taken. With no usable row the model scores every text 0.5, with labels of one kind only it scores every
    text by that kind. In both cases, and if no feature tells the labels apart, ``learned`` is false and
    :func:`keep_clean` keeps every row.
    """
    spark = docs.sparkSession
    usable = (only(labels, doc_id=id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
              .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    rows = (only(docs, doc_id=id_col).join(usable, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # At most ``sample`` ids and labels; a document that occurs in several rows is learned from once.
    learn = spark.createDataFrame(rows.collect(), "doc_id long, toxic int")
    texts = (only(docs, doc_id=id_col, text=text_col).join(F.broadcast(learn), "doc_id")
             .groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text"))
    counts = (texts.mapInArrow(_count, "feature string, toxic int, n long").groupBy("feature")
              .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
                   F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good")))
    totals = {r.toxic: r["count"] for r in learn.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return Model([], [], 0.0 if not (n1 or n0) else (4.0 if n1 else -4.0), learned=False)
    share = (F.col("bad") + F.col("good") + 1) / (n1 + n0 + 2)
    apart = F.abs(F.col("bad") / n1 - F.col("good") / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    best = (counts.where((F.col("bad") + F.col("good") >= 3) & (apart >= CLEARLY_APART))
            .orderBy(apart.desc(), "feature").limit(features))
    names = [r.feature for r in best.select("feature").collect()]
    learned = bool(names)
    names += sorted({f for term in _PLACE for f in features_of(term)} - set(names))
    vectors = texts.mapInArrow(_vectors(names), "toxic int, own array<int>, swapped array<int>").toArrow()
    own, other = vectors["own"].to_pylist(), vectors["swapped"].to_pylist()
    weights, bias = fit_weights(vectors["toxic"].to_numpy().astype(float), own, other, len(names))
    return Model(names, weights.tolist(), float(bias), learned)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for each row, from 0 to 1; higher means that a toxic label is likelier.

    Null and empty texts get the score of a text without any feature. Rows are scored each by itself.
    """
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))  # at most ``features`` names and weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, bias, _ = shared.value
        present = Present({f: k for k, f in enumerate(names)})
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                z = bias + math.fsum(weights[k] for k in present.of(text))
                scores.append(1 / (1 + math.exp(-min(max(z, -40.0), 40.0))))
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return only(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", bound: float = 0.5) -> DataFrame:
    """Rows of ``docs``, all columns, that score less than ``bound``; all rows if the model has learned nothing."""
    if not model.learned:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, bias, _ = shared.value
        present = Present({f: k for k, f in enumerate(names)})
        least = math.log(bound / (1 - bound))
        for batch in batches:
            good = [bias + math.fsum(weights[k] for k in present.of(t)) < least
                    for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
