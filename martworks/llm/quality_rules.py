"""Quality rules as a short-circuit cascade.

Each rule rejects texts by a few measures. On a bounded sample of the corpus the time of each measure and the rules that
reject each text are taken, and the rules are put in falling order of rejection per cost, one after the other: what counts
is only what a rule rejects among the texts that all rules before it keep, and only the time of measures that none of
them has taken yet. A text that a rule rejects is not looked at by the rules after it; the texts that stay keep the
measures they have. The order changes the time, never the verdict, since a text is kept only if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.scratch import only
from martworks.llm.words import (
    Texts,
    Words,
    covered,
    mix,
    slice_hashes,
    starts_of_windows,
    window_hashes,
    word_hashes,
    words_of,
)

# Words of a window that is looked for twice in a text.
WINDOW = 8
# Rows on which cost and selectivity are estimated, at most.
SAMPLE = 2000
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[ord("A"): ord("Z") + 1] = True
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


class Block:
    """A block of texts whose measures are computed when a rule first asks for them.

    ``source`` is the block, and the rows of it, from which this one was taken: what is known there is not computed again.
    """

    def __init__(self, texts: Texts, source: tuple[Block, np.ndarray] | None = None):
        self.texts, self.source = texts, source

    def take(self, rows: np.ndarray) -> Block:
        lo, hi = self.texts.at[:-1][rows], self.texts.at[1:][rows]
        parts = [self.texts.data[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
        data = np.concatenate(parts) if parts else self.texts.data[:0]
        out = Block(Texts(data, np.concatenate([[0], np.cumsum(hi - lo)])), (self, rows))
        for name in MEASURES:
            if name in self.__dict__:
                known = self.__dict__[name]
                out.__dict__[name] = tuple(k[rows] for k in known) if isinstance(known, tuple) else known[rows]
        return out

    def _words_of_source(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of this block's words among those of the source, and how far each word has moved."""
        source, rows = self.source
        first, counts = source.words.first[:-1][rows], source.words.counts[rows]
        places = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return places, np.repeat(source.texts.at[:-1][rows] - self.texts.at[:-1], counts)

    def _per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        return np.diff(np.searchsorted(np.flatnonzero(flags), self.texts.at))

    @cached_property
    def words(self) -> Words:
        if self.source is None or "words" not in self.source[0].__dict__:
            return words_of(self.texts)
        source, rows = self.source
        places, moved = self._words_of_source()
        first = np.concatenate([[0], np.cumsum(source.words.counts[rows])])
        return Words(source.words.start[places] - moved, source.words.end[places] - moved, first)

    @cached_property
    def hashes(self) -> np.ndarray:
        if self.source is None or not {"words", "hashes"} <= self.source[0].__dict__.keys():
            return word_hashes(self.texts, self.words)
        return self.source[0].hashes[self._words_of_source()[0]]

    @property
    def n_words(self) -> np.ndarray:
        return self.words.counts

    @cached_property
    def word_chars(self) -> np.ndarray:
        """Code points in words: bytes in words less those that continue a character."""
        total = np.concatenate([[0], np.cumsum(self.words.end - self.words.start)])
        return np.diff(total[self.words.first]) - self._per_text((self.texts.data & 0xC0) == 0x80)

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._per_text(_SYMBOL[self.texts.data])

    @cached_property
    def upper_share(self) -> np.ndarray:
        letters = self._per_text(_LETTER[self.texts.data])
        return self._per_text(_UPPER[self.texts.data]) / np.maximum(letters, 1)

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: lines with a word that equal an earlier one, the bytes of these, the bytes of all lines."""
        breaks = np.flatnonzero(self.texts.data == 0x0A)
        start = np.sort(np.concatenate([self.texts.at[:-1], breaks + 1]))
        end = np.sort(np.concatenate([breaks, self.texts.at[1:]]))
        n = len(self.texts)
        text = np.repeat(np.arange(n), np.diff(np.searchsorted(breaks, self.texts.at)) + 1)
        some = np.searchsorted(self.words.start, end) > np.searchsorted(self.words.start, start)
        start, end, text = start[some], end[some], text[some]
        key = mix(slice_hashes(self.texts.data, start, end) + mix(text.astype(np.uint64) + np.uint64(1)))
        again = np.ones(len(key), bool)
        again[np.unique(key, return_index=True)[1]] = False
        total = lambda rows: np.bincount(text[rows], (end - start)[rows], n).astype(np.int64)
        return np.bincount(text[again], minlength=n), total(again), total(slice(None))

    @cached_property
    def stutters(self) -> np.ndarray:
        """Words equal to the one before them in their text."""
        same = np.zeros(len(self.hashes), bool)
        same[1:] = self.hashes[1:] == self.hashes[:-1]
        inner = self.words.place() > 0
        return np.bincount(self.words.text_of()[same & inner], minlength=len(self.texts))

    @cached_property
    def repeat_words(self) -> np.ndarray:
        """Words in windows of ``WINDOW`` words that occur twice or more in the text."""
        size = WINDOW
        starts = starts_of_windows(self.words, size)
        if not len(starts):
            return np.zeros(len(self.texts), np.int64)
        text = self.words.text_of()
        key = mix(window_hashes(self.hashes, size)[starts] + mix(text[starts].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        equal = key[order][1:] == key[order][:-1]
        again = np.zeros(len(key), bool)
        again[order[1:]] |= equal
        again[order[:-1]] |= equal
        inside = covered(size, len(text), starts[again])
        return np.bincount(text[inside], minlength=len(self.texts))


# Measures of whole texts, which a block hands on to the rows taken from it.
MEASURES = ("word_chars", "n_symbols", "upper_share", "lines", "stutters", "repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` says which texts go, by the measures ``needs`` of the block (none named: whatever it does is its own)."""

    name: str
    rejects: Callable[[Block], np.ndarray]
    needs: tuple[str, ...] = ()


# What every text is measured for and judged by first.
BASE_MEASURES = ("words", "hashes", "word_chars", "n_symbols", "lines", "repeat_words")
BASE = (
    Rule("few_words", lambda b: b.n_words < 20, ("words",)),
    Rule("repeated_words", lambda b: 100 * b.repeat_words > 30 * b.n_words, ("words", "hashes", "repeat_words")),
)
RULES = (
    Rule("stutter", lambda b: 100 * b.stutters > 20 * b.n_words, ("words", "hashes", "stutters")),
    Rule("repeated_lines", lambda b: 100 * b.lines[1] > 30 * b.lines[2], ("words", "lines")),
    Rule("symbols", lambda b: 10 * b.n_symbols > b.n_words, ("words", "n_symbols")),
    Rule("word_length", lambda b: (b.word_chars < 2 * b.n_words) | (b.word_chars > 14 * b.n_words), ("words", "word_chars")),
    Rule("shouting", lambda b: b.upper_share > 0.5, ("upper_share",)),
)


@dataclass(frozen=True)
class Estimate:
    """What the sample tells: texts by the set of rules (bits, in the order of the rules) that reject them, seconds of each
    measure, and seconds of each rule when all measures it needs are there."""

    rejected_by: dict[int, int]
    measure_cost: dict[str, float]
    rule_cost: dict[str, float]


@dataclass(frozen=True)
class Step:
    """A rule at its place: texts of the sample that it rejects of those that reach it, and the seconds it adds."""

    rule: Rule
    rejected: int
    cost: float


def cascade(rules: Sequence[Rule], seen: Estimate, known: Sequence[str] = BASE_MEASURES) -> list[Step]:
    """The rules by falling rejection per cost, each after what those before it reject and have measured."""
    texts, known, left, steps = dict(seen.rejected_by), set(known), list(range(len(rules))), []
    while left:
        best = None
        for k in left:
            rejected = sum(n for bits, n in texts.items() if bits >> k & 1)
            new = [m for m in rules[k].needs if m not in known]
            cost = seen.rule_cost.get(rules[k].name, 0.0) + sum(seen.measure_cost.get(m, 0.0) for m in new)
            gain = rejected / max(cost, 1e-9)
            if best is None or gain > best[0]:
                best = (gain, k, Step(rules[k], rejected, cost))
        _, k, step = best
        steps.append(step)
        left.remove(k)
        known |= set(step.rule.needs)
        texts = {bits: n for bits, n in texts.items() if not bits >> k & 1}
    return steps


def _base_failed(block: Block) -> np.ndarray:
    return np.logical_or.reduce([rule.rejects(block) for rule in BASE])


def _estimate(rules: Sequence[Rule]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = Block(Texts.of(batch.column("text")))
            kinds, names, keys, values = [], [], [], []

            def add(kind: str, name: str, key: int, value: float):
                for column, v in zip((kinds, names, keys, values), (kind, name, key, value), strict=True):
                    column.append(v)  # noqa: B023

            for name in (*BASE_MEASURES, *(m for rule in rules for m in rule.needs)):
                if name not in block.__dict__:
                    began = time.perf_counter()
                    getattr(block, name)
                    add("measure", name, 0, time.perf_counter() - began)
            bits = np.zeros(len(block.texts), np.int64)
            for k, rule in enumerate(rules):
                began = time.perf_counter()
                bits |= rule.rejects(block).astype(np.int64) << k
                add("rule", rule.name, 0, time.perf_counter() - began)
            for key, n in zip(*np.unique(bits[~_base_failed(block)], return_counts=True), strict=True):
                add("texts", "", int(key), float(n))
            yield pa.record_batch([pa.array(kinds, pa.string()), pa.array(names, pa.string()), pa.array(keys, pa.int64()),
                                   pa.array(values, pa.float64())], ["kind", "name", "bits", "value"])

    return run


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample: int = SAMPLE) -> Estimate:
    """Measured on about ``sample`` rows drawn from all partitions; texts that fail the base rules are not counted."""
    texts = only(docs, text=text_col)
    share = min(1.0, sample / max(texts.count(), 1))
    found = (texts.sample(share, 17).mapInArrow(_estimate(rules), "kind string, name string, bits long, value double")
             .groupBy("kind", "name", "bits").agg(F.sum("value").alias("value")).collect())
    of = lambda kind, key: {r[key]: r.value for r in found if r.kind == kind}
    return Estimate({k: int(v) for k, v in of("texts", "bits").items()}, of("measure", "name"), of("rule", "name"))


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
                sample: int = SAMPLE) -> list[Rule]:
    """The rules in the order of :func:`cascade` for what :func:`estimate` measures."""
    return [step.rule for step in cascade(rules, estimate(docs, rules, text_col, sample))]


def judge(block: Block, rules: Sequence[Rule]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each text fails the base, the place of the rule that rejects it (-1: none), and how many rules it met."""
    n = len(block.texts)
    failed, by, met = _base_failed(block), np.full(n, -1), np.zeros(n, np.int64)
    left = np.flatnonzero(~failed)
    rest = block if len(left) == n else block.take(left)
    for k, rule in enumerate(rules):
        if not len(left):
            break
        met[left] += 1
        bad = rule.rejects(rest)
        by[left[bad]] = k
        if bad.any():
            left, rest = left[~bad], rest.take(np.flatnonzero(~bad))
    return failed, by, met


def traced(docs: DataFrame, rules: Sequence[Rule] | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """:func:`quality` with the way of each text through the cascade.

    Further columns: ``rejected_by`` (name of the rule that rejected the text, of the first base rule if it fails the base,
    null if it is kept), ``rules_met`` (rules of the cascade that looked at it, 0 if it fails the base) and
    ``rule_order`` (names of all rules in their order, the same in each row).
    """
    ordered = list(rules) if rules is not None else order_rules(docs, text_col=text_col)
    names = ",".join(rule.name for rule in ordered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = Block(Texts.of(batch.column("text")))
            failed, by, met = judge(block, ordered)
            rejected = np.array([rule.name for rule in ordered] + [None], object)[by]
            for rule in reversed(BASE):
                rejected[rule.rejects(block)] = rule.name
            columns = [block.n_words, block.word_chars, block.n_symbols, block.lines[0], block.repeat_words]
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns), pa.array(failed),
                                   pa.array(~failed & (by < 0)), pa.array(rejected, pa.string()), pa.array(met, pa.int64()),
                                   pa.array([names] * len(met), pa.string())], [*_NAMES, "rejected_by", "rules_met", "rule_order"])

    return only(docs, doc_id=id_col, text=text_col).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, kept boolean, rejected_by string, rules_met long, rule_order string")


def quality(docs: DataFrame, rules: Sequence[Rule] | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Verdict of the cascade for each row, and the base measures.

    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``. ``rules`` are run
    in the order given; without it :func:`order_rules` finds the order. A null or empty text has no words and fails.
    Repeated rows are judged each by itself, rows without an id too. Empty input gives no rows.
    """
    return traced(docs, rules, id_col, text_col).select(_NAMES)


_NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
