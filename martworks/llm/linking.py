"""Links between texts by the similarity of their shingle sets, confirmed on full sets.

:func:`verified` confirms given pairs. Its rows are sorted by centre, so a task holds the set of one centre at a time and
the texts of the members pass by; a centre's text is sent once for each ``PER_CENTRE`` of its members, not once for each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm.scratch import Scratch
from martworks.llm.words import Texts, mix, starts_of_windows, window_hashes, word_hashes, words_of

# Members that share one copy of their centre's text.
PER_CENTRE = 1000
# Ids up to this number (8 bytes each) are broadcast to choose the texts to verify; more are joined by a shuffle.
BROADCAST_IDS = 4_000_000
# Bytes of text whose words a task holds at once: their positions, hashes and shingles take some 30 times as much.
BLOCK = 1 << 20


def blocks(batches: Iterable[pa.RecordBatch], text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches, one after the other, with at most ``BLOCK`` bytes of text or one row; nothing is copied."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + BLOCK, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def shingle_sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of each text after the other, and where each text's begin (one entry more).

    A text of fewer than ``size`` words is one shingle of all its words; a text without words has none.
    """
    texts = texts.lower_ascii()
    words = words_of(texts)
    hashes = word_hashes(texts, words)
    counts = words.counts
    starts = starts_of_windows(words, size)
    windows = window_hashes(hashes, size)[starts] if len(starts) else np.zeros(0, np.uint64)
    first = np.concatenate([[0], np.cumsum(np.maximum(counts - size + 1, 0))])
    sets = []
    for k, n in enumerate(counts.tolist()):
        if n >= size:
            sets.append(np.unique(windows[first[k]: first[k + 1]]))
        elif n:
            own = hashes[words.first[k]: words.first[k + 1]]
            sets.append(mix(window_hashes(own, n) + np.uint64(n)))
        else:
            sets.append(windows[:0])
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else windows), at


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """``100 * intersection >= percent * union`` of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)


def close_in_size(x: Column, y: Column, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def texts_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ``doc_id`` is in ``ids`` (``doc_id``)."""
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def _verify(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, sets = None, []
        for batch in blocks(batches):
            shingles, at = shingle_sets(Texts.of(batch.column("text")), size)
            links = []
            for k, (a, b, member) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "member")), strict=True)):
                own = shingles[at[k]: at[k + 1]]
                if not member:
                    if centre != a:
                        centre, sets = a, []
                    sets.append(own.copy())
                elif centre == a and any(similar(s, own, percent) for s in sets):
                    links.append((a, b))
            yield pa.record_batch([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())],
                                  ["a", "b"])

    return run


def verified(scratch: Scratch, known: DataFrame, pairs: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    """The ``pairs`` (``a, b`` by id) whose texts in ``known`` (``doc_id, text``) are similar, as a kept table.

    ``a`` is the centre: where one document meets many, it should stand there. Several texts of one id are one document,
    which is linked if any of its texts is; a task holds all texts of one centre.
    """
    steps = scratch.within(f"{name}-steps")
    pairs = steps.keep("pairs", pairs)
    ids = steps.keep("ids", pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    copies = steps.keep("copies", pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_CENTRE).alias("copies")))
    centres = copies.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
                            .alias("part"), F.lit(False).alias("member"))
    # Few centres have several copies, one for PER_CENTRE pairs at most, so the pairs are not shuffled for them.
    several = copies.where("copies > 1")
    several = F.broadcast(several) if several.count() <= BROADCAST_IDS else several
    members = pairs.join(several, "a", "left").select(
        F.col("b").alias("doc_id"), "a", F.pmod(F.xxhash64("b"), F.coalesce("copies", F.lit(1))).alias("part"),
        F.lit(True).alias("member"))
    rows = (texts_of(known, ids).join(centres.unionByName(members), "doc_id")
            .select("a", "part", "member", F.col("doc_id").alias("b"), "text")
            .repartition("a", "part").sortWithinPartitions("a", "part", "member"))
    out = scratch.keep(name, rows.mapInArrow(_verify(size, percent), "a long, b long"))
    steps.clear()
    return out
