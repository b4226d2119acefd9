"""Documents that hold benchmark passages, by q-gram counting in diagonal bands and banded alignment.

A benchmark item is one segment, or overlapping segments if it is longer than one. A segment of m characters with at most k
edits shares at least m + 1 - q - k * q of its q-grams with the document (the q-gram lemma), and since k edits move an
alignment by at most k diagonals, all of them lie in one of the overlapping diagonal bands of twice that width. So the
shared q-grams of each band are counted, bands with too few are dropped, and the rest are verified by an alignment
restricted to the band. No copy of a segment within its edit budget is missed. Segments of fewer than ``EXACT_BELOW``
characters have no budget and are found exactly; items of fewer than ``Q`` characters hold no q-gram and are not searched.

A text that repeats itself shares each q-gram many times. Hits are therefore counted slice by slice along the text, and a
band is settled as soon as the slices have passed it, so memory holds one slice and the bands that are still open.

Each document is handled whole in one task, so nothing is shuffled. The benchmark is read in blocks of a bounded number
of characters; each block is one pass over the documents, and only a block is ever sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.linking import blocks
from martworks.llm.scratch import only

Q = 10
# Segments: length and step in characters; an item of up to that length is one segment. 100 copied characters of an item hold
# all but 8 of some segment, which is within its budget.
SEGMENT, STEP = 100, 16
# Edits allowed for each character of a segment; shorter segments than EXACT_BELOW say too little to allow any.
EDITS, EXACT_BELOW = 0.08, 30
# Characters of the benchmark that one pass sends to the tasks, about; its index takes some 30 bytes for each.
BLOCK_CHARACTERS = 2_000_000
# Characters of documents that are handled at once, with some 100 bytes for each; longer texts are handled in pieces that
# overlap by more than a match.
CHUNK, OVERLAP = 150_000, 4 * SEGMENT
# Shared q-grams that are counted at once, about.
HITS = 100_000
# Diagonals begin below 0 where a match begins before the text.
_OFFSET = 4 * SEGMENT
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _code_points(text: str) -> np.ndarray:
    low = text.lower()
    if len(low) != len(text):  # keep one character for each, so that places stay those of the text
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")


def normalise(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of white space as one blank; and the place of each character left."""
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    keep = ~space
    keep[1:] |= ~space[:-1]
    place = np.flatnonzero(keep)
    out = points[place].copy()
    out[space[place]] = 0x20
    return out, place


def _qgrams(points: np.ndarray) -> np.ndarray:
    """Hash of the ten characters from each place on, built from those of 1, 2, 4 and 8."""
    if len(points) < Q:
        return np.zeros(0, np.uint64)
    grow = lambda a, b, step: a[: len(a) - step][: len(b) - step] * np.uint64(pow(int(_ODD), step, 1 << 64)) + b[step:]
    one = points.astype(np.uint64) + np.uint64(1)
    two = grow(one, one, 1)
    four = grow(two, two, 2)
    eight = grow(four, four, 4)
    n = len(points) - Q + 1
    ten = eight[:n] * np.uint64(pow(int(_ODD), 2, 1 << 64)) + two[8: 8 + n]
    ten ^= ten >> np.uint64(29)
    ten *= np.uint64(0xD6E8FEB86659FD93)
    return ten


class Segments:
    """Segments of a block of items and the index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], edits: float):
        self.item, parts = [], []
        for item_id, text in items:
            points, _ = normalise(_code_points((text or "").strip()))
            m = len(points)
            if m < Q:
                continue
            for b in [0] if m <= SEGMENT else [*range(0, m - SEGMENT, STEP), m - SEGMENT]:
                parts.append(points[b: b + SEGMENT])
                self.item.append(item_id)
        self.parts = parts
        self.length = np.array([len(p) for p in parts], np.int64)
        # The budget is lowered where the lemma would otherwise ask for no shared q-gram.
        self.budget = np.minimum((edits * self.length).astype(np.int64), (self.length - Q) // Q)
        self.budget[self.length < EXACT_BELOW] = 0
        self.least = self.length + 1 - Q - Q * self.budget
        grams = [_qgrams(p) for p in parts]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        segment = np.repeat(np.arange(len(parts)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.segment, self.place = segment[order], place[order]
        self.grams, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        bits = max(16, int(len(every) * 64).bit_length())
        self.shift = np.uint64(64 - min(bits, 26))
        self.some = np.zeros(1 << min(bits, 26), bool)
        self.some[self.grams >> self.shift] = True


def _bands(segments: Segments, points: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bands that hold enough shared q-grams, slice by slice: segment, first diagonal, document (its place in the chunk)."""
    grams = _qgrams(points)
    at = np.flatnonzero(segments.some[grams >> segments.shift])
    if not len(at) or not len(segments.grams):
        return
    row = np.searchsorted(segments.grams, grams[at])
    row[row == len(segments.grams)] = 0
    real = segments.grams[row] == grams[at]
    at, row = at[real], row[real]
    ends = np.cumsum(segments.count[row])
    key, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + HITS, side="right")))
        n = segments.count[row[lo:hi]]
        hit = np.repeat(segments.first[row[lo:hi]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        segment, diagonal = segments.segment[hit], np.repeat(at[lo:hi], n) - segments.place[hit]
        # A q-gram that runs over the end of a document or starts in the one before the diagonal's adds to no real match,
        # since alignments are verified within the document.
        band = (diagonal + _OFFSET) // (segments.budget[segment] + 1) + 1
        own, times = np.unique((segment.astype(np.int64) << 32) | band, return_counts=True)
        every, inverse = np.unique(np.concatenate([key, own, own - 1]), return_inverse=True)
        count = np.bincount(inverse, np.concatenate([count, times, times]), len(every)).astype(np.int64)
        key, lo = every, hi
        segment = key >> 32
        width = segments.budget[segment] + 1
        first = ((key & 0xFFFFFFFF) - 1) * width - _OFFSET
        # The last place that can add to a band is a segment's length past its last diagonal.
        settled = first + 2 * width + segments.length[segment] <= at[hi] if hi < len(at) else np.ones(len(key), bool)
        good = settled & (count >= segments.least[segment])
        if good.any():
            yield _placed(segments, starts, segment[good], first[good])
        key, count = key[~settled], count[~settled]


def _placed(segments: Segments, starts: np.ndarray, segment: np.ndarray,
            first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bands with the documents at both their ends, as far as an alignment in them can begin: one that touches two is
    verified in both. A document between them is shorter than a match."""
    budget, end = segments.budget[segment], starts[-1] - 1
    doc = np.searchsorted(starts, np.clip(first + 2 * (budget + 1) + budget, 0, end), side="right") - 1
    early = np.searchsorted(starts, np.clip(first - budget, 0, end), side="right") - 1
    both = early != doc
    return np.concatenate([segment, segment[both]]), np.concatenate([first, first[both]]), np.concatenate([doc, early[both]])


def _align(segments: Segments, points: np.ndarray, starts: np.ndarray, segment: np.ndarray, first: np.ndarray,
           doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each segment in its band, and where the best alignment ends (exclusive, in the chunk)."""
    edits, end = np.full(len(segment), 1 << 20), np.zeros(len(segment), np.int64)
    outside = np.uint32(0xFFFFFFFF)  # equals no character
    for m, k in set(zip(segments.length[segment].tolist(), segments.budget[segment].tolist(), strict=True)):
        rows = np.flatnonzero((segments.length[segment] == m) & (segments.budget[segment] == k))
        for lo in range(0, len(rows), 2000):
            own = rows[lo: lo + 2000]
            pattern = np.stack([segments.parts[s] for s in segment[own]])
            wide = 2 * (k + 1) + 2 * k + 1  # diagonals
            base = first[own] - k
            where = base[:, None] + np.arange(m + wide)
            inside = (where >= starts[doc[own]][:, None]) & (where < starts[doc[own] + 1][:, None])
            text = np.where(inside, points[np.clip(where, 0, len(points) - 1)], outside)
            slope = np.arange(wide)
            cost = np.zeros((len(own), wide), np.int32)
            for i in range(m):
                step = cost + (text[:, i: i + wide] != pattern[:, i: i + 1])
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
                cost = np.minimum.accumulate(step - slope, axis=1) + slope
            best = np.argmin(cost, axis=1)
            edits[own] = cost[np.arange(len(own)), best]
            end[own] = base + m + best
    return edits, end


def _pieces(texts: list) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """Chunks of texts in normalised form: number of the text, its characters, and their places in it."""
    chunk, size = [], 0
    for k, text in enumerate(texts):
        points, place = normalise(_code_points(text or ""))
        for lo in range(0, max(len(points) - OVERLAP, 1), CHUNK):
            part = points[lo: lo + CHUNK + OVERLAP]
            if chunk and size + len(part) > CHUNK:
                yield chunk
                chunk, size = [], 0
            chunk.append((k, part, place[lo: lo + CHUNK + OVERLAP]))
            size += len(part)
    if chunk:
        yield chunk


def found_in(segments: Segments, texts: list) -> dict[tuple[int, int], dict[int, tuple[int, int, int]]]:
    """By number of the text and item: each segment found, with its edits and where it lies in the text."""
    out: dict = {}
    for chunk in _pieces(texts):
        points = np.concatenate([p for _, p, _ in chunk])
        starts = np.concatenate([[0], np.cumsum([len(p) for _, p, _ in chunk])])
        for segment, first, doc in _bands(segments, points, starts):
            edits, end = _align(segments, points, starts, segment, first, doc)
            good = edits <= segments.budget[segment]
            for s, d, e, stop in zip(segment[good].tolist(), doc[good].tolist(), edits[good].tolist(), end[good].tolist(),
                                     strict=True):
                k, _, place = chunk[d]
                hi = min(stop - int(starts[d]), len(place))
                lo = max(hi - len(segments.parts[s]), 0)
                own = out.setdefault((k, segments.item[s]), {})
                if s not in own or e < own[s][0]:
                    own[s] = (e, int(place[lo]), int(place[hi - 1]) + 1)
    return out


def _search(items: list[tuple[int, str]], edits: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(items, edits)
        for batch in blocks(batches):
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[k], item, len(own), min(b for _, b, _ in own.values()), max(c for _, _, c in own.values()),
                     min(a for a, _, _ in own.values()))
                    for (k, item), own in found_in(segments, batch.column("text").to_pylist()).items()]
            if rows:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], _NAMES)

    return run


def _without(items: list[tuple[int, str]], edits: float, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(items, edits)
        for batch in blocks(batches, text_col):
            leaking = {k for k, _ in found_in(segments, batch.column(text_col).to_pylist())}
            yield batch.filter(pa.array([k not in leaking for k in range(batch.num_rows)], pa.bool_()))

    return run


_NAMES = ["doc_id", "item_id", "n_segments", "start", "end", "edits"]


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_characters: int) -> Iterator[list[tuple[int, str]]]:
    """Items of the benchmark, by blocks of about so many characters; one empty block if there are none."""
    known = only(benchmark, item_id=item_col, text=item_text_col).where("text is not null and item_id is not null")
    characters = known.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-characters // block_characters))
    for block in range(passes):
        own = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == block) if passes > 1 else known
        yield sorted((r.item_id, r.text) for r in own.distinct().toLocalIterator())


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", edits: float = EDITS,
               block_characters: int = BLOCK_CHARACTERS) -> DataFrame:
    """Benchmark items that documents hold: ``doc_id, item_id, n_segments, start, end, edits``.

    A row for each document row and item of which at least one segment is in the text with at most ``edits`` of its
    length inserted, deleted or changed; case and the kind and amount of white space do not count. ``start`` and ``end``
    are about where the matched segments lie, in code points of the text (a start is off by no more than the edits).
    Null texts and items match nothing, an empty benchmark gives no rows, repeated rows are found each by itself, and a
    row without an id is found with a null id.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    schema = ", ".join(f"{n} long" for n in _NAMES)
    out = None
    for items in _blocks(benchmark, item_col, item_text_col, block_characters):
        part = rows.mapInArrow(_search(items, edits), schema)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", edits: float = EDITS, block_characters: int = BLOCK_CHARACTERS) -> DataFrame:
    """Rows of ``docs``, all columns, whose own text holds no benchmark item (as :func:`find_leaks` tells).

    Each row is judged by its text alone, whatever its id and the other rows: rows without an id, rows that share one and
    repeated rows too. Null and empty texts stay; an empty benchmark keeps all rows; empty input gives no rows.
    """
    out = docs
    for items in _blocks(benchmark, item_col, item_text_col, block_characters):
        out = out.mapInArrow(_without(items, edits, text_col), docs.schema)
    return out
