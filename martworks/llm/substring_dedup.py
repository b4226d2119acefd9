"""Removal of word passages that an earlier document already holds, by prefix-partitioned suffix trees.

All word suffixes of a corpus are split by a prefix into groups that fit a task's memory, and each group builds its own
subtree. A prefix starts as one word; where the suffixes behind it are too many for one group, it is extended word by
word, so frequent words are split further and rare ones are not. The prefix counts come from one pass over all texts.

In a group the suffixes are sorted. Suffixes that agree on ``size`` words lie below one internal node at that depth,
which is a repeat of at least ``size`` words; where such repeats follow each other in a document they make up a maximal
repeat, which is how :func:`repeats` reports them. Nodes deeper than ``size`` cannot change which words are covered, so
a suffix is cut at that depth, and its path there is named by a 56-bit hash of its words rather than spelled out. Names
are compared within a group of about a million suffixes, so a path shares its name with another one with a chance of about
1 in 10**11, whatever the size of the corpus.

Documents are ordered by id: of each node the smallest id keeps its words and all others lose them. Copies inside one
block of texts are settled before the shuffle, so a passage that occurs in a third of all documents sends one entry
for each block, not for each document. Groups answer each block with the repeats among its suffixes, and a block lists
them by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.scratch import Scratch, only
from martworks.llm.words import Texts, covered, mix, starts_of_windows, window_hashes, word_hashes, words_of

SIZE = 13
# Suffixes of a group, about; a task holds some 80 bytes of each.
SUFFIXES_PER_GROUP = 1_000_000
# Words of a block that is sorted at once in a task.
BLOCK_WORDS = 1_000_000
DEEPEST_PREFIX = 4
# Names are compared within a group only, so 56 bits of the hash are enough.
UNUSED_BITS = np.uint64(8)
# Most heavy prefixes that are sent to the tasks (8 bytes each); beyond it groups are allowed to grow.
MOST_HEAVY = 2_000_000


class _Blocks:
    """Gathers Arrow batches into blocks of about ``BLOCK_WORDS`` words. A text is never cut."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.batches = batches

    def __iter__(self):
        limit, ids, parts, held = BLOCK_WORDS * 6, [], [], 0
        for batch in self.batches:
            texts = Texts.of(batch.column("text"))
            own = batch.column("doc_id").to_numpy(zero_copy_only=False)
            lo = 0
            while lo < len(texts):
                hi = int(np.searchsorted(texts.at, texts.at[lo] + limit - held, side="right")) - 1
                hi = min(max(hi, lo + 1), len(texts))
                at = texts.at[lo: hi + 1]
                ids.append(own[lo:hi])
                parts.append(Texts(texts.data[at[0]: at[-1]], at - at[0]))
                held += int(at[-1] - at[0])
                if held >= limit or hi < len(texts):
                    yield np.concatenate(ids), _together(parts)
                    ids, parts, held = [], [], 0
                lo = hi
        if ids:
            yield np.concatenate(ids), _together(parts)


def _together(parts: list[Texts]) -> Texts:
    ends = np.concatenate([np.diff(p.at) for p in parts])
    return Texts(np.concatenate([p.data for p in parts]), np.concatenate([[0], np.cumsum(ends)]))


def _prefix_hashes(hashes: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    return window_hashes(hashes, depth)[starts]


def _is_in(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _first_documents(name: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For leaves sorted by name: the smallest document below the node of each."""
    new = np.flatnonzero(np.diff(name, prepend=~name[:1]) != 0)
    return np.repeat(np.minimum.reduceat(doc, new), np.diff(new, append=len(name)))


def _group_of(hashes: np.ndarray, starts: np.ndarray, heavy: list[np.ndarray], groups: int) -> np.ndarray:
    """Group of each suffix: that of its shortest prefix that is not heavy."""
    prefix = _prefix_hashes(hashes, starts, 1)
    open_ = np.arange(len(starts))
    for depth, known in enumerate(heavy, 1):
        open_ = open_[_is_in(known, prefix[open_])]
        if not len(open_):
            break
        prefix[open_] = _prefix_hashes(hashes, starts[open_], depth + 1)
    return (mix(prefix) % np.uint64(groups)).astype(np.int64)


def heavy_prefixes(docs: DataFrame, size: int, total_words: int, per_group: int) -> list[np.ndarray]:
    """Prefixes of 1, 2, ... words with more than ``per_group`` suffixes, as sorted hashes.

    A prefix can only pass the bound if it passes that share of it in some block, so blocks report only those: at most
    ``total / per_group`` for each block and depth, summed by Spark.
    """
    deepest = min(DEEPEST_PREFIX, size)
    share = per_group / max(total_words, 1)
    if total_words <= per_group:
        return []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _Blocks(batches):
            words = words_of(texts)
            hashes, starts = word_hashes(texts, words), starts_of_windows(words, size)
            for depth in range(1, deepest + 1):
                own = _prefix_hashes(hashes, starts, depth)
                prefix, n = np.unique(own, return_counts=True)
                many = n > max(share * len(words.start) / 2, 50)
                if not many.any():
                    break
                starts = starts[_is_in(prefix[many], own)]
                yield pa.record_batch([pa.array(np.full(many.sum(), depth, np.int32)),
                                       pa.array(prefix[many].view(np.int64)), pa.array(n[many], pa.int64())],
                                      ["depth", "prefix", "n"])

    found = (docs.mapInArrow(count, "depth int, prefix long, n long").groupBy("depth", "prefix")
             .agg(F.sum("n").alias("n")).where(F.col("n") > per_group // 2)
             .orderBy(F.desc("n")).limit(MOST_HEAVY).toArrow())
    out = []
    for depth in range(1, deepest + 1):
        rows = found.filter(pc.equal(found["depth"], depth))
        out.append(np.sort(rows["prefix"].to_numpy().view(np.uint64)))
    return out


def _packed(columns: list[np.ndarray]) -> bytes:
    """Integer columns as byte planes, so that bytes that are always zero cost nothing once compressed."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, n: int, kinds: list[str]) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(blob, n * sum(widths), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind, width in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(raw[at: at + n * width].reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


# A leaf: name of its path (as the step from the one before), document (its place in the block), place of the suffix.
_LEAF = ["<u8", "<u4", "<u4"]


def _suffixes(size: int, groups: int, heavy):
    """Task: suffixes of each block, sorted and packed by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = heavy.value
        for ids, texts in _Blocks(batches):
            words = words_of(texts)
            starts = starts_of_windows(words, size)
            if not len(starts):
                continue
            hashes = word_hashes(texts, words)
            name = window_hashes(hashes, size)[starts] >> UNUSED_BITS
            group = _group_of(hashes, starts, known, groups)
            doc = words.text_of()[starts].astype(np.uint32)
            place = words.place()[starts].astype(np.uint32)
            del hashes, words, starts, texts
            order = np.argsort(name)
            order = order[np.argsort(group[order].astype(np.uint16 if groups < 1 << 16 else np.int64), kind="stable")]
            name, group, doc, place = name[order], group[order], doc[order], place[order]
            # Below a node of this block only the smallest document can be the first of all.
            lost = ids[doc] > _first_documents(name, ids[doc])
            block = int.from_bytes(hashlib.blake2b(ids.tobytes(), digest_size=8).digest(), "little", signed=True)
            bounds = np.flatnonzero(np.diff(group, prepend=-1))
            rows = []
            for lo, hi in zip(bounds, [*bounds[1:], len(group)], strict=True):
                own, gone = lo + np.flatnonzero(~lost[lo:hi]), lo + np.flatnonzero(lost[lo:hi])
                table, doc_of = np.unique(doc[own], return_inverse=True)
                rows.append((int(group[lo]), block, len(own), len(table), _packed([np.diff(ids[table].astype("<i8"), prepend=0)]),
                             _packed([np.diff(name[own], prepend=np.uint64(0)), doc_of.astype("<u4"), place[own]]),
                             len(gone), _packed([ids[doc[gone]].astype("<i8"), place[gone]])))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()),
                strict=True)], ["grp", "block", "n", "n_docs", "docs", "leaves", "n_lost", "lost"])

    return run


def _subtree(table: pa.Table) -> pa.Table:
    """One group's subtree: leaves below an internal node at full depth, but for its smallest document's, are repeats.

    They are sent back as one row for each block that they come from.
    """
    block = table.column("block").to_pylist()
    name, doc, place, source = [], [], [], []
    for k, (n, n_docs, docs, leaves) in enumerate(zip(*(table.column(c).to_pylist() for c in (
            "n", "n_docs", "docs", "leaves")), strict=True)):
        steps, d, p = _unpacked(leaves, n, _LEAF)
        name.append(np.cumsum(steps, dtype=np.uint64))
        doc.append(np.cumsum(_unpacked(docs, n_docs, ["<i8"])[0])[d])
        place.append(p)
        source.append(np.full(n, k, np.uint32))
    name, doc, place, source = map(np.concatenate, (name, doc, place, source))
    order = np.argsort(name)
    name = name[order]
    lost = order[doc[order] > _first_documents(name, doc[order])] if len(order) else order
    del name, order
    lost = lost[np.argsort(source[lost], kind="stable")]
    bounds = np.searchsorted(source[lost], np.arange(len(block) + 1))
    rows = []
    for k, (n_lost, gone) in enumerate(zip(table.column("n_lost").to_pylist(), table.column("lost").to_pylist(),
                                           strict=True)):
        own = lost[bounds[k]: bounds[k + 1]]
        if len(own):
            rows.append((block[k], len(own), _packed([doc[own], place[own]])))
        if n_lost:
            rows.append((block[k], n_lost, gone))
    return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(
        (("block", pa.int64()), ("n", pa.int64()), ("lost", pa.binary())))})


def _by_document(table: pa.Table) -> pa.Table:
    """All repeats of one block, a row for each of its documents."""
    parts = [_unpacked(lost, n, ["<i8", "<u4"]) for n, lost in zip(
        table.column("n").to_pylist(), table.column("lost").to_pylist(), strict=True)]
    doc, place = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(doc, kind="stable")
    doc, place = doc[order], place[order]
    bounds = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    ends = np.append(bounds[1:], len(doc))
    return pa.table({"doc_id": pa.array(doc[bounds], pa.int64()),
                     "places": pa.array([place[lo:hi].tobytes() for lo, hi in zip(bounds, ends, strict=True)],
                                        pa.binary())})


def repeat_places(docs: DataFrame, size: int = SIZE, per_group: int = SUFFIXES_PER_GROUP) -> DataFrame:
    """``doc_id, parts``: where windows start that a smaller document holds, as packed unsigned 32-bit integers.

    ``docs`` has ``doc_id`` (not null) and ``text``; a document has one row.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    words = total // 5  # an upper estimate is enough: it only sizes the groups
    heavy = spark.sparkContext.broadcast(heavy_prefixes(docs, size, words, per_group))
    groups = max(12, -(-words // per_group))
    suffixes = docs.mapInArrow(
        _suffixes(size, groups, heavy),
        "grp long, block long, n long, n_docs long, docs binary, leaves binary, n_lost long, lost binary")
    lost = suffixes.groupBy("grp").applyInArrow(_subtree, "block long, n long, lost binary")
    places = lost.groupBy("block").applyInArrow(_by_document, "doc_id long, places binary")
    return places.groupBy("doc_id").agg(F.collect_list("places").alias("parts"))


def substring_dedup(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
                    per_group: int = SUFFIXES_PER_GROUP, with_text: bool = True) -> DataFrame:
    """Documents without the words that repeat an earlier document for ``size`` words or more.

    Columns: ``doc_id, n_words, n_removed, kept_sha256, spans`` and, ``with_text``, ``kept_text`` (the words left,
    joined by one blank). ``spans`` are the maximal repeats removed, as first word and word after the last. Windows are
    judged on the input. Texts that are null, empty or shorter than ``size`` words lose nothing. A row without an id is
    compared with nothing and keeps its words. Rows with the same id are one document for the comparison, so they never
    remove each other's words; each is returned, cut where the repeats of any of them start. Empty input gives no rows.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    places = repeat_places(rows.where("doc_id is not null"), size, per_group)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts.of(batch.column("text"))
            words = words_of(texts)
            out = []
            for k, parts in enumerate(batch.column("parts").to_pylist()):
                lo, hi = words.first[k], words.first[k + 1]
                n = int(hi - lo)
                raw = texts.data[texts.at[k]: texts.at[k + 1]].tobytes()
                kept, spans = raw.split(), []
                if parts and n:
                    starts = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
                    gone = covered(size, n, starts[starts + size <= n])
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    spans = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                    kept = [kept[i] for i in np.flatnonzero(~gone)]
                joined = b" ".join(kept)
                out.append((n, n - len(kept), hashlib.sha256(joined).hexdigest(), spans, joined.decode()))
            fields = list(zip(*out, strict=True)) or [()] * 5
            arrays = [batch.column("doc_id"), pa.array(fields[0], pa.int64()), pa.array(fields[1], pa.int64()),
                      pa.array(fields[2], pa.string()),
                      pa.array(fields[3], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]
            if with_text:
                arrays, names = [*arrays, pa.array(fields[4], pa.string())], [*names, "kept_text"]
            yield pa.record_batch(arrays, names)

    schema = ("doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, end: long>>"
              + ", kept_text string" * with_text)
    return rows.join(places, "doc_id", "left").select("doc_id", "text", "parts").mapInArrow(cut, schema)
