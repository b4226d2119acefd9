"""Similarity join of documents by their word shingles, filtered under several global orders of the shingles.

For a bound t, two sets with a Jaccard similarity of t share a shingle among the first ``n - ceil(t * n) + 1`` of each, in
whatever global order both are sorted. So a pair is a candidate only if it shares such prefix shingles under every one of
several orders. All orders put frequent shingles last, by classes of different width of their document frequency, and
shuffle each class in their own way.

1. One pass over all documents counts shingles in a fixed number of cells (by hash), which rank the shingles. An order
   needs no exact counts: any total order is lossless. A second pass writes the prefixes of each set under each order.
2. Documents with the same set are one class; only its smallest id goes on.
3. Buckets are the shingles of the first order's prefixes. A pair of a bucket whose sets surely differ in too many
   shingles is none: each set has 512 bits (long sets 4,096 or 65,536 more), of which every shingle flips one, and
   two sets differ in at least as many shingles as bits. After the first round, members meet only where the shingle may be
   the first that they have in common: from it on, both sets have room for what linked sets share. The other pairs are
   filtered by the further orders and confirmed on the full sets.
   :func:`similar_pairs` does so with every pair and returns every link.
4. :func:`ngram_join` asks for components only and goes by rounds: in the first each bucket has one centre that all others
   are compared with. Then buckets whose members are connected are done. A bucket with few unconnected pairs (at most
   ``EASY`` for each member) gives these; in others 16 times as many centres as before are compared with all members
   of other components, and leave the bucket. So a group of linked copies costs a row for each member and centre, and
   only documents that share rare shingles under all orders and are still not linked are compared pair by pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm.components import components
from martworks.llm.linking import blocks, close_in_size, shingle_sets, texts_of, verified
from martworks.llm.scratch import Scratch, only
from martworks.llm.words import Texts, mix

# Cells that count shingles: 2 MB for each task's table.
CELL_BITS = 18
# Classes of document frequency for each doubling, by order.
ORDERS = (4.0, 1.0, 0.25)
# Pairs for each member of a bucket that are looked at without another round of centres.
EASY, MORE_CENTRES = 2048, 16
# 64-bit words of flipped bits of each set.
WORDS = 8
# Sets of more shingles have further flipped bits: the number of 64-bit words by the least size.
WIDE = ((16_000, 1024), (1000, 64))
# Tables of counts that one call adds up.
FAN_IN = 64
_PARTS = 64
_TOP = np.uint64(64 - CELL_BITS)


def _cells(size: int):
    """Shingle counts of a task, as ``_PARTS`` slices of the table of cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in blocks(batches):
            shingles, _ = shingle_sets(Texts.of(batch.column("text")), size)
            total += np.bincount((shingles >> _TOP).astype(np.int64), minlength=len(total))
        if total.any():
            slices = total.reshape(_PARTS, -1)
            task = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array([task] * _PARTS, pa.int64()), pa.array(range(_PARTS), pa.int64()),
                                   pa.array([s.tobytes() for s in slices], pa.binary())], ["task", "slice", "counts"])

    return run


def _added(table: pa.Table) -> pa.Table:
    counts = sum(np.frombuffer(c, np.int64) for c in table["counts"].to_pylist())
    return pa.table({"task": pa.array([table["task"][0].as_py() // FAN_IN], pa.int64()), "slice": table["slice"].slice(0, 1),
                     "counts": pa.array([counts.tobytes()], pa.binary())})


def classes_of_cells(scratch: Scratch, rows: DataFrame, size: int, name: str) -> np.ndarray:
    """For each order and cell the class of its document frequency; ``rows`` have a ``text``. Fixed size."""
    schema, steps, level = "task long, slice long, counts binary", scratch.within(f"{name}-cells"), 0
    found = steps.keep("0", rows.select("text").mapInArrow(_cells(size), schema))
    while (found.agg(F.max("task")).first()[0] or 0) > 0:
        level += 1
        found = steps.keep(f"{level}", found.groupBy("slice", F.floor(F.col("task") / FAN_IN).alias("some"))
                           .applyInArrow(_added, schema))
    total = np.zeros((_PARTS, (1 << CELL_BITS) // _PARTS), np.int64)
    for row in found.collect():  # _PARTS rows
        total[row.slice] += np.frombuffer(row.counts, np.int64)
    steps.clear()
    doublings = np.log2(total.ravel() + 1.0)
    return np.stack([np.minimum(doublings * width, 255).astype(np.uint8) for width in ORDERS])


def prefixes(shingles: np.ndarray, at: np.ndarray, percent: int, classes: np.ndarray) -> list[list[np.ndarray]]:
    """For each order, the prefix of each set: the shingles of which two sets that are linked share one, in that order."""
    cell = (shingles >> _TOP).astype(np.int64)
    out = []
    for k, own in enumerate(classes):
        shuffled = mix(shingles ^ np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))
        rank = own[cell].astype(np.uint64) << np.uint64(56) | shuffled >> np.uint64(8)
        sets = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            n = b - a
            p = n - (percent * n + 99) // 100 + 1
            first = np.argpartition(rank[a:b], p - 1)[:p] if 0 < p < n else np.arange(n)
            sets.append(shingles[a:b][first[np.argsort(rank[a:b][first])]])
        out.append(sets)
    return out


def flipped_bits(shingles: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of ``WORDS`` 64-bit words for each set, in which every shingle flips one bit."""
    n = len(at) - 1
    bit = (mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(64 * WORDS)).astype(np.int64)
    own = np.bincount(np.repeat(np.arange(n), np.diff(at)) * (64 * WORDS) + bit, minlength=n * 64 * WORDS) & 1
    return np.packbits(own.astype(np.uint8).reshape(n, 64 * WORDS), axis=1).view(np.int64)


def wide_bits(shingles: np.ndarray, wide: tuple = WIDE) -> np.ndarray | None:
    """Further flipped bits of one set as 64-bit words; none for a set that :func:`flipped_bits` tells apart well."""
    for least, words in wide:
        if len(shingles) > least:
            bit = (mix(shingles ^ np.uint64(0x5A5A5A5A5A5A5A5A)) % np.uint64(64 * words)).astype(np.int64)
            return np.packbits((np.bincount(bit, minlength=64 * words) & 1).astype(np.uint8)).view(np.int64)
    return None


def _lists(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(offsets, values.view(np.int64))


def _sketch(size: int, percent: int, classes: np.ndarray, widths: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            shingles, at = shingle_sets(Texts.of(batch.column("text")), size)
            digests = [hashlib.blake2b(shingles[a:b].tobytes(), digest_size=16).digest() if b > a else None
                       for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            lists = [_lists(sets) for sets in prefixes(shingles, at, percent, classes)]
            bits = flipped_bits(shingles, at)
            wide = [wide_bits(shingles[a:b], widths) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(digests, pa.binary()),
                                   *lists, *(pa.array(bits[:, k]) for k in range(WORDS)),
                                   pa.array(wide, pa.list_(pa.int64()))],
                                  ["doc_id", "n", "digest", *_NAMES, *_BITS, "wide"])

    return run


_NAMES = [f"order{k}" for k in range(len(ORDERS))]
_BITS = [f"bits{k}" for k in range(WORDS)]
_SCHEMA = ", ".join(["doc_id long, n long, digest binary", *(f"{n} array<long>" for n in _NAMES), *(f"{b} long" for b in _BITS),
                     "wide array<long>"])


def sketches(scratch: Scratch, rows: DataFrame, size: int, percent: int, name: str,
             wide: tuple = WIDE) -> tuple[DataFrame, DataFrame]:
    """Size, digest and prefixes of each row's set (``rows``: ``doc_id, text``), and one row ``rep`` for each set.

    ``wide`` tells which sets have how many further bits.
    """
    classes = classes_of_cells(scratch, rows, size, name)
    own = scratch.keep(f"{name}-sketches", rows.mapInArrow(_sketch(size, percent, classes, wide), _SCHEMA))
    sets = scratch.keep(f"{name}-sets", own.where("doc_id is not null and n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in ("n", *_NAMES, *_BITS, "wide"))))
    return own.select("doc_id", "n", "digest"), sets


def _buckets(sets: DataFrame) -> DataFrame:
    """``key, rep, n, room, size``: sets by the shingles of their first prefix, where more than one set has it.

    ``room`` is the number of the set's shingles from ``key`` on. A linked pair is looked for where its first common shingle
    is the key, so all that it has in common has room.
    """
    keys = sets.select(F.posexplode("order0").alias("at", "key"), "rep", "n").select(
        "key", "rep", "n", (F.col("n") - F.col("at")).alias("room"))
    return keys.join(keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key")


def _has_room(room: str, n: str, other: str, percent: int) -> Column:
    """Lossless: linked sets have at least percent / (100 + percent) of both sizes in common."""
    return F.col(room) * (100 + percent) >= percent * (F.col(n) + F.col(other))


def _may_meet(x: str, y: str, percent: int) -> Column:
    """Whether the key of a bucket may be the first common shingle of two members that are linked."""
    return _has_room(f"{x}.room", f"{x}.n", f"{y}.n", percent) & _has_room(f"{y}.room", f"{y}.n", f"{x}.n", percent)


def _may_link(x: str, y: str, percent: int) -> Column:
    """Lossless: sets of a similarity in per cent differ in at most (100 - percent) / (100 + percent) of both sizes."""
    n = F.col(f"{x}.n") + F.col(f"{y}.n")
    differ = reduce(add, (F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in _BITS))
    return close_in_size(F.col(f"{x}.n"), F.col(f"{y}.n"), percent) & (differ * (100 + percent) <= (100 - percent) * n)


def _wide_may_link(x: str, y: str, percent: int) -> Column:
    """As :func:`_may_link` by the further bits, where both sets have equally many."""
    differ = F.aggregate(F.zip_with(f"{x}.wide", f"{y}.wide", lambda v, w: F.bit_count(v.bitwiseXOR(w))), F.lit(0), add)
    close = differ * (100 + percent) <= (100 - percent) * (F.col(f"{x}.n") + F.col(f"{y}.n"))
    return F.when(F.size(f"{x}.wide") == F.size(f"{y}.wide"), close).otherwise(True)


def _filtered(scratch: Scratch, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that may be linked by size and bits, and share a prefix shingle under each further order too.

    Only the sets that occur in a pair are shuffled, and the prefixes only of those in a pair that the bits leave.
    """
    steps = (("met", (*_BITS, "wide"), _may_link("of_a", "of_b", percent) & _wide_may_link("of_a", "of_b", percent)),
             ("near", _NAMES[1:], reduce(and_, (F.arrays_overlap(f"of_a.{name}", f"of_b.{name}") for name in _NAMES[1:]))))
    for step, columns, passes in steps:
        pairs = scratch.keep(step, pairs.distinct())
        ids = scratch.keep(f"{step}-ids", pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
        own = texts_of(sets.select(F.col("rep").alias("doc_id"), F.struct("n", *columns).alias("of")), ids)
        side = lambda x: own.select(F.col("doc_id").alias(x), F.col("of").alias(f"of_{x}"))  # noqa: B023, E731
        pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(passes).select("a", "b")
    return pairs.distinct()


def _bucket_pairs(members: DataFrame, *also) -> DataFrame:
    x, y = members.alias("x"), members.alias("y")
    return x.join(y, [F.col("x.key") == F.col("y.key"), F.col("x.rep") < F.col("y.rep"), *also]).select(
        F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))


def _merged(scratch: Scratch, labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after further links: components of the labels, which are fewer than the documents."""
    if labels is None:
        return components(scratch, links, "labels")
    label = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"{x}_label"))
    ends = links.join(label("a"), "a", "left").join(label("b"), "b", "left").select(
        F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    top = components(scratch, ends, "top")
    both = (labels.join(top.select(F.col("node").alias("label"), F.col("label").alias("last")), "label", "left")
            .select("node", F.coalesce("last", "label").alias("label"))
            .unionByName(top.join(labels.select("node"), "node", "left_anti")))
    return scratch.keep("labels", both)


def connected(scratch: Scratch, sets: DataFrame, known: DataFrame, size: int, percent: int, name: str,
              labels: DataFrame | None = None) -> DataFrame:
    """``node, label`` of all linked ``sets``, going on from ``labels``: the rounds of step 4.

    Who gives ``labels`` has compared members with one centre already, so the round with one centre is left out.
    """
    step = scratch.within(f"{name}-start")
    members = step.keep("members", _buckets(sets))
    turn, centres = (0, 1) if labels is None else (1, MORE_CENTRES)
    bits = sets.select("rep", *_BITS)
    while True:
        before, step = step, scratch.within(f"{name}-{turn}")
        if labels is None:  # nothing is connected yet
            rows = members.select("key", "rep", "n", "room", F.col("rep").alias("comp"), "size", F.lit(False).alias("easy"))
        else:
            rows = _unsettled(members, labels, turn, percent)
            # What is left meets many others, so its bits go with it; first only one centre is met.
            rows = step.keep("unsettled", rows.join(bits, "rep") if turn else rows)
        easy_rows, hard_rows = rows.agg(F.count_if("easy"), F.count_if(~F.col("easy"))).first()
        if easy_rows + hard_rows == 0:
            break
        may = (lambda x, y: _may_meet(x, y, percent) & _may_link(x, y, percent)) if turn else (
            lambda x, y: close_in_size(F.col(f"{x}.n"), F.col(f"{y}.n"), percent))
        hard, pairs = rows.where("not easy"), None
        if hard_rows:
            chosen = step.keep("centres", _centres(hard, turn, centres))
            pairs = hard.alias("x").join(chosen.alias("y"), [
                F.col("x.key") == F.col("y.key"), F.col("x.comp") != F.col("y.comp"), F.col("x.rep") != F.col("y.rep"),
                may("x", "y")]).select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b"))
            members = step.keep("members", hard.join(chosen, ["key", "rep"], "left_anti").select("key", "rep", "n", "room"))
        if easy_rows:
            few = _bucket_pairs(rows.where("easy"), F.col("x.comp") != F.col("y.comp"), may("x", "y"))
            pairs = few if pairs is None else pairs.unionByName(few)
        links = verified(step, known, _filtered(step, pairs, sets, percent), size, percent, "links")
        labels = _merged(step, labels, links)
        if not hard_rows:
            break
        before.clear()
        turn, centres = turn + 1, centres * MORE_CENTRES
    labels = scratch.keep(f"{name}-labels", labels if labels is not None else _no_labels(scratch))
    before.clear()
    step.clear()
    return labels


def _unsettled(members: DataFrame, labels: DataFrame, turn: int, percent: int) -> DataFrame:
    """Members of buckets that are not all connected, with their component, the bucket's size and whether it is easy.

    Members of easy buckets without room for the smallest set there meet nobody and are left out.
    """
    placed = members.join(labels, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "n", "room", F.coalesce("label", "rep").alias("comp"))
    parts = placed.groupBy("key", "comp").agg(F.count("*").cast("double").alias("part"), F.min("n").alias("low"))
    sizes = parts.groupBy("key").agg(F.sum("part").alias("size"), F.sum(F.col("part") * F.col("part")).alias("squares"),
                                     F.min("low").alias("least"))
    cross = (F.col("size") * F.col("size") - F.col("squares")) / 2
    open_ = sizes.where(cross > 0).select(
        "key", "size", "least", (F.lit(turn > 0) & (cross <= EASY * F.col("size"))).alias("easy"))
    return placed.join(open_, "key").where(~F.col("easy") | _has_room("room", "n", "least", percent)).select("key", "rep", "n", "room", "comp", "size", "easy")


def _no_labels(scratch: Scratch) -> DataFrame:
    return scratch.spark.createDataFrame([], "node long, label long")


def _centres(rows: DataFrame, turn: int, centres: int) -> DataFrame:
    """About so many members of each bucket, one at least: first that which meets most others over all its buckets."""
    member = F.struct(*(c for c in rows.columns if c not in ("key", "size", "easy")))
    if turn == 0:
        meets = rows.groupBy("rep").agg(F.sum("size").alias("meets"))
        order = F.struct("meets", -F.col("rep"))
        return rows.join(meets, "rep").groupBy("key").agg(F.max_by(member, order).alias("c")).select("key", "c.*")
    hashed = rows.withColumn("h", F.xxhash64("rep", "key", F.lit(turn)))
    one = hashed.groupBy("key").agg(F.min_by(member, F.struct("h", "rep")).alias("c")).select("key", "c.*")
    some = hashed.where(F.pmod("h", F.col("size").cast("long")) < centres).select(one.columns)
    return one.unionByName(some).distinct()


def ngram_join(docs: DataFrame, size: int = 3, percent: int = 90, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Components of documents linked by ``100 * intersection >= percent * union`` of their sets of word shingles.

    Columns: ``doc_id, n_shingles, component_id`` (the smallest id reachable, itself included). Words are compared without
    the case of A-Z; fewer than ``size`` words are one shingle. Null texts and texts without words have an empty set and
    are linked with nothing. A row without an id has no component. Rows with the same id are one document, whatever their
    texts; each of them is returned. Empty input gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "ngram-join")
    rows = only(docs, doc_id=id_col, text=text_col)
    own, sets = sketches(scratch, rows, size, percent, "all")
    labels = connected(scratch, sets, rows.where("doc_id is not null"), size, percent, "round")
    found = sets.select("digest", "rep").join(labels, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("label", "rep").alias("label"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return own.join(found, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def similar_pairs(docs: DataFrame, size: int = 3, percent: int = 90, id_col: str = "doc_id",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every link: pairs ``a < b`` of classes, and ``doc_id, class_id`` of all documents that are in a class.

    A class is a set of shingles and named by the smallest id that has it, so copies are not expanded into pairs. All
    candidate pairs are confirmed, however many a group gives. Nulls and repeated rows as in :func:`ngram_join`; a document
    with several texts is in several classes.
    """
    scratch = Scratch(docs.sparkSession, "ngram-pairs")
    rows = only(docs, doc_id=id_col, text=text_col)
    own, sets = sketches(scratch, rows, size, percent, "all")
    members = scratch.keep("members", _buckets(sets))
    members = members.select("key", "rep", "n", "room").join(sets.select("rep", *_BITS).dropDuplicates(["rep"]), "rep")
    pairs = _filtered(scratch, _bucket_pairs(members, _may_meet("x", "y", percent) & _may_link("x", "y", percent)), sets, percent)
    links = verified(scratch, rows.where("doc_id is not null"), pairs, size, percent, "every")
    membership = own.where("doc_id is not null").join(sets.select("digest", F.col("rep").alias("class_id")), "digest").select(
        "doc_id", "class_id").distinct()
    return links, membership
