"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A document is its set of word shingles. Two permutations make the whole signature: the first gives each shingle its
position, the second is applied to the positions shifted circularly by one step for each coordinate, and the coordinate
is the smallest value. Four coordinates make a band; documents with an equal band are candidates.

1. Documents with the same set are one class from the start; only its smallest id goes on.
2. In each bucket all members are compared with one centre, the smallest id, which is that of many of its bands. A bucket
   of m documents gives m - 1 pairs, not m * m. Each distinct pair is verified on the full sets.
3. Buckets whose members are all connected by now are done. Members of the others go through an exact filter: a linked
   pair shares a shingle among the rarest of both, so pairs come from those shingles and not from the bucket, which may
   hold a hot passage (:func:`martworks.llm.ngram_join.connected`, by rounds of centres). No candidate is given up,
   whatever the size of a bucket, and no step joins the members of a bucket with each other.
4. Connected components of all links give each document the smallest id it is connected with.

Pairs at the bound of 0.8 share no band of 32 with a chance of (1 - 0.8**4)**32, less than 1 in 10 million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm import ngram_join
from martworks.llm.components import components
from martworks.llm.linking import blocks, close_in_size, shingle_sets, texts_of, verified
from martworks.llm.scratch import Scratch, only
from martworks.llm.words import Texts, mix

COORDINATES, ROWS = 128, 4
# Further flipped bits of the members of unsettled buckets: many of their pairs differ by little more than the bound allows.
# With 4,096 bits such pairs are told apart before prefixes and texts are shuffled for them.
WIDE = (ngram_join.WIDE[0], (48, 64))


_U = np.uint32


def signatures(shingles: np.ndarray, at: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of non-empty sets: a row of ``coordinates`` values for each."""
    out = np.empty((len(at) - 1, coordinates), np.uint32)
    position = (mix(shingles) >> np.uint64(32)).astype(np.uint32)  # the first permutation
    lo = 0
    while lo < len(at) - 1:  # a few ten thousand shingles at a time stay in the processor's cache
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + 65_536, side="right")) - 1)
        own, begin = position[at[lo]: at[hi]], at[lo:hi] - at[lo]
        value, half = np.empty_like(own), np.empty_like(own)
        for k in range(coordinates):
            np.add(own, _U(k), out=value)  # shifted by one step a coordinate, round the 2**32 positions
            for shift, odd in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):  # the second permutation
                np.right_shift(value, _U(shift), out=half)
                np.bitwise_xor(value, half, out=value)
                np.multiply(value, _U(odd), out=value)
            out[lo:hi, k] = np.minimum.reduceat(value, begin)
        lo = hi
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band, distinct between bands."""
    parts = signature.reshape(len(signature), signature.shape[1] // rows, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key


def _sketch(size: int, coordinates: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            shingles, at = shingle_sets(Texts.of(batch.column("text")), size)
            n = np.diff(at)
            digests = [hashlib.blake2b(shingles[a:b].tobytes(), digest_size=16).digest() if b > a else None
                       for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            full = np.flatnonzero(n)
            keys = band_keys(signatures(shingles, np.concatenate([[0], np.cumsum(n[full])]), coordinates), rows)
            width = coordinates // rows
            offsets = np.concatenate([[0], np.cumsum((n > 0) * width)]).astype(np.int32)
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                                   pa.ListArray.from_arrays(offsets, keys.ravel().view(np.int64))],
                                  ["doc_id", "n", "digest", "bands"])

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    coordinates: int = COORDINATES, rows: int = ROWS) -> DataFrame:
    """The near-duplicate component of each document.

    Columns: ``doc_id, n_shingles, component_id, kept`` (``doc_id = component_id``). Words are compared without the case
    of A-Z; documents are linked when ``100 * intersection >= percent * union`` of their shingle sets. Null texts and
    texts without words are linked with nothing. A row without an id has no component and is kept. Rows with the same id
    are one document, whatever their texts; each of them is returned. Empty input gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "near-dedup")
    rows_in = only(docs, doc_id=id_col, text=text_col)
    known = rows_in.where("doc_id is not null")
    sketches = scratch.keep("sketches", rows_in.mapInArrow(
        _sketch(size, coordinates, rows), "doc_id long, n long, digest binary, bands array<long>"))
    classes = scratch.keep("classes", sketches.where("doc_id is not null and n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    keys = classes.select("rep", "n", F.explode("bands").alias("key"))
    crowded = keys.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("rep", "n")).alias("centre"))
    members = scratch.keep("members", keys.join(crowded.where("size > 1"), "key"))
    stars = (members.where(F.col("rep") != F.col("centre.rep")).where(close_in_size(F.col("n"), F.col("centre.n"), percent))
             .select(F.col("centre.rep").alias("a"), F.col("rep").alias("b")).distinct())
    links = verified(scratch, known, stars, size, percent, "stars")
    first = components(scratch, links, "first")
    open_ids = _unsettled(scratch, members, first)
    rest = texts_of(known, open_ids)
    _, sets = ngram_join.sketches(scratch, rest, size, percent, "rest", WIDE)
    labels = ngram_join.connected(scratch, sets, rest, size, percent, "round", first)
    scratch.drop(members, links, sets)
    found = classes.select("digest", "rep").join(labels, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("label", "rep").alias("label"))
    out = sketches.select("doc_id", "n", "digest").join(found, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _unsettled(scratch: Scratch, members: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id`` of the members of buckets of more than two whose members are not all connected by the centre."""
    placed = members.where("size > 2").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("label", "rep").alias("comp"))
    some = placed.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most")
    return scratch.keep("unsettled", placed.join(some.select("key"), "key", "left_semi").select(
        F.col("rep").alias("doc_id")).distinct())


def near_dedup(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One document of each near-duplicate component, with all columns of ``docs``: that with the smallest id.

    Rows with the same id are one document: of several with that id the one with the smallest text stays (null first), and
    of equal texts that whose other columns are the smallest as JSON. Rows without an id all stay.
    """
    decided = near_duplicates(docs, size, percent, id_col, text_col)
    kept = Scratch(docs.sparkSession, "near-dedup").keep("kept", decided.where("kept and doc_id is not null").groupBy(
        F.col("doc_id").alias(id_col)).agg(F.count("*").alias("copies")))
    once = docs.join(kept.where("copies = 1").select(id_col), id_col, "left_semi")
    rest = F.to_json(F.struct(*(docs[f"`{c}`"] for c in docs.columns if c != text_col)))
    order = F.struct(docs[f"`{text_col}`"], rest)
    again = docs.join(kept.where("copies > 1").select(id_col), id_col, "left_semi").groupBy(
        docs[f"`{id_col}`"].alias("id")).agg(
        F.min_by(F.struct(*(docs[f"`{c}`"] for c in docs.columns)), order).alias("row")).select("row.*")
    return once.select(docs.columns).unionByName(again).unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
