"""Best-fit packing of documents into sequences of a fixed number of tokens.

Best-fit decreasing puts each piece, longest first, into the open sequence with the least room that still holds it. The
choice depends on lengths only, and there are at most ``size`` of them, so the plan is made for the counts of lengths:
pieces of one length go together into sequences with the same room. A segment tree over the rooms (how many open sequences have
each) finds the tightest room in logarithmic time. The result equals best-fit decreasing run piece by piece. The plan's
size depends on the number of lengths, not of documents; workers then number the pieces of each length and look their
sequence up in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martworks.llm.scratch import Scratch, only
from martworks.llm.token_ids import PieceIds

SIZE = 2048
# Documents that one task numbers; the numbering of a length is split over so many tasks as this asks for.
ROWS_PER_SALT = 50_000


class RoomTree:
    """Segment tree over rooms 0..size: the smallest room of at least ``n`` that some open sequence has."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.any = [False] * (2 * self.width)

    def set(self, room: int, filled: bool) -> None:
        node = room + self.width
        self.any[node] = filled
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        node = least + self.width
        if self.any[node]:
            return least
        while node > 1:  # up to the first right neighbour that holds something
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.width:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.width


@dataclass
class Plan:
    """Pieces ``rank .. rank + n`` of a length go to sequences ``sequence .. sequence + n`` at ``offset``."""

    key: np.ndarray  # length << 44 | rank of the first piece, ascending
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length.astype(np.int64) << 44) | rank
        row = np.searchsorted(self.key, key, side="right") - 1
        return self.sequence[row] + key - self.key[row], self.offset[row]


def best_fit_decreasing(counts: dict[int, int], size: int) -> Plan:
    """``counts``: how many pieces have each length (1 to ``size``)."""
    tree, open_by_room = RoomTree(size), {}
    rows, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:  # as many new sequences as pieces are left, each filled with as many as it holds
                each = size // length
                n = -(-left // each)
                first, opened = opened, opened + n
                whole, rest = divmod(left, each)
                for k in range(each):  # the k-th piece of each new sequence; sequence by sequence in rank
                    run = whole + (k < rest)
                    if run:
                        rows.append((length, rank, first, k * length))
                        rank += run
                for start, many, used in ((first, whole, each), (first + whole, 1 if rest else 0, rest)):
                    if many:
                        _open(open_by_room, tree, size - used * length, start, many)
                left = 0
                continue
            ranges = open_by_room[room]
            start, many = ranges.pop()
            n = min(left, many)
            rows.append((length, rank, start, size - room))
            rank, left = rank + n, left - n
            if n < many:
                ranges.append((start + n, many - n))
            elif not ranges:
                tree.set(room, False)
            _open(open_by_room, tree, room - length, start, n)
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return Plan((table[:, 0] << 44) | table[:, 1], table[:, 2], table[:, 3], opened)


def _open(open_by_room: dict, tree: RoomTree, room: int, start: int, many: int) -> None:
    open_by_room.setdefault(room, []).append((start, many))
    tree.set(room, True)


def token_lengths(docs: DataFrame, id_col: str, text_col: str, size: int, end_id: int, path: str | None) -> DataFrame:
    """``doc_id, nth, n_ids, crcs``: a number of the row within its task, the number of ids with the end id, and the
    CRC-32 of each piece's ids."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, end, seen = PieceIds.of_worker(path), np.array([end_id], "<u4").tobytes(), 0
        for batch in batches:
            nth, seen = np.arange(seen, seen + batch.num_rows), seen + batch.num_rows
            lengths, crcs = [], []
            for text in batch.column(1).to_pylist():
                raw = pieces.ids(text).tobytes() + end
                lengths.append(len(raw) // 4)
                crcs.append([zlib.crc32(raw[k: k + 4 * size]) for k in range(0, len(raw), 4 * size)])
            yield pa.record_batch([batch.column(0), pa.array(nth, pa.int64()), pa.array(lengths, pa.int64()),
                                   pa.array(crcs, pa.list_(pa.int64()))], ["doc_id", "nth", "n_ids", "crcs"])

    return only(docs, doc_id=id_col, text=text_col).mapInArrow(
        measure, "doc_id long, nth long, n_ids long, crcs array<long>")


def pack(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
         tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents with their sequence and their offset in it.

    Columns: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. Documents of more than ``size`` ids are
    cut into pieces of ``size``; their last piece may be shorter. A null or empty text is the end id alone. Repeated
    rows, also rows without an id, are packed as many times as they occur. No documents give no pieces. Other columns of
    ``docs`` are ignored whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    lengths = scratch.keep("lengths", token_lengths(docs, id_col, text_col, size, end_id, tokenizer))
    salts = max(1, -(-lengths.count() // ROWS_PER_SALT))
    last = F.col("n_ids") % size
    salted = (lengths
              .withColumn("salt", F.pmod(F.xxhash64("doc_id", "nth"), F.lit(salts)))
              .withColumn("full", F.floor(F.col("n_ids") / size)).withColumn("rest", last))
    before = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    by_salt = salted.groupBy("rest", "salt").agg(F.count("*").alias("n"))
    by_rest = by_salt.withColumn("rank0", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # At most ``size`` rows come to the driver.
    counts = {r.rest: r.n for r in by_salt.groupBy("rest").agg(F.sum("n").alias("n")).collect() if r.rest}
    plan = best_fit_decreasing(counts, size)
    fulls = salted.groupBy("salt").agg(F.sum("full").alias("full"))
    full_before = Window.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = fulls.select("salt", F.coalesce(F.sum("full").over(full_before), F.lit(0)).alias("full0"))  # a row a salt
    return _assign(spark, salted, by_rest.drop("n"), bases, plan, size)


def _assign(spark: SparkSession, salted: DataFrame, ranks: DataFrame, bases: DataFrame, plan: Plan, size: int) -> DataFrame:
    """Number the pieces of each length and of whole pieces, then look their sequences up."""
    in_rest = Window.partitionBy("salt", "rest").orderBy("doc_id", "crcs")
    in_salt = (Window.partitionBy("salt").orderBy("rest", "doc_id", "crcs")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = (salted.join(ranks, ["rest", "salt"]).join(bases, "salt")
                .withColumn("rank", F.col("rank0") + F.row_number().over(in_rest) - 1)
                .withColumn("whole", F.col("full0") + F.sum("full").over(in_salt) - F.col("full"))
                .select("doc_id", "n_ids", "crcs", "rest", "rank", "full", "whole"))
    shared = spark.sparkContext.broadcast(astuple(plan))  # bounded by the number of lengths

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(*shared.value)
        for batch in batches:
            n_ids, rest, rank, full, whole = (batch.column(c).to_numpy(zero_copy_only=False)
                                              for c in ("n_ids", "rest", "rank", "full", "whole"))
            crcs = batch.column("crcs")
            pieces = full + (rest > 0)
            row = np.repeat(np.arange(len(n_ids)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence, offset = plan.sequences + whole[row] + piece, np.zeros(len(row), np.int64)
            short = piece == full[row]
            sequence[short], offset[short] = plan.place(rest[row][short], rank[row][short])
            yield pa.record_batch(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(piece * size),
                 pa.array(np.where(short, rest[row], size)), crcs.flatten(), pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(
        assign, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
