import bisect
import random
import struct
import zlib
from collections import defaultdict

import pytest
from oddities import frame, texts
from pyspark.sql import functions as F

from martworks.llm import packing, token_counts
from martworks.llm.token_ids import PieceIds, tokenizer_path

ODD = [" ", "\n", "\t", "\r", " ", "\xa0", "a", "B", "é", "é", "́", "'", "s", "<|endoftext|>", "<|EndOfText|>",
       "İ", "1", "ß", "Σ", "ς", "-", "\x85", "\x1c", ".", ",", "!?", "Å", "K", "ﬁ", "ŉ", "ǅ", "가", "😀", "'ll", "'S"]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_whole_texts(whole):
    rng, pieces = random.Random(5), PieceIds()
    rows = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    rows += [t for _, t in texts()]
    assert [t for t in rows if pieces.ids(t).tolist() != whole(t)] == []


def test_the_remembered_table_is_bounded(whole, monkeypatch):
    monkeypatch.setattr("martworks.llm.token_ids.REMEMBERED", 50)
    pieces = PieceIds()
    text = " ".join(f"word{k}, again{k % 7}." for k in range(400))
    assert pieces.ids(text).tolist() == whole(text)
    assert len(pieces.known) + len(pieces.older) <= 100


def bins_of(lengths, size):
    """Best-fit decreasing, piece by piece."""
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        if at == len(rooms):
            n += 1
            room = size
        else:
            room = rooms.pop(at)
        bisect.insort(rooms, room - length)
    return n, sorted(rooms)


@pytest.mark.parametrize("seed", range(25))
def test_plan_equals_best_fit_decreasing(seed):
    rng = random.Random(seed)
    size = rng.choice([7, 16, 64, 100])
    lengths = [rng.randint(1, rng.choice([size, max(1, size // 3)])) for _ in range(rng.choice([0, 1, 5, 60, 700]))]
    counts = defaultdict(int)
    for length in lengths:
        counts[length] += 1
    plan = packing.best_fit_decreasing(dict(counts), size)
    used = defaultdict(list)
    for length, n in counts.items():
        for rank in range(n):
            row = bisect.bisect_right(plan.key.tolist(), (length << 44) | rank) - 1
            used[int(plan.sequence[row] + rank - (plan.key[row] & ((1 << 44) - 1)))].append((int(plan.offset[row]), length))
    n, rooms = bins_of(lengths, size)
    assert len(used) == plan.sequences == n
    assert sorted(size - sum(x for _, x in v) for v in used.values()) == rooms
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length


def checked(rows, docs, whole, size):
    """Pieces hold each document's ids, sequences have no gaps and are as many as best-fit decreasing needs."""
    expected, lengths = [], []
    for doc_id, text in docs:
        ids = [*whole(text), 0]
        for k in range(0, len(ids), size):
            piece = ids[k: k + size]
            lengths.append(len(piece))
            expected.append((doc_id, k // size, k, len(piece), zlib.crc32(struct.pack(f"<{len(piece)}I", *piece))))
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(expected, key=repr)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    assert len(sequences) == bins_of(lengths, size)[0]


@pytest.mark.parametrize("salt_rows", [50_000, 3])
def test_pack_odd_rows(spark, whole, monkeypatch, salt_rows):
    monkeypatch.setattr(packing, "ROWS_PER_SALT", salt_rows)
    docs = texts() + [(20, "same text")] * 9
    checked(packing.pack(frame(spark, docs), size=64).collect(), docs, whole, 64)


def test_pack_nothing(spark):
    assert packing.pack(frame(spark, [])).collect() == []


def test_query_packs_all_documents(spark, whole):
    from martworks.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    checked(QUERIES["op9_best_fit_packing"](spark, "/root/testdata/sf0.001").collect(), docs, whole, packing.SIZE)


def limits_of(lengths, also=()):
    out = []
    for n in sorted({*lengths, *also}):
        longer = [x for x in lengths if x > n]
        kept = sum(min(x, n) for x in lengths)
        out.append((n, lengths.count(n), len(lengths) - len(longer), sum(lengths) - sum(longer), len(longer), sum(longer), kept,
                    sum(lengths) - kept))
    return out


def test_token_limits(spark, whole, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 16)
    lengths = [len(whole(t)) for _, t in texts()]
    counts = token_counts.histogram(frame(spark))
    table = token_counts.limits(counts)
    assert sorted(map(tuple, table.collect())) == limits_of(lengths)
    assert token_counts.truncated_total(counts, 50).first().tokens == sum(min(n, 50) for n in lengths)
    middle = sorted(lengths)[-(-len(lengths) // 2) - 1]
    assert table.agg(token_counts.quantile(table, 0.5).alias("q")).first().q == middle
    assert token_counts.limits(token_counts.histogram(frame(spark, []))).collect() == []


def test_query_counts_all_documents(spark, whole):
    from martworks.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("text")).collect()
    got = QUERIES["op10_token_counts"](spark, "/root/testdata/sf0.001")
    assert got.columns[-1] == "quantiles"
    lengths = sorted(len(whole(r.text)) for r in docs)
    assert sorted(tuple(r)[:-1] for r in got.collect()) == limits_of(lengths, token_counts.CONTEXTS)
    of_share = {q: r.n_tokens for r in got.collect() for q in r.quantiles}
    assert of_share == {q: min(n for n in lengths if sum(x <= n for x in lengths) >= q * len(lengths))
                        for q in token_counts.SHARES}


def test_limits_that_no_document_has(spark, whole):
    lengths = [len(whole(t)) for _, t in texts()]
    also = [n for n in (1, 3, 512, 10 ** 7) if n not in lengths] + [lengths[0]]
    assert sorted(map(tuple, token_counts.limits(token_counts.histogram(frame(spark)), also).collect())) == limits_of(lengths, also)
    none = token_counts.with_quantiles(token_counts.limits(token_counts.histogram(frame(spark, [])), [512]))
    assert [tuple(r) for r in none.collect()] == [(512, *[0] * 7, [])]


def test_texts_are_encoded_once(spark):
    counts = token_counts.histogram(frame(spark))
    plan = token_counts.with_quantiles(token_counts.limits(counts, [512]))._jdf.queryExecution().toString()
    assert "InArrow" not in plan
