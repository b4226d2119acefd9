import random
import tracemalloc

import pyarrow as pa
import pytest
from oddities import frame, prose, texts

from martworks.llm import decontaminate
from martworks.llm.queries import QUERIES


def clean(text):
    points, _ = decontaminate.normalise(decontaminate._code_points(text or ""))
    return "".join(map(chr, points.tolist()))


def least_edits(pattern, text):
    """Edits of the best place for a pattern in a text, over all places."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def segments_of(items):
    found = decontaminate.Segments(items, decontaminate.EDITS)
    return [(i, "".join(map(chr, p.tolist())), int(k)) for i, p, k in zip(found.item, found.parts, found.budget, strict=True)]


def brute(docs, items):
    parts = segments_of(items)
    return {(d, i) for d, t in docs for i, p, k in parts if least_edits(p, clean(t)) <= k}


def edits(text, seed, n):
    rng, out = random.Random(seed), list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        out[k: k + 1] = rng.choice([[], ["q"], [out[k], "z"]])
    return "".join(out)


ITEMS = [(1, prose(60, 20)), (2, prose(61, 70)), (3, "too short"), (4, None), (5, "Ärger über ÉCOLE und mehr Wörter in einem Satz, " * 2),
         (6, prose(62, 9)), (2, prose(61, 70))]


def pairs(df):
    return {(r.doc_id, r.item_id) for r in df.collect()}


@pytest.mark.parametrize("block", [2_000_000, 150])
def test_equals_full_alignment(spark, monkeypatch, block):
    """Passages with 0 to 14 edits, around the budget, and texts without any; also with the benchmark in several blocks."""
    monkeypatch.setattr(decontaminate, "CHUNK", 700)
    docs = []
    for k in range(45):
        _, passage = [(i, t) for i, t in ITEMS if t and len(t) > 30][k % 4]
        docs.append((100 + k, prose(k, 12) + " " + edits(passage, k, k % 15).upper() + "\t\n " + prose(70 + k, 12)))
    docs += [(200 + k, prose(300 + k, 40)) for k in range(5)] + [(300, prose(61, 70)[40:260]), (301, ITEMS[0][1]), (302, None), (303, "")]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_leaks(frame(spark, docs), bench, block_characters=block)
    expected = brute(docs, sorted({(i, t) for i, t in ITEMS if t}))
    assert pairs(found) == expected
    assert len(expected) > 25 and not any(200 <= d < 300 for d, _ in expected)


def test_places_are_those_of_the_text(spark):
    passage = ITEMS[0][1]
    text = "É  é\n\n" + prose(8, 30) + "   " + passage.replace(" ", " \n ") + " tail"
    row = decontaminate.find_leaks(frame(spark, [(1, text)]), spark.createDataFrame(ITEMS[:1], "item_id long, text string")).first()
    assert clean(text[row.start: row.end]) == clean(passage) and row.edits == 0


def test_only_leaking_documents_go(spark):
    bench = spark.createDataFrame([(9, texts()[0][1])], "item_id long, text string")
    docs = frame(spark)
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.schema.names == docs.schema.names
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert left == sorted(((d, t) for d, t in texts() if d not in (1, 2, 3) and (d is not None or t is None)), key=repr)


def test_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(frame(spark), bench).collect() == []
    assert decontaminate.decontaminate(frame(spark), bench).count() == len(texts())
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find_leaks(frame(spark, []), bench).collect() == []


def test_query_over_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    whole = {(i, t) for i, t in docs for _, x in items if clean(x).strip() in clean(t)}
    found = {r.doc_id for r in QUERIES["op5_benchmark_decontamination"](spark, d).collect()}
    assert found >= {i for i, _ in whole}
    few = [(i, t) for i, t in docs if i in found or i % 40 == 0]
    few = [(i, t) for i, t in few if len(t or "") < 2500]
    assert {i for i, _ in brute(few, items)} == found & {i for i, _ in few}


RUNS = [(1, "____ is the capital of a country whose name nobody in this long sentence remembers, as was said before"),
        (2, "question .... with dots inside of it .... and more of them at the very end of the whole item ............"),
        (3, "=" * 140), (4, "ab" * 70), (5, "Name it: ......................12")]


def test_runs_in_items_and_texts(spark):
    docs = [(1, "no leak, but a text that ends in a run ____________________________________"), (2, "........................"),
            (3, "x" + RUNS[0][1]), (4, RUNS[1][1] + "......."), (5, "=" * 3000), (6, "-" * 3000), (7, "ba" * 800),
            (8, "tail ....................12"), (9, "begin Name it: ......................12"), (10, "____")]
    bench = spark.createDataFrame(RUNS, "item_id long, text string")
    for order in (docs, docs[::-1]):
        assert pairs(decontaminate.find_leaks(frame(spark, order).coalesce(1), bench)) == brute(docs, RUNS)


def test_a_long_run_takes_bounded_memory():
    import tracemalloc

    segments = decontaminate.Segments(RUNS, decontaminate.EDITS)
    tracemalloc.start()
    found = decontaminate.found_in(segments, ["=" * 400_000])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(found) == {(0, 3)}
    assert most < 250e6


def test_short_items_are_found_exactly_and_100_characters_of_any_item(spark):
    items = [(1, "the answer is 42"), (2, "too short"), (3, prose(90, 33)), (4, prose(91, 26)[:110])]
    docs = [(1, "as we know The  answer is 42, or is it"), (2, "the answer is 43"), (3, "a too short one"),
            *((10 + k, f"before {items[2][1][k: k + 150]} after") for k in range(0, 20, 5)),
            (30, f"before {items[3][1][:100]} after"), (31, f"before {items[3][1][10:]} after")]
    found = pairs(decontaminate.find_leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")))
    assert found == {(1, 1), (10, 3), (15, 3), (20, 3), (25, 3), (30, 4), (31, 4)}


def test_each_row_is_judged_by_its_own_text(spark):
    bench = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    rows = [(5, "clean"), (5, ITEMS[0][1]), (6, "other")]
    for more in ([], [(None, "no id"), (None, ITEMS[0][1])]):
        kept = decontaminate.decontaminate(frame(spark, rows + more), bench).collect()
        assert sorted((r.text for r in kept)) == sorted(["clean", "other"] + ["no id"] * bool(more))


def test_a_task_holds_the_characters_of_a_few_texts_at_once():
    """Rows of 8 MB are searched with the memory of a part of them, and give what they give one by one."""
    some, item = [prose(k, 600, 10_000) for k in range(100)], prose(999, 30, 10_000)
    rows = [some[k % 100] for k in range(1500)] + [None, ""]
    rows[700] = f"{rows[700]} {item} {rows[701]}"
    batch = pa.record_batch([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string())], ["id", "body"])
    assert batch.column("body").nbytes > 4 << 20
    run = decontaminate._without([(1, item)], decontaminate.EDITS, "body")
    tracemalloc.start()
    kept = [r for part in run(iter([batch])) for r in part.column("id").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.stop()
    assert kept == [k for k in range(len(rows)) if k != 700]
    assert peak < 40, peak
