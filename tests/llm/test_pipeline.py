import zlib

import pytest
from oddities import frame, texts
from test_decontaminate import clean
from test_near_dedup import brute as groups_of
from test_secrets import brute as secrets_of

import corpus_pipeline
from martworks.llm import secrets, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage over the whole table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    base = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        path = f"{base}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = (before, docs.collect(), docs.columns)
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_toxic_documents_go(spark, stages):
    before, after, columns = stages["toxicity"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    score = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert ids(after) == sorted(r.doc_id for r in before if score[r.doc_id] < 0.5)
    assert columns == docs.columns


def test_one_of_each_group_stays(stages):
    before, after, columns = stages["near_dedup"]
    assert ids(after) == sorted(set(groups_of([(r.doc_id, r.text) for r in before], 5).values()))
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_leaks_go(spark, stages):
    before, after, columns = stages["decontamination"]
    items = [clean(r.text).strip() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in before if any(i in clean(r.text) for i in items)}
    assert holds and not holds & set(ids(after))
    assert len(after) >= len(before) - len(holds) - 2


def test_secrets_are_masked_and_clean_documents_unchanged(stages):
    before, after, columns = stages["secrets"]
    now = {r.doc_id: r for r in after}
    assert ids(before) == ids(after)
    for r in before:
        spans = secrets_of(r.text)
        assert (now[r.doc_id] == r) == (not spans)
        if spans:
            assert secrets.MARK in now[r.doc_id].text and now[r.doc_id].n_chars == len(now[r.doc_id].text)


def test_all_of_them_are_packed(stages):
    before, after, columns = stages["packing"]
    assert {r.doc_id for r in after} == set(ids(before))
    assert columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_run_is_the_stages_one_after_the_other(spark, stages):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages["packing"][1]))


def test_stages_bear_odd_rows(spark):
    docs = frame(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    left = [r.doc_id for r in docs.collect()]
    assert left.count(None) == 2 and {1, 4, 5, 6, 9} <= set(left) and not {2, 3, 8} & set(left)
    assert corpus_pipeline.pack(spark, docs, SF).select("doc_id").distinct().count() == len(set(left))


def test_stages_bear_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
    assert len(texts()) > 10


@pytest.mark.parametrize("kind", ["none", "null", "held out", "unmatched", "toxic only", "clean only", "too few"])
def test_all_documents_stay_when_nothing_is_learned(spark, tmp_path, kind):
    docs = frame(spark, [(k, f"word{k} text") for k in range(40)] + [(None, "no id"), (3, None)])
    held = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 0]
    free = [k for k in range(40) if k not in held]
    labels = {"none": [], "null": [(k, None) for k in free], "held out": [(k, k % 2) for k in held],
              "unmatched": [(1000 + k, k % 2) for k in range(100)], "toxic only": [(k, 1) for k in free],
              "clean only": [(k, 0) for k in free], "too few": [(free[0], 1), (free[1], 1), (free[2], 0)]}[kind]
    assert held
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.count() == docs.count()
