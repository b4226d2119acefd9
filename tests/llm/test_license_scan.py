from compare import differences, duck
from oddities import frame, texts

from martworks.llm import license_scan
from martworks.llm.license_texts import TEXTS
from martworks.llm.queries import QUERIES, SQL


def by_id(df):
    return {r.doc_id: (r.license_id, r.notices, r.n_notices) for r in df.collect()}


def test_every_known_text_is_found_in_any_dress(spark):
    docs, expected = [], {}
    for k, (license_id, text) in enumerate(TEXTS):
        if len(text) < 200:
            continue
        variants = [text, text.upper(), "Copyright (c) 2020 Some One\n(C) 2021 Another\n" + text,
                    " * " + text.replace("\n", "\n * "), text.replace("license", "licence").replace("License", "Licence"),
                    text.replace(",", " ;").replace("\n", "\r\n")]
        for j, variant in enumerate(variants):
            docs.append((100 * k + j, variant))
            expected[100 * k + j] = license_id
        docs.append((100 * k + 99, text + " and one more condition"))
        expected[100 * k + 99] = None
    assert {d: found[0] for d, found in by_id(license_scan.scan(frame(spark, docs))).items()} == expected


def test_notices_stand_on_lines_of_their_own(spark):
    docs = [(1, "Some words.\nReleased under the MIT License.\nmore\n\n  licensed UNDER cc by-nc 4.0"),
            (2, "He said: Released under the MIT License. Then left."), (3, "Released under the MIT Licence!"), (4, None), (5, "")]
    assert by_id(license_scan.scan(frame(spark, docs))) == {
        1: (None, "CC-BY-NC-4.0,MIT", 2), 2: (None, "", 0), 3: ("MIT", "MIT", 1), 4: (None, "", 0), 5: (None, "", 0)}


def test_a_copyright_line_is_one_whatever_follows(spark):
    whole = [(license_id, text) for license_id, text in TEXTS if len(text) >= 200]
    lines = ["Copyright Jane Doe 2020", "Copyright The X Authors", "Copyright: 2020 X", "Copyright <year> <holder>", "© Jane Doe",
             "Copyright (c) <copyright holders>", "// Copyright by Jane Doe", " * (c) The University of X", "(C) Copyright Émile",
             "(c) 2020 This Is Not Inc.", "Copyright 2020, 2021 Jane Doe. All rights reserved."]
    docs = [(100 * k + j, f"{line}\n{text}") for k, (_, text) in enumerate(whole) for j, line in enumerate(lines)]
    expected = {100 * k + j: whole[k][0] for k in range(len(whole)) for j in range(len(lines))}
    kept = ["Copyright notice", "copyright holders and you agree", "Copyright law applies", "copyrighted by X",
            "(c) You must retain all notices", "  (c) any change is stated", "we hold the copyright 2020"]
    docs += [(10_000 + j, f"{whole[0][1]}\n{line}") for j, line in enumerate(kept)]
    expected |= {10_000 + j: None for j in range(len(kept))}
    # Wrapped after each word in turn, a text keeps its digest.
    words = whole[0][1].split()
    docs += [(20_000 + j, " ".join(words[:j]) + "\n" + " ".join(words[j:])) for j in range(1, len(words))]
    expected |= {20_000 + j: whole[0][0] for j in range(1, len(words))}
    assert {d: found[0] for d, found in by_id(license_scan.scan(frame(spark, docs))).items()} == expected


def test_a_line_is_looked_up_however_long(spark):
    whole = [(license_id, " ".join(text.split())) for license_id, text in TEXTS]
    docs = [(k, f"var a=1;\n/* {text} */\nvar b=2;") for k, (_, text) in enumerate(whole)]
    docs.append((1000, "x\nReleased under the MIT License." + " " * 5000 + "\ny"))
    found = by_id(license_scan.scan(frame(spark, docs)))
    assert found == {k: (None, license_id, 1) for k, (license_id, _) in enumerate(whole)} | {1000: (None, "MIT", 1)}


def test_odd_rows(spark):
    assert license_scan.scan(frame(spark)).count() == len(texts())
    assert license_scan.scan(frame(spark, [])).collect() == []


def test_own_licenses(spark):
    digest = license_scan.scan(frame(spark, [(1, "House rules: be kind")])).first().digest
    own = spark.createDataFrame([(digest, "house", 1)], "digest string, license_id string, doc_id int")
    assert by_id(license_scan.scan(frame(spark, [(7, "house RULES be kind.")]), licenses=own)) == {7: ("house", "", 0)}


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.01"
    got = QUERIES["op3_license_scans"](spark, d)
    assert differences(got, duck(d), SQL["op3_license_scans"]) == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.where("n_notices > 0").count() > 0
