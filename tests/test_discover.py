import pytest

from martworks.sources import discover


def records(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("try_parse_json(t) as record")


def test_kinds_clashes_nulls_and_odd_names(spark, rows):
    found = rows(discover.fields(records(
        spark, '{"a": 1, "b": null, "c": [1, "x", [true]]}', '{"a": 1.5, "a b": {"c\\"d": 2}}', '{"a": {"z": []}}', "7", "nope", None)))
    assert found == sorted([
        ("$", "object", 3), ("$", "integer", 1), ("$.a", "integer", 1), ("$.a", "fraction", 1), ("$.a", "object", 1),
        ("$.a.z", "list", 1), ("$.b", "null", 1), ("$.c", "list", 1), ("$.c[]", "integer", 1), ("$.c[]", "text", 1),
        ("$.c[]", "list", 1), ("$.c[][]", "boolean", 1), ('$["a b"]', "object", 1), ("$[\"a b\"]['c\"d']", "integer", 1),
    ], key=repr)


def test_deep_records_are_followed_to_their_end(spark, rows):
    text = '{"a":' * 9 + "1" + "}" * 9
    found = rows(discover.fields(records(spark, text), levels=2))
    assert ("$" + ".a" * 9, "integer", 1) in found and len(found) == 10


def test_wide_numbers_and_empty_input(spark, rows):
    big = 2**70
    frame = records(spark, f'{{"n": {big}}}', '{"n": 2}')
    types = discover.column_types(discover.fields(frame))
    assert types == {"$.n": "decimal(38,0)"}
    assert sorted(int(r.n) for r in discover.typed(frame, types).collect()) == [2, big]
    assert rows(discover.fields(frame.where("false"))) == []


def test_types(spark):
    assert discover.type_of({"object", "null"}) is None
    assert discover.type_of({"integer", "fraction"}) == "double"
    assert discover.type_of({"null"}) == "string"
    assert discover.type_of({"integer", "text"}) == "string"


def test_too_many_or_equal_columns_raise(spark):
    frame = records(spark, '{"a": {"b": 1}, "a_b": 2}')
    types = discover.column_types(discover.fields(frame))
    with pytest.raises(ValueError, match="a_b"):
        discover.typed(frame, types)
    with pytest.raises(ValueError, match="more than 1"):
        discover.column_types(discover.fields(frame), most=1)


def test_envelopes_lists_and_unreadable_lines(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"meta": {"n": 2}, "data": [{"id": 1, "tags": ["x"]}, {"id": 2}]}\n\n[{"id": 3}]\n{"id": "4"}\nno json\n')
    assert rows(discover.read_discovered(spark, str(tmp_path / "in")), "id", "tags") == sorted(
        [("1", '["x"]'), ("2", None), ("3", None), ("4", None)], key=repr)


def test_one_scan_without_python(spark):
    plan = discover._nodes(records(spark, "1"), "record", 3).groupBy("path", "kind").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Python" not in text
