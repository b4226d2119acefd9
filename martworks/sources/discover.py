"""Records whose fields nobody declared: which paths a batch holds, of which kinds, and the batch as typed columns.

Records are variants, so a field may be a number in one record, a list in the next and an object in a third, and none of it
is lost. The fields of a batch are one aggregate over the nodes of all records: each level of nesting is an explode in the
same stage, and only one row for each path, kind and task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.functions.paths import quoted
from martworks.session import scratch_dir

# Kinds by the names that variants give their types.
INTEGER, WIDE, FRACTION, TEXT, BOOLEAN, NULL, OBJECT, LIST = (
    "integer", "wide integer", "fraction", "text", "boolean", "null", "object", "list")
# Levels that the first pass reaches; where there are more, further passes reach twice as many each.
LEVELS = 6
# Columns that a table of discovered fields may have at most; more raise, since such names are data rather than fields.
MOST_COLUMNS = 10_000


def read_variants(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Column ``record`` of JSON lines or, without ``lines``, of one document a file; null for what is no JSON.

    A document with a list ``data`` is an envelope of records, and a document that is a list holds records.
    """
    text = spark.read.option("wholetext", not lines).text(path)
    document = F.try_parse_json("value")
    held = F.coalesce(F.try_variant_get(document, "$.data", "array<variant>"),
                      F.try_variant_get(document, "$", "array<variant>"), F.array(document))
    return text.where(F.length(F.trim("value")) > 0).select(F.explode(held).alias("record"))


def _object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def kind_of(value: Column) -> Column:
    """Kind of a variant; null where there is none."""
    name = F.schema_of_variant(value)
    scalar = (F.when(name == "BIGINT", INTEGER).when(name.rlike(r"^DECIMAL\(\d+,0\)$"), WIDE)
              .when(name.rlike("^(DECIMAL|DOUBLE|FLOAT)"), FRACTION).when(name == "STRING", TEXT)
              .when(name == "BOOLEAN", BOOLEAN).when(name == "VOID", NULL).otherwise(F.lower(name)))
    return F.when(value.isNull(), F.lit(None).cast("string")).when(_object(value).isNotNull(), OBJECT).when(
        _list(value).isNotNull(), LIST).otherwise(scalar)


def _step(name: Column) -> Column:
    """A field's step of a path; names that are no plain words are quoted."""
    plain = name.rlike("^[A-Za-z_][A-Za-z0-9_]*$")
    mark = F.when(F.contains(name, F.lit('"')), F.lit("'")).otherwise(F.lit('"'))
    return F.when(plain, F.concat(F.lit("."), name)).otherwise(F.concat(F.lit("["), mark, name, mark, F.lit("]")))


def _nodes(records: DataFrame, column: str, levels: int) -> DataFrame:
    """``path, kind, value`` of the nodes of all records; the value is left to those that are not yet expanded."""
    record, none = quoted(column), F.lit(None).cast("variant")
    rows = records.select(F.lit("$").alias("path"), F.lit(0).alias("depth"), kind_of(record).alias("kind"),
                          record.alias("value")).where("kind is not null")

    def child(path: Column, depth: int, value: Column) -> Column:
        return F.struct(path.alias("path"), F.lit(depth).alias("depth"), kind_of(value).alias("kind"), value.alias("value"))

    for depth in range(1, levels + 1):
        path, value = F.col("path"), F.col("value")
        fields = F.transform(F.map_entries(_object(value)), lambda e: child(F.concat(path, _step(e["key"])), depth, e["value"]))  # noqa: B023
        items = F.transform(_list(value), lambda x: child(F.concat(path, F.lit("[]")), depth, x))  # noqa: B023
        done = F.array(F.struct("path", "depth", "kind", none.alias("value")))
        here = F.col("depth") == depth - 1
        node = F.when(here & (F.col("kind") == OBJECT), F.concat(done, fields)).when(
            here & (F.col("kind") == LIST), F.concat(done, items)).otherwise(F.array(F.struct("path", "depth", "kind", "value")))
        rows = rows.select(F.explode(node).alias("node")).select("node.*")
    return rows


def fields(records: DataFrame, column: str = "record", levels: int = LEVELS) -> DataFrame:
    """``path, kind, count``: how many nodes of each kind each path has, ``$`` being the records themselves.

    ``$.a.b`` is a field of a field and ``$.a[]`` an element of a list. A field that is null in a record is of kind ``null``
    there, a field that is missing is not counted; null records are none. Counted at once, in one pass over the records if
    they are nested ``levels`` deep at most, and kept in the shared scratch folder.
    """
    spark = records.sparkSession
    while True:
        nodes = _nodes(records, column, levels)
        deeper = (F.col("depth") == levels) & F.col("kind").isin(OBJECT, LIST)
        path = scratch_dir(spark, "fields")
        nodes.groupBy("path", "kind").agg(
            F.count("*").alias("count"), F.count_if(deeper).alias("deeper")).write.parquet(path)
        found = spark.read.schema("path string, kind string, count bigint, deeper bigint").parquet(path)
        if found.where("deeper > 0").isEmpty():
            return found.select("path", "kind", "count")
        levels *= 2


def type_of(kinds: set[str]) -> str | None:
    """Column type of a path by the kinds that it has; none for a path that only has fields of its own."""
    kinds = kinds - {NULL}
    if kinds == {OBJECT}:
        return None
    if kinds == {INTEGER}:
        return "bigint"
    if kinds and kinds <= {INTEGER, WIDE}:
        return "decimal(38,0)"
    if kinds and kinds <= {INTEGER, WIDE, FRACTION}:
        return "double"
    return "boolean" if kinds == {BOOLEAN} else "string"


def column_types(found: DataFrame, most: int = MOST_COLUMNS) -> dict[str, str]:
    """Column type of each path outside of lists, by path."""
    rows = found.where("path <> '$' and not contains(path, '[]')").groupBy("path").agg(
        F.collect_set("kind").alias("kinds")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} fields: their names are data, read them with fields()")
    types = {row.path: type_of(set(row.kinds)) for row in rows}
    return {path: dtype for path, dtype in sorted(types.items()) if dtype is not None}


def column_name(path: str) -> str:
    """``$.a.b`` is column ``a_b``, as flattening names it."""
    return path[1:].replace('["', ".").replace("['", ".").replace('"]', "").replace("']", "").lstrip(".").replace(".", "_")


def typed(records: DataFrame, types: dict[str, str], column: str = "record") -> DataFrame:
    """The records as flat columns: numbers and truth values where all values of a path are such, else text.

    Lists are JSON text. Where a path is an object in some records and a value in others, its column has the values and the
    object's fields have columns of their own. Two paths that give the same column name raise.
    """
    names = [column_name(path) for path in types]
    if twice := sorted({name for name in names if [n.lower() for n in names].count(name.lower()) > 1}):
        raise ValueError(f"several fields give the columns {twice}")
    record = quoted(column)

    def value(path: str, dtype: str) -> Column:
        got = F.try_variant_get(record, path, dtype)
        return got if dtype != "string" else F.when(
            F.try_variant_get(record, path, "map<string,variant>").isNull(), got)

    return records.select(*(value(path, dtype).alias(name) for name, (path, dtype) in zip(names, types.items(), strict=True)))


def read_discovered(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Records with all fields that the batch holds, typed by what it holds; two passes over the text."""
    records = read_variants(spark, path, lines).where("record is not null")
    return typed(records, column_types(fields(records)))
