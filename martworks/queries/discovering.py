"""Raw records whose fields are found in the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.queries.registry import query
from martworks.session import scratch_dir
from martworks.sources import adapters, discover


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Users as JSON lines, whose phone is a text, a number or an object by nation, and whose city may be missing."""
    nation = F.col("c_nationkey").cast("bigint")
    user = [
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.struct(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("city"),
                 F.struct(nation.alias("zone"), (F.col("c_custkey") > 10).alias("known")).alias("geo")).alias("address"),
    ]
    lines = F.array(F.struct(nation.alias("no")), F.struct((nation + 1).alias("no")))
    phone = F.struct(nation.alias("code"), lines.alias("lines"))
    text = F.when(nation < 8, F.to_json(F.struct(*user, F.concat(F.lit("1-"), nation.cast("string")).alias("phone")))).when(
        nation < 16, F.to_json(F.struct(*user, nation.alias("phone"), F.lit(True).alias("vip")))
    ).otherwise(F.to_json(F.struct(*user, phone.alias("phone"))))
    path = scratch_dir(spark, "undeclared")
    adapters.table(spark, sf_dir, "customer").select(text.alias("value")).write.text(path)
    return path


def _rows(*found: tuple[str, str, str]) -> str:
    return " union all ".join(
        f"select '{path}' as path, '{kind}' as kind, {count} as count from customer" for path, kind, count in found)


@query("discovered_fields", "select * from (" + _rows(
    ("$", "object", "count(*)"), ("$.id", "integer", "count(*)"), ("$.name", "text", "count(*)"),
    ("$.address", "object", "count(*)"), ("$.address.city", "text", "count(*) filter (c_acctbal > 0)"),
    ("$.address.geo", "object", "count(*)"), ("$.address.geo.zone", "integer", "count(*)"),
    ("$.address.geo.known", "boolean", "count(*)"), ("$.phone", "text", "count(*) filter (c_nationkey < 8)"),
    ("$.phone", "integer", "count(*) filter (c_nationkey between 8 and 15)"),
    ("$.vip", "boolean", "count(*) filter (c_nationkey between 8 and 15)"),
    ("$.phone", "object", "count(*) filter (c_nationkey >= 16)"),
    ("$.phone.code", "integer", "count(*) filter (c_nationkey >= 16)"),
    ("$.phone.lines", "list", "count(*) filter (c_nationkey >= 16)"),
    ("$.phone.lines[]", "object", "count(*) filter (c_nationkey >= 16) * 2"),
    ("$.phone.lines[].no", "integer", "count(*) filter (c_nationkey >= 16) * 2"),
) + ") where count > 0")
def discovered_fields(spark, sf_dir):
    """Every path of the batch with its kinds, clashing ones too."""
    return discover.fields(discover.read_variants(spark, _landed(spark, sf_dir)))


@query("discovered_users", """
select c_custkey as id, c_name as name, case when c_acctbal > 0 then c_mktsegment end as address_city,
       c_nationkey::bigint as address_geo_zone, c_custkey > 10 as address_geo_known,
       case when c_nationkey < 8 then '1-' || c_nationkey when c_nationkey < 16 then c_nationkey::varchar end as phone,
       case when c_nationkey >= 16 then c_nationkey::bigint end as phone_code,
       case when c_nationkey >= 16 then '[{"no":' || c_nationkey || '},{"no":' || (c_nationkey + 1) || '}]' end as phone_lines,
       case when c_nationkey between 8 and 15 then true end as vip
from customer""")
def discovered_users(spark, sf_dir) -> DataFrame:
    """The same records as columns that nobody declared."""
    return discover.read_discovered(spark, _landed(spark, sf_dir))
