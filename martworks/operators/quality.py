"""Data-quality rules: violating rows, a one-row-per-test report, quarantine and gate.

All row rules of a frame are evaluated in one pass. Key and reference rules merge equal keys before they shuffle, so a
key that holds much of the data costs one row per task. What they find can be stored (:func:`keyed_violations`), so that
the report and the quarantine of one frame shuffle its keys once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.functions.paths import quoted
from martworks.functions.scalars import parse_ds
from martworks.operators.project import packed, unpacked
from martworks.session import TABLE_CODEC

PASS, FAIL, SKIPPED = "pass", "fail", "skipped"


class QualityError(ValueError):
    """At least one rule of a batch failed."""


@dataclass(frozen=True)
class RowRule:
    """Fails for each row where ``violated`` is true; null counts as not violated."""

    name: str
    columns: tuple[str, ...]
    violated: Column


@dataclass(frozen=True)
class KeyRule:
    """Fails when a key repeats.

    ``nulls_equal``: nulls are a value like any other, else keys with a null are left out.
    ``count_rows``: count the rows beyond each first, else count the repeated keys.
    """

    name: str
    columns: tuple[str, ...]
    nulls_equal: bool = True
    count_rows: bool = False


@dataclass(frozen=True)
class ReferenceRule:
    """Fails for each row whose non-null key has no parent."""

    name: str
    columns: tuple[str, ...]
    parent: DataFrame
    parent_column: str


Rule = RowRule | KeyRule | ReferenceRule


# -- rule builders -----------------------------------------------------------------------------------------------------

def not_null(name: str, column: str) -> RowRule:
    return RowRule(name, (column,), quoted(column).isNull())


def above_zero(name: str, column: str) -> RowRule:
    return RowRule(name, (column,), quoted(column) <= 0)


def at_least(name: str, column: str, low: Any) -> RowRule:
    return RowRule(name, (column,), quoted(column) < low)


def between(name: str, column: str, low: Any, high: Any) -> RowRule:
    return RowRule(name, (column,), (quoted(column) < low) | (quoted(column) > high))


def total_matches(name: str, total: str, quantity: str, price: str, tolerance: float = 1e-9) -> RowRule:
    off = F.abs(quoted(total) - quoted(quantity) * quoted(price)) > tolerance
    return RowRule(name, (total, quantity, price), off)


def unique(name: str, *columns: str) -> KeyRule:
    """Warehouse test: repeated keys, nulls left out."""
    return KeyRule(name, columns, nulls_equal=False)


def compound_key(name: str, *columns: str) -> KeyRule:
    """Repeated composite keys, nulls equal."""
    return KeyRule(name, columns)


def no_duplicates(name: str, *columns: str) -> KeyRule:
    """Pre-load check: rows beyond the first of a key, nulls equal."""
    return KeyRule(name, columns, count_rows=True)


def references(name: str, column: str, parent: DataFrame, parent_column: str) -> ReferenceRule:
    return ReferenceRule(name, (column,), parent, parent_column)


def basic_checks(resource: str, config: Mapping[str, Any] | None = None) -> list[Rule]:
    """Checks before a load: the resource's own, then the config's ``validations``."""
    rules: list[Rule] = []
    if resource == "products":
        rules += [
            not_null("products_not_null_title", "title"),
            not_null("products_not_null_price", "price"),
            above_zero("products_gt_zero_price", "price"),
            no_duplicates("products_unique_product_id", "product_id"),
        ]
    elif resource == "carts":
        rules += [
            above_zero("carts_gt_zero_quantity", "quantity"),
            no_duplicates("carts_unique_cart_id_product_id", "cart_id", "product_id"),
        ]
    elif resource == "users":
        rules += [
            not_null("users_not_null_email", "email"),
            no_duplicates("users_unique_user_id", "user_id"),
        ]
    wanted = (config or {}).get("validations") or {}
    rules += [not_null(f"cfg_not_null_{column}", column) for column in wanted.get("not_null") or []]
    keys = wanted.get("unique") or []
    if keys and all(isinstance(key, str) for key in keys):
        rules.append(no_duplicates("cfg_unique", *keys))
    else:
        rules += [no_duplicates(f"cfg_unique_{i}", *key) for i, key in enumerate(keys, start=1)]
    return rules


# -- single checks -----------------------------------------------------------------------------------------------------

def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls) for each column that is present, in one pass."""
    present = [c for c in columns or df.columns if c in df.columns]
    totals = df.agg(*(F.count_if(quoted(c).isNull()).alias(c) for c in present))
    return totals.unpivot([], [quoted(c) for c in present], "column", "nulls")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat a key, nulls equal."""
    sizes = df.groupBy(*map(quoted, keys)).count()
    return sizes.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def applicable(df: DataFrame, rules: Iterable[Rule]) -> tuple[list[Rule], list[Rule]]:
    """Rules whose columns all exist, and the others, which are skipped."""
    usable, skipped = [], []
    for rule in rules:
        (usable if all(c in df.columns for c in rule.columns) else skipped).append(rule)
    return usable, skipped


def row_violations(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Violating rows with their ``test_name``, once per violated rule, from one pass over the frame."""
    broken = F.array(*(F.when(r.violated, F.lit(r.name)) for r in rules))
    hits = df.where(reduce(or_, (r.violated for r in rules)))
    named = hits.withColumn("test_name", F.explode(F.array_compact(broken)))
    return named.select("test_name", *map(quoted, df.columns))


def key_violations(df: DataFrame, rule: KeyRule) -> DataFrame:
    """Repeated keys and how often each occurs, ``n_records``."""
    keys = [quoted(c) for c in rule.columns]
    rows = df if rule.nulls_equal else df.where(reduce(and_, (k.isNotNull() for k in keys)))
    sizes = packed(rows.select(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
    return unpacked(sizes.where(F.col("n_records") > 1), rows.select(*keys).schema)


def reference_violations(df: DataFrame, rule: ReferenceRule) -> DataFrame:
    """Keys without a parent and how many rows hold each, ``n_records``."""
    key = rule.columns[0]
    held = df.where(quoted(key).isNotNull()).groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("n_records"))
    parents = rule.parent.select(quoted(rule.parent_column).alias(key))
    return held.join(parents, key, "left_anti")


def keyed_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame | None:
    """Violations of the key and reference rules alone, to be stored for ``found``; None if there are no such rules."""
    usable = [r for r in applicable(df, rules)[0] if not isinstance(r, RowRule)]
    return violations(df, usable) if usable else None


def _keyed(df: DataFrame, rule: KeyRule | ReferenceRule, found: DataFrame | None) -> DataFrame:
    """Violations of one key or reference rule, taken from ``found`` where they were stored."""
    if found is not None:
        return found.where(F.col("test_name") == rule.name).select(*map(quoted, rule.columns), "n_records")
    return key_violations(df, rule) if isinstance(rule, KeyRule) else reference_violations(df, rule)


def violations(df: DataFrame, rules: Sequence[Rule], found: DataFrame | None = None) -> DataFrame:
    """Violations of all rules in one typed frame: whole rows for row rules, key and ``n_records`` for the others."""
    usable, _ = applicable(df, rules)
    row_rules = [r for r in usable if isinstance(r, RowRule)]
    frames = [row_violations(df, row_rules)] if row_rules else []
    frames += [_keyed(df, r, found).withColumn("test_name", F.lit(r.name)) for r in usable if not isinstance(r, RowRule)]
    if not frames:
        return df.where(F.lit(False)).withColumn("test_name", F.lit(None).cast("string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# -- report, quarantine, gate ------------------------------------------------------------------------------------------

def failures(df: DataFrame, rules: Sequence[Rule], found: DataFrame | None = None) -> DataFrame:
    """(test_name, failures) per rule that applies."""
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    frames = []
    if row_rules:
        totals = df.agg(*(F.count_if(r.violated).alias(r.name) for r in row_rules))
        frames.append(totals.unpivot([], [quoted(r.name) for r in row_rules], "test_name", "failures"))
    for rule in rules:
        if isinstance(rule, KeyRule):
            size = F.sum(F.col("n_records") - 1) if rule.count_rows else F.count(F.lit(1))
        elif isinstance(rule, ReferenceRule):
            size = F.sum("n_records")
        else:
            continue
        frames.append(
            _keyed(df, rule, found).agg(size.alias("failures"))
            .select(F.lit(rule.name).alias("test_name"), F.coalesce("failures", F.lit(0)).alias("failures"))
        )
    return reduce(DataFrame.unionByName, frames)


def report(
    df: DataFrame, rules: Sequence[Rule], layer: str, resource: str, ds: str | dt.date, found: DataFrame | None = None
) -> DataFrame:
    """(test_name, layer, resource, ds, status, failures); rules that lack a column are reported as skipped."""
    usable, skipped = applicable(df, rules)
    frames = []
    if usable:
        status = F.when(F.col("failures") > 0, FAIL).otherwise(PASS)
        frames.append(failures(df, usable, found).select("test_name", status.alias("status"), "failures"))
    if skipped:
        frames.append(
            df.sparkSession.createDataFrame(
                [(rule.name, SKIPPED, None) for rule in skipped], "test_name string, status string, failures bigint"
            )
        )
    rows = reduce(DataFrame.unionByName, frames)
    return rows.select(
        "test_name",
        F.lit(layer).alias("layer"),
        F.lit(resource).alias("resource"),
        F.lit(parse_ds(ds)).alias("ds"),
        "status",
        "failures",
    )


def status_counts(reports: DataFrame) -> DataFrame:
    return reports.groupBy("status").agg(F.count(F.lit(1)).alias("tests"))


def write_report(reports: DataFrame, path: str, layer: str, resource: str, ds: str | dt.date) -> DataFrame:
    """Store the report of one layer, resource and day, replacing an earlier one; returns the stored rows."""
    target = f"{path}/layer={layer}/resource={resource}/ds={parse_ds(ds)}"
    reports.drop("layer", "resource", "ds").repartition(1).write.mode("overwrite").parquet(target)
    return reports.sparkSession.read.schema(reports.schema).option("basePath", path).parquet(target).select(
        *reports.columns
    )


def quarantine_rows(
    df: DataFrame, rules: Sequence[Rule], layer: str, resource: str, ds: str | dt.date, found: DataFrame | None = None
) -> DataFrame:
    """Violations stamped with where they came from. The batch's own ``ds`` column, if any, is kept as ``row_ds``."""
    rows = violations(df, rules, found).withColumnsRenamed({"ds": "row_ds"})
    return rows.withColumns({
        "layer": F.lit(layer),
        "resource": F.lit(resource),
        "ds": F.lit(parse_ds(ds)),
    })


def quarantine(
    df: DataFrame, rules: Sequence[Rule], path: str, layer: str, resource: str, ds: str | dt.date,
    found: DataFrame | None = None,
) -> int:
    """Write violations to ``<path>/<layer>/<resource>/ds=<ds>/test_name=…``; returns the number of tests written.

    Give the rules that failed: :func:`failed_rules` takes them from a report. What an earlier run of the day left is
    replaced, also when no rule fails any more.
    """
    target = f"{path}/{layer}/{resource}/ds={parse_ds(ds)}"
    rows = quarantine_rows(df, rules, layer, resource, ds, found).drop("layer", "resource", "ds")
    rows.write.mode("overwrite").option("compression", TABLE_CODEC).partitionBy("test_name").parquet(target)
    return len(rules)


def failed_rules(reports: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """The rules a report shows as failed; the report has one row per rule."""
    names = {row["test_name"] for row in reports.where(F.col("status") == FAIL).select("test_name").collect()}
    return [rule for rule in rules if rule.name in names]


def enforce(reports: DataFrame) -> None:
    """Raise when a test failed. The report has one row per rule, so reading it here is small."""
    failed = reports.where(F.col("status") == FAIL).orderBy("resource", "test_name").collect()
    if failed:
        listed = ", ".join(f"{row['resource']}.{row['test_name']}={row['failures']}" for row in failed)
        raise QualityError(f"quality gate: {listed}")

