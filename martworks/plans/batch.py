"""One batch day from landed JSON to marts: transform, check, load, build, test, export.

Each step reads what the step before it stored, so a lost executor or a failed step repeats only its own work, and a
day can be run again: staging, tables, quarantine and reports replace that day and no other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from contextlib import nullcontext
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.functions.scalars import batch_day
from martworks.operators.project import apply_config, stamp_ds
from martworks.operators.quality import (
    ReferenceRule, Rule, basic_checks, enforce, failed_rules, keyed_violations, quarantine, report, write_report,
)
from martworks.operators.reshape import explode_items
from martworks.plans import marts, rules
from martworks.plans.resources import CONFIGS, PRIMARY_KEYS, RAW_SCHEMAS, RESOURCES
from martworks.sources import exports, publish, raw, tables

REPORT_SCHEMA = "test_name string, layer string, resource string, ds date, status string, failures bigint"
LOAD_MODES = ("replace_partition", "truncate_insert", "upsert", "publish")


@dataclass(frozen=True)
class Lake:
    """Where a lake lives: a folder all executors share, and the databases of its two table layers."""

    spark: SparkSession
    root: str
    l1: str = "l1"
    l2: str = "l2"

    def create(self) -> Lake:
        """Databases below the root. Tables that an earlier process left there are opened again."""
        for name in (self.l1, self.l2):
            tables.ensure_database(self.spark, name, f"{self.root}/{name}")
        for resource in RESOURCES:
            tables.reopen_table(self.spark, f"{self.l1}.{resource}")
            publish.recover(self.spark, f"{self.l1}.{resource}")
        tables.reopen_table(self.spark, f"{self.l2}.dim_product", None)
        tables.reopen_table(self.spark, f"{self.l2}.fact_sales", "load_ds")
        return self

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(f"{getattr(self, layer)}.{name}")


def to_columns(resource: str, records: DataFrame, ds: str | dt.date, config: Mapping[str, Any] | None = None) -> DataFrame:
    """Typed columns of raw records, stamped with the batch day; carts get one row per item."""
    config = CONFIGS[resource] if config is None else config
    rows = explode_items(records) if resource == "carts" else records
    return stamp_ds(apply_config(rows, config), ds)


def transform(lake: Lake, resource: str, ds: str | dt.date | None = None) -> None:
    """Raw JSON of one day to staging, replacing the day.

    Values that do not have the type of the schema are null, and lines that are no JSON go to the quarantine of the raw
    layer. A day without records leaves an empty staging day.
    """
    day = batch_day(ds)
    records = raw.read_raw(lake.spark, lake.root, resource, day, RAW_SCHEMAS[resource], lenient=True)
    raw.write_staging_day(to_columns(resource, raw.readable(records), day), lake.root, resource, day)
    raw.malformed(records).write.mode("overwrite").text(f"{lake.root}/quarantine/raw/{resource}/ds={day}")


def check(lake: Lake, layer: str, resource: str, ds: dt.date, df: DataFrame, rule_list: list[Rule]) -> DataFrame:
    """Store the report of one frame and the violations of its failed rules; returns the stored report.

    What key and reference rules find is stored first, so both take it from there and the keys are shuffled once.
    """
    keyed = keyed_violations(df, rule_list)
    with nullcontext() if keyed is None else tables.staged(keyed, "keyed") as found:
        reports = report(df, rule_list, layer, resource, ds, found)
        stored = write_report(reports, f"{lake.root}/dq_report", layer, resource, ds)
        quarantine(df, failed_rules(stored, rule_list), f"{lake.root}/quarantine", layer, resource, ds, found)
    return stored


def load(lake: Lake, resource: str, ds: str | dt.date | None = None, mode: str = LOAD_MODES[0], gate: bool = True) -> DataFrame:
    """Staging of one day into its table, after the pre-load checks. A failed check stops the load.

    Mode ``publish`` replaces the day like ``replace_partition``, but tests it first: see :func:`load_gated`. A day without
    rows is not checked and changes nothing; its table is created if there is none yet.
    """
    if mode not in LOAD_MODES:
        raise ValueError(f"load mode must be one of {LOAD_MODES}")
    day = batch_day(ds)
    batch = raw.read_staging(lake.spark, lake.root, resource, day)
    table = f"{lake.l1}.{resource}"
    if batch.isEmpty():
        tables.sync_table(lake.spark, table, batch)
        return lake.spark.createDataFrame([], REPORT_SCHEMA)
    checked = check(lake, "staging", resource, day, batch, basic_checks(resource, CONFIGS[resource]))
    if gate:
        enforce(checked)
    if mode == "publish":
        return checked.unionByName(load_gated(lake, resource, day, batch, own_rules(lake, resource), gate))
    if mode == "upsert":
        tables.upsert(batch, table, PRIMARY_KEYS[resource])
    elif mode == "truncate_insert":
        tables.truncate_insert(batch, table)
    else:
        tables.replace_partition(batch, table)
    return checked


def own_rules(lake: Lake, resource: str) -> list[Rule]:
    """The warehouse tests of a table that need no other table of the same batch."""
    if resource == "carts":
        return [r for r in rules.carts_rules(*(lake.table("l1", "carts").limit(0),) * 2) if not isinstance(r, ReferenceRule)]
    return {"products": rules.products_rules, "users": rules.users_rules}[resource]()


def load_gated(lake: Lake, resource: str, ds: str | dt.date, batch: DataFrame, rule_list: list[Rule], gate: bool = True,
               scope: str = "batch") -> DataFrame:
    """Audit, then publish: the days of a batch replace those of the table only if their tests pass.

    The rows are tested where they are stored already but not visible, alone or (``scope="table"``) together with the other
    days. Report and quarantine are written either way, under the layer ``l1_candidate``. A failed test raises and leaves the
    table as it was; with ``gate=False`` the days are published all the same. An empty batch changes nothing.
    """
    table = f"{lake.l1}.{resource}"
    folders = publish.stage(batch, table)
    rows = (publish.staged_rows if scope == "batch" else publish.table_with)(lake.spark, table, folders)
    checked = check(lake, "l1_candidate", resource, batch_day(ds), rows, rule_list)
    if gate:
        enforce(checked)
    publish.publish(lake.spark, table, folders)
    return checked


def check_l1(lake: Lake, ds: str | dt.date | None = None, scope: str = "table") -> DataFrame:
    """Warehouse tests of the lake tables: over whole tables, or over the rows of one batch."""
    day = batch_day(ds)
    whole = {name: lake.table("l1", name) for name in RESOURCES}
    frames = whole if scope == "table" else {name: exports.export_rows(df, day) for name, df in whole.items()}
    lists = {
        "products": rules.products_rules(),
        "users": rules.users_rules(),
        "carts": rules.carts_rules(whole["users"], whole["products"]),
    }
    return _all(check(lake, "l1", name, day, frames[name], lists[name]) for name in RESOURCES)


def build(lake: Lake, batch_ds: str | dt.date | None = None, latest_product: bool = False) -> None:
    """Rebuild the marts from all rows, or from one batch. The fact is stored by batch day.

    Lines without a product meet none, so they stay out of the join and its shuffle.
    """
    products = marts.stg_products(lake.table("l1", "products"), batch_ds)
    carts = marts.stg_carts(lake.table("l1", "carts"), batch_ds)
    tables.materialize_table(marts.dim_product(products, latest_product), f"{lake.l2}.dim_product")
    sold, unsold = carts.where(F.col("product_id").isNotNull()), carts.where(F.col("product_id").isNull())
    fact = marts.fact_sales(sold, products, latest_product).unionByName(marts.fact_sales(unsold, products.limit(0), latest_product))
    tables.materialize_table(fact, f"{lake.l2}.fact_sales", "load_ds", many_days=batch_ds is None)


def check_l2(lake: Lake, ds: str | dt.date | None = None) -> DataFrame:
    """Warehouse tests of the marts."""
    day = batch_day(ds)
    dim, fact = lake.table("l2", "dim_product"), lake.table("l2", "fact_sales")
    return _all((
        check(lake, "l2", "dim_product", day, dim, rules.dim_product_rules()),
        check(lake, "l2", "fact_sales", day, fact, rules.fact_sales_rules(dim)),
    ))


def export(lake: Lake, ds: str | dt.date | None = None) -> str:
    """CSV folders of one batch day: the marts, and each lake table."""
    day = batch_day(ds)
    out = f"{lake.root}/exports/ds={day}"
    exports.write_csv(exports.export_fact(lake.table("l2", "fact_sales"), day), f"{out}/l2/fact_sales")
    exports.write_csv(exports.export_dim(lake.table("l2", "dim_product"), day), f"{out}/l2/dim_product")
    for name in RESOURCES:
        exports.write_csv(exports.export_rows(lake.table("l1", name), day), f"{out}/l1/{name}")
    return out


def run_day(
    lake: Lake,
    ds: str | dt.date | None = None,
    mode: str = LOAD_MODES[0],
    gate: bool = True,
    scope: str = "table",
    latest_product: bool = False,
    all_batches: bool = False,
) -> DataFrame:
    """All steps of one day; returns its report. The gate of the marts raises last, after reports and quarantine."""
    day = batch_day(ds)
    reports = []
    for resource in RESOURCES:
        transform(lake, resource, day)
        reports.append(load(lake, resource, day, mode, gate))
    reports.append(check_l1(lake, day, scope))
    if gate:
        enforce(reports[-1])
    build(lake, None if all_batches else day, latest_product)
    reports.append(check_l2(lake, day))
    export(lake, day)
    if gate:
        enforce(reports[-1])
    return _all(reports)


def _all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
