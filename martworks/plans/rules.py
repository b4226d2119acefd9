"""Warehouse tests of the lake tables and of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martworks.operators.quality import (
    Rule,
    above_zero,
    at_least,
    between,
    compound_key,
    not_null,
    references,
    total_matches,
    unique,
)


def _named(prefix: str, *columns: str) -> list[Rule]:
    return [not_null(f"{prefix}_not_null_{column}", column) for column in columns]


def products_rules() -> list[Rule]:
    return [
        *_named("products", "product_id", "title", "price", "ds"),
        unique("products_unique_product_id", "product_id"),
        above_zero("products_price_nonneg", "price"),
        at_least("products_rating_count_nonneg", "rating_count", 0),
        between("products_rating_range", "rating_rate", 0, 5),
    ]


def users_rules() -> list[Rule]:
    return [*_named("users", "user_id", "email", "ds"), unique("users_unique_user_id", "user_id")]


def carts_rules(users: DataFrame, products: DataFrame) -> list[Rule]:
    return [
        *_named("carts", "cart_id", "user_id", "product_id", "quantity", "ds"),
        compound_key("carts_compound_pk", "cart_id", "product_id"),
        at_least("carts_quantity_positive", "quantity", 1),
        references("carts_user_id_in_users", "user_id", users, "user_id"),
        references("carts_product_id_in_products", "product_id", products, "product_id"),
    ]


def dim_product_rules() -> list[Rule]:
    return [
        *_named("dim_product", "product_id", "product_name", "category", "price"),
        unique("dim_product_unique_product_id", "product_id"),
    ]


def fact_sales_rules(dim: DataFrame) -> list[Rule]:
    return [
        *_named(
            "fact_sales", "transaction_id", "product_id", "quantity", "price", "total_sales", "transaction_date"
        ),
        unique("fact_sales_unique_transaction_id", "transaction_id"),
        references("fact_sales_product_id_in_dim_product", "product_id", dim, "product_id"),
        at_least("fact_sales_price_nonneg", "price", 0),
        above_zero("fact_sales_quantity_positive", "quantity"),
        total_matches("fact_sales_total_matches", "total_sales", "quantity", "price"),
    ]
