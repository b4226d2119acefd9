"""The three shop resources: raw record schemas, column configs, keys."""

from __future__ import annotations

from pyspark.sql import types as T

# Column configs of the resources. Output names, paths, types and defaults must match the shop's feeds.
PRODUCTS_CONFIG = {
    "select": {
        "product_id": {"path": "id", "type": "int"},
        "title": {"path": "title", "type": "string"},
        "description": {"path": "description", "type": "string"},
        "price": {"path": "price", "type": "float"},
        "category": {"path": "category", "type": "string", "default": "unknown"},
        "image_url": {"path": "image", "type": "string"},
        "rating_rate": {"path": "rating.rate", "type": "float", "default": 0.0},
        "rating_count": {"path": "rating.count", "type": "int", "default": 0},
    },
    "derive": {"title_len": {"op": "len", "args": ["title"]}},
    "fillna": {"description": ""},
    "validations": {"not_null": ["product_id", "title"], "unique": ["product_id"]},
    "order": [
        "product_id", "title", "description", "price", "category", "image_url", "rating_rate", "rating_count",
    ],
}

CARTS_CONFIG = {
    "cart_id": {"mapping": "id", "data_type": "INTEGER"},
    "user_id": {"mapping": "userId", "data_type": "INTEGER"},
    "order_date": {"mapping": "date", "data_type": "DATETIME"},
    "product_id": {"mapping": "products.productId", "data_type": "INTEGER"},
    "quantity": {"mapping": "products.quantity", "data_type": "INTEGER"},
    "ds": {"mapping": "ds", "data_type": "DATE"},
}

USERS_CONFIG = {
    "select": {
        "user_id": {"path": "id", "type": "int"},
        "username": {"path": "username", "type": "string"},
        "email": {"path": "email", "type": "string"},
        "phone": {"path": "phone", "type": "string"},
        "first_name": {"path": "name.firstname", "type": "string"},
        "last_name": {"path": "name.lastname", "type": "string"},
        "address_street": {"path": "address.street", "type": "string"},
        "address_number": {"path": "address.number", "type": "int"},
        "address_city": {"path": "address.city", "type": "string"},
        "address_zip": {"path": "address.zipcode", "type": "string"},
        "geo_lat": {"path": "address.geolocation.lat", "type": "float"},
        "geo_lng": {"path": "address.geolocation.long", "type": "float"},
    },
    "derive": {
        "full_name": {"op": "concat_ws", "args": [" ", "first_name", "last_name"]},
        "email_domain": {"op": "split_part", "args": ["email", "@", 2]},
    },
    "fillna": {"address_city": "", "address_zip": ""},
    "validations": {"not_null": ["user_id", "username", "email"], "unique": ["user_id"]},
    "order": [
        "user_id", "username", "email", "email_domain", "phone", "first_name", "last_name", "full_name",
        "address_street", "address_number", "address_city", "address_zip", "geo_lat", "geo_lng",
    ],
}

CONFIGS = {"products": PRODUCTS_CONFIG, "carts": CARTS_CONFIG, "users": USERS_CONFIG}

RESOURCES = ("products", "carts", "users")

# Upsert keys of the tables.
PRIMARY_KEYS = {"products": ["product_id"], "carts": ["cart_id", "product_id"], "users": ["user_id"]}


def _text_fields(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Raw leaves are read as text and typed by the column config, so a number sent as text is still read. Fields that no
# config selects, such as the password, are not in the schema and never leave the file.
RAW_SCHEMAS = {
    "products": T.StructType([
        *_text_fields("id", "title", "price", "description", "category", "image"),
        T.StructField("rating", T.StructType(_text_fields("rate", "count"))),
    ]),
    "carts": T.StructType([
        *_text_fields("id", "userId", "date"),
        # Text covers an array, a lone object and a list that was itself sent as text.
        *_text_fields("products"),
    ]),
    "users": T.StructType([
        *_text_fields("id", "email", "username", "phone"),
        T.StructField("name", T.StructType(_text_fields("firstname", "lastname"))),
        T.StructField("address", T.StructType([
            *_text_fields("city", "street", "number", "zipcode"),
            T.StructField("geolocation", T.StructType(_text_fields("lat", "long"))),
        ])),
    ]),
}
