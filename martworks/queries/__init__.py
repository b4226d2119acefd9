"""Registered queries over the given tables, each with the equivalent SQL where SQL can say it."""

from martworks.queries import discovering, exporting, indexing, loading, quality, robust, sales, shaping  # noqa: F401
from martworks.queries.registry import QUERIES, SQL  # noqa: F401
