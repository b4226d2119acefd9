"""Readers and writers: raw JSON, lake tables, exports, source picking, test-table adapters."""
