"""Readers and writers: ledgers, published tables, claim pages, overrides, staged tables."""
