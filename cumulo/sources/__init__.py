"""Readers for landed documents, stored tables and catalogs."""
