"""Scans: raw lines, delimited files, tables, documents, nested records."""
