"""Composed loads: files or tables to stage, target and archives."""
