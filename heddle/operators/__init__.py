"""Operators over annotated tables, grouped by kind of work."""
