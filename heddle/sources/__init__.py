"""Readers, writers and the annotated-table bundle."""
