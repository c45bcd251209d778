"""Flows made of several operators, registries, and the fixed view of the test tables."""
