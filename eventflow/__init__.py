"""Keyed event analytics on Spark: one set of transformations, run over bounded tables or streams."""

__version__ = "0.1.0"
