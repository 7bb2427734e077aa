"""Layered, rule-checked data flows on plain open-source Spark."""

__version__ = "0.1.0"
