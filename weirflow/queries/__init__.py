"""The registered queries, each with the SQL that must give the same rows."""

from . import controls, expectations, files, json_events, market, rules, streams  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
