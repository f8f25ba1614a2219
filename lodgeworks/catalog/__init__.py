"""Named queries with, where one can be written, the same query in plain SQL."""

from lodgeworks.catalog import cleaning, drift, features, learning, profiles, rules, sqlfunctions, storage, store, streams  # noqa: F401
from lodgeworks.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
