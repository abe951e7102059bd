"""Registered queries over the given tables."""

from . import checks, ingest, lookup, plans, profile, series, vectors  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
