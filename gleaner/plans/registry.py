"""All queries of the library and their SQL twins."""

from __future__ import annotations

from . import changes, model, postings, streams, text_rules, views, warehouse  # noqa: F401  (they register themselves)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
