"""All registered queries."""

from __future__ import annotations

from . import queries_clean, queries_eval, queries_frame, queries_search  # noqa: F401
from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
