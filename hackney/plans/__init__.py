"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from hackney.plans import arrivals, history, ingest, quality, stored, streams, tables, watched, windows  # noqa: F401
from hackney.plans.registry import PLANS

__all__ = ["PLANS"]
