"""All registered queries; importing the modules registers them."""

from __future__ import annotations

from starledger.bindings import cleaning, pipelines, relations, reports, transfer, warehouse  # noqa: F401
from starledger.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
