"""All registered queries; importing a module registers what it holds."""

from feedloom.plans.catalog import (  # noqa: F401
    building,
    decoding,
    deliveries,
    listings,
    pages,
    published,
    recipes,
    rows,
    snapshots,
    spans,
    tails,
)
from feedloom.plans.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
