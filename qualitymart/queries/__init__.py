"""All registered queries; importing the modules registers them."""

from qualitymart.queries import builders, loads, marts, measures, pages, quality  # noqa: F401
from qualitymart.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
