"""All queries of the engine's own operators."""

from lattica.plans import catalog, catalog_io, catalog_more  # noqa: F401 - they register their queries
from lattica.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
