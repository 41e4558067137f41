"""All registered queries of the engine and their SQL."""

from isallobar.plans import query_catalog, query_fields, query_lines, query_raster  # noqa: F401
from isallobar.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
