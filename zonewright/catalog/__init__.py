"""Named queries over the test tables, each with the SQL that gives the same rows."""

from zonewright.catalog import flows, joins, nested, rows, upserts, vectors
from zonewright.catalog.registry import REGISTRY

__all__ = ["REGISTRY", "flows", "joins", "nested", "rows", "upserts", "vectors"]
