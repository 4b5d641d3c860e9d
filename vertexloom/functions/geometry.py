"""Keys, windows and column expressions for vertex tables and pixel tables.

A vertex table has ``set_id, roi_ix, poly_ix, vertex_ix, x, y``; polygons
are closed implicitly. Nothing keeps the order of rows but these indexes.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

POLYGON = ["set_id", "roi_ix", "poly_ix"]
VERTEX = [*POLYGON, "vertex_ix"]


def ring(keys: list[str] | None = None, order: str = "vertex_ix") -> WindowSpec:
    """Vertices of a polygon in their order."""
    return Window.partitionBy(*(keys or POLYGON)).orderBy(order)


def whole(keys: list[str] | None = None, order: str = "vertex_ix") -> WindowSpec:
    return ring(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def after(column: str, keys: list[str] | None = None, order: str = "vertex_ix") -> Column:
    """The next vertex's value; after the last comes the first."""
    return F.coalesce(F.lead(column).over(ring(keys, order)), F.first(column).over(whole(keys, order)))


def before(column: str, keys: list[str] | None = None, order: str = "vertex_ix") -> Column:
    """The previous vertex's value; before the first comes the last."""
    return F.coalesce(F.lag(column).over(ring(keys, order)), F.last(column).over(whole(keys, order)))


def distance(x0: str, y0: str, x1: str, y1: str) -> Column:
    return F.sqrt((F.col(x1) - F.col(x0)) ** 2 + (F.col(y1) - F.col(y0)) ** 2)
