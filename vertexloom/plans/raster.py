"""Queries of the label image operators."""

from __future__ import annotations

from vertexloom.operators import raster
from vertexloom.plans import fixtures as fx
from vertexloom.plans.fixtures import cte, recursive
from vertexloom.plans.registry import query
from vertexloom.plans.roi import rounded

EDGES = """, n AS (SELECT *, lag(label) OVER a AS l, lead(label) OVER a AS r, lag(label) OVER b AS u, lead(label) OVER b AS d FROM lab
  WINDOW a AS (PARTITION BY image_id, y ORDER BY x), b AS (PARTITION BY image_id, x ORDER BY y)),
e AS (SELECT image_id, label, 'upper' AS side, x + 1 AS x0, y AS y0, x AS x1, y AS y1 FROM n WHERE u IS DISTINCT FROM label
  UNION ALL SELECT image_id, label, 'left', x, y, x, y + 1 FROM n WHERE l IS DISTINCT FROM label
  UNION ALL SELECT image_id, label, 'lower', x, y + 1, x + 1, y + 1 FROM n WHERE d IS DISTINCT FROM label
  UNION ALL SELECT image_id, label, 'right', x + 1, y + 1, x + 1, y FROM n WHERE r IS DISTINCT FROM label)"""
CORNERS = """, q AS (SELECT image_id, y, x, label AS se, lag(label) OVER a AS sw FROM lab WINDOW a AS (PARTITION BY image_id, y ORDER BY x)),
q4 AS (SELECT *, lag(se) OVER b AS ne, lag(sw) OVER b AS nw FROM q WINDOW b AS (PARTITION BY image_id, x ORDER BY y)),
k AS (SELECT image_id, y, x, CASE WHEN least(se, sw, ne, nw) = greatest(se, sw, ne, nw) THEN 'mono'
  WHEN len(list_distinct([se, sw, ne, nw])) > 2 THEN 'three' WHEN nw = se AND ne = sw THEN 'cross' ELSE 'plain' END AS corner
  FROM q4 WHERE sw IS NOT NULL AND ne IS NOT NULL)"""
#: Each edge's successor; then walks from every edge that end where they meet a smaller one: what comes back to its start is a ring from its smallest edge on.
RINGS = """, en AS (SELECT *, y0::BIGINT * 17179869184 + x0 * 4 + CASE side WHEN 'upper' THEN 0 WHEN 'left' THEN 1 WHEN 'lower' THEN 2 ELSE 3 END AS e FROM e),
sc AS (SELECT a.image_id, a.label, a.e, a.x0, a.y0, b.e AS nx FROM en a JOIN en b ON b.image_id = a.image_id AND b.label = a.label AND b.x0 = a.x1 AND b.y0 = a.y1
  QUALIFY count(*) OVER (PARTITION BY a.image_id, a.label, a.e) = 1 OR (a.side || ' ' || b.side) IN ('lower right', 'upper left', 'left upper', 'right lower')),
walk AS (SELECT image_id, label, e AS s, nx, x0, y0, 0::BIGINT AS k FROM sc
  UNION ALL SELECT c.image_id, c.label, s, c.nx, c.x0, c.y0, k + 1 FROM walk w JOIN sc c ON c.image_id = w.image_id AND c.label = w.label AND c.e = w.nx WHERE w.nx > s),
rings AS (SELECT image_id, label, s AS ring_id, k AS vertex_ix, x0 AS x, y0 AS y FROM walk SEMI JOIN (SELECT image_id, label, s FROM walk WHERE nx = s) USING (image_id, label, s))"""


def _kept_sql(source: str, kept: str) -> str:
    """``st`` has the vertices of ``source`` with their neighbours, ``sim`` those that ``kept`` lets stay, numbered anew."""
    near = ", ".join(f"coalesce(lag({c}) OVER w, last_value({c}) OVER f) AS {c}b, coalesce(lead({c}) OVER w, first_value({c}) OVER f) AS {c}a" for c in "xy")
    return f""", st AS (SELECT *, {near} FROM {source} WINDOW w AS (PARTITION BY image_id, label, ring_id ORDER BY vertex_ix), f AS (PARTITION BY image_id, label, ring_id ORDER BY vertex_ix ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
sim AS (SELECT image_id, label, ring_id, row_number() OVER (PARTITION BY image_id, label, ring_id ORDER BY vertex_ix) - 1 AS vertex_ix, x, y FROM st {kept})"""


STRAIGHT = "(x - xb) * (ya - y) = (y - yb) * (xa - x)"


@query("l01_distinct_labels", cte("lab") + " SELECT DISTINCT image_id, label FROM lab")
def distinct_labels(spark, sf_dir):
    return raster.distinct_labels(fx.label_raster(spark, sf_dir))


@query("l02_label_mask", cte("lab") + " SELECT * FROM lab WHERE label BETWEEN 3 AND 4")
def label_mask(spark, sf_dir):
    return raster.label_mask(fx.label_raster(spark, sf_dir), 3, 4)


@query("l03_boundary_edges", cte("lab") + EDGES + " SELECT * FROM e")
def boundary_edges(spark, sf_dir):
    return raster.boundary_edges(fx.label_raster(spark, sf_dir))


@query("l04_corner_classes", cte("lab") + CORNERS + " SELECT *, corner NOT IN ('three', 'cross') AS movable FROM k")
def corner_classes(spark, sf_dir):
    return raster.corner_classes(fx.label_raster(spark, sf_dir))


@query("l05_trace_rings", recursive(cte("lab") + EDGES + RINGS + " SELECT * FROM rings"))
def trace_rings(spark, sf_dir):
    return raster.trace_rings(raster.boundary_edges(fx.label_raster(spark, sf_dir)))


@query("l05_trace_segments", recursive(cte("lab") + EDGES + RINGS + _kept_sql("rings", f"WHERE NOT ({STRAIGHT})") + " SELECT * FROM sim"))
def trace_segments(spark, sf_dir):
    """Rings by straight pieces: the vertices are the turns."""
    return raster.trace_rings(raster.boundary_segments(fx.label_raster(spark, sf_dir)))


@query("l06_simplify_rings", recursive(cte("lab") + EDGES + RINGS + _kept_sql("rings", f"WHERE NOT ({STRAIGHT})") + " SELECT * FROM sim"))
def simplify_rings(spark, sf_dir):
    rings = raster.trace_rings(raster.boundary_edges(fx.label_raster(spark, sf_dir)))
    return raster.simplify_rings(rings, "all")


@query(
    "l07_vectorize_labels",
    recursive(
        cte("lab")
        + EDGES
        + CORNERS
        + RINGS
        + ", mv AS (SELECT image_id, y, x FROM k WHERE corner NOT IN ('three', 'cross'))"
        + _kept_sql("rings", f"LEFT JOIN mv USING (image_id, y, x) WHERE NOT ({STRAIGHT} AND mv.image_id IS NOT NULL)")
        + """, vt AS (SELECT image_id, dense_rank() OVER (PARTITION BY image_id ORDER BY label) - 1 AS roi_ix, dense_rank() OVER (PARTITION BY image_id, label ORDER BY ring_id) - 1 AS poly_ix, label, ring_id, vertex_ix, x::DOUBLE AS x, y::DOUBLE AS y FROM sim),
nb AS (SELECT *, coalesce(lag(x) OVER w, last_value(x) OVER f) AS xb, coalesce(lag(y) OVER w, last_value(y) OVER f) AS yb, coalesce(lead(x) OVER w, first_value(x) OVER f) AS xa, coalesce(lead(y) OVER w, first_value(y) OVER f) AS ya
  FROM vt WINDOW w AS (PARTITION BY image_id, roi_ix, poly_ix ORDER BY vertex_ix), f AS (PARTITION BY image_id, roi_ix, poly_ix ORDER BY vertex_ix ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
ln AS (SELECT *, nullif(sqrt((xa - xb) ** 2 + (ya - yb) ** 2), 0) AS len FROM nb),
of AS (SELECT *, (xa - xb) / len AS dx, (ya - yb) / len AS dy, (x - xb) * (ya - yb) / len - (y - yb) * (xa - xb) / len AS off FROM ln)
SELECT o.image_id AS set_id, roi_ix, poly_ix, vertex_ix, round(CASE WHEN m.image_id IS NULL OR len IS NULL THEN o.x ELSE o.x - 0.5 * off * dy END, 6) + 0.0 AS x, round(CASE WHEN m.image_id IS NULL OR len IS NULL THEN o.y ELSE o.y + 0.5 * off * dx END, 6) + 0.0 AS y,
  trunc(label)::INT::VARCHAR AS name
FROM of o LEFT JOIN mv m ON m.image_id = o.image_id AND m.x = o.x AND m.y = o.y"""
    ),
)
def vectorize_labels(spark, sf_dir):
    return rounded(raster.vectorize_labels(fx.label_raster(spark, sf_dir)).drop("label"), "x", "y")


@query(
    "l08_label_stats",
    cte("lab")
    + EDGES
    + """, p AS (SELECT image_id, label, count(*) AS perimeter FROM e GROUP BY ALL)
SELECT image_id, label, count(*) AS area, min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y, round(avg(x), 6) AS centre_x, round(avg(y), 6) AS centre_y, any_value(perimeter) AS perimeter
FROM lab JOIN p USING (image_id, label) GROUP BY image_id, label""",
)
def label_stats(spark, sf_dir):
    return rounded(raster.label_stats(fx.label_raster(spark, sf_dir)), "centre_x", "centre_y")
