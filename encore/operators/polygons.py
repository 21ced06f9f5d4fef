"""Points in polygons, and a smooth heat surface over points.

A polygon is its rings (outer ones and holes alike; a point is inside if a ray from it crosses an odd number of their edges). Polygons are
covered by grid cells: a cell that no edge comes near lies wholly inside or outside and is decided once, by its
middle; a cell near edges keeps those rings for an exact test of each of its points. Points meet polygons by an equi-join on the cell, so
neither side is paired with all of the other. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGES = "array<struct<y1:double,x1:double,y2:double,x2:double>>"


def polygon_edges(rings: DataFrame, key: str = "polygon_id", points: str = "points") -> DataFrame:
    """(polygon_id, edges) from one row a ring, whose ``points`` (array of structs y, x) are in order; a ring is closed if its last
    point is not its first."""
    p = F.col(points)
    closed = F.when(F.element_at(p, 1) == F.element_at(p, -1), p).otherwise(F.concat(p, F.array(F.element_at(p, 1))))
    pairs = F.zip_with(F.slice(closed, 1, F.size(closed) - 1), F.slice(closed, 2, F.size(closed) - 1), lambda a, b: F.struct(
        a["y"].cast("double").alias("y1"), a["x"].cast("double").alias("x1"), b["y"].cast("double").alias("y2"), b["x"].cast("double").alias("x2")))
    return (rings.where(F.size(p) >= 3).groupBy(F.col(key).alias("polygon_id"))
            .agg(F.flatten(F.collect_list(pairs)).cast(EDGES).alias("edges")))  # a polygon's own rings


def inside(edges: Column, y: Column, x: Column) -> Column:
    """Whether (y, x) lies inside: an odd number of edges span ``y`` and cross it beyond ``x``. Lower and left edges belong to
    the polygon, upper and right ones do not, so polygons that share an edge share no point."""
    crossed = F.filter(edges, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))
    return F.size(crossed) % 2 == 1


def covering_cells(polygons: DataFrame, grid: float) -> DataFrame:
    """(polygon_id, cell_y, cell_x, edges) for the cells that a polygon may hold points of; ``edges`` is null where the whole cell lies inside."""
    low = lambda a, b: F.array_min(F.concat(F.transform("edges", lambda e: e[a]), F.transform("edges", lambda e: e[b])))
    high = lambda a, b: F.array_max(F.concat(F.transform("edges", lambda e: e[a]), F.transform("edges", lambda e: e[b])))
    cell = lambda c: F.floor(c / grid)
    boxed = polygons.select("polygon_id", "edges", cell(low("y1", "y2")).alias("y0"), cell(high("y1", "y2")).alias("y9"),
                            cell(low("x1", "x2")).alias("x0"), cell(high("x1", "x2")).alias("x9"))
    rows = boxed.withColumn("cell_y", F.explode(F.sequence("y0", "y9"))).withColumn("cell_x", F.explode(F.sequence("x0", "x9")))
    y, x = F.col("cell_y") * grid, F.col("cell_x") * grid
    near = F.exists("edges", lambda e: (F.greatest(e["y1"], e["y2"]) >= y) & (F.least(e["y1"], e["y2"]) <= y + grid)
                    & (F.greatest(e["x1"], e["x2"]) >= x) & (F.least(e["x1"], e["x2"]) <= x + grid))
    rows = rows.select("polygon_id", "cell_y", "cell_x", "edges", near.alias("near"), inside(F.col("edges"), y + grid / 2, x + grid / 2).alias("middle"))
    return rows.where("near or middle").select("polygon_id", "cell_y", "cell_x", F.when(F.col("near"), F.col("edges")).alias("edges"))


def polygon_tags(points: DataFrame, rings: DataFrame, grid: float = 0.25, lat: str = "Lat", long: str = "Long", tag: str = "polygon_id") -> DataFrame:
    """``points`` with ``tag``: the smallest id of the polygons that hold the point, null outside all and without coordinates.

    The join's polygon side is the cells of the polygons; Spark broadcasts it if its size is below the threshold, and joins by shuffle
    (splitting hot cells) otherwise. Points are told apart by their coordinates, each pair of which is tested once.
    """
    cells = covering_cells(polygon_edges(rings), grid)
    where = points.select(F.col(lat).cast("double").alias("y"), F.col(long).cast("double").alias("x")).where("y is not null and x is not null").distinct()
    at = where.withColumn("cell_y", F.floor(F.col("y") / grid)).withColumn("cell_x", F.floor(F.col("x") / grid))
    hit = at.join(cells, ["cell_y", "cell_x"]).where(F.col("edges").isNull() | inside(F.col("edges"), F.col("y"), F.col("x")))
    found = hit.groupBy("y", "x").agg(F.min("polygon_id").alias(tag))
    out = points.join(found, (F.col(lat).cast("double") == F.col("y")) & (F.col(long).cast("double") == F.col("x")), "left")
    return out.select(*[points[c] for c in points.columns], tag)


def layer_join(points: DataFrame, layer: DataFrame, key: str = "account_id", prefix: str = "layer_") -> DataFrame:
    """``points`` with the columns of the row of ``layer`` of the same key, prefixed; null where the layer has none."""
    named = layer.select(F.col(key).alias("__key"), *[F.col(f"`{c}`").alias(prefix + c) for c in layer.columns if c != key])
    return points.join(named, points[key] == F.col("__key"), "left").drop("__key")


def heat_surface(points: DataFrame, grid: float = 0.25, radius: float = 1.0, lat: str = "Lat", long: str = "Long") -> DataFrame:
    """(cell_y, cell_x, heat): density by a quartic kernel of ``radius`` degrees over the points' cells.

    Points are counted by cell first; each count is then scattered to the cells within the radius, a number that grid and
    radius alone fix, and summed there.
    """
    counts = (points.where(F.col(lat).isNotNull() & F.col(long).isNotNull())
              .groupBy(F.floor(F.col(lat) / grid).alias("y"), F.floor(F.col(long) / grid).alias("x")).agg(F.count(F.lit(1)).alias("n")))
    reach = int(radius / grid)
    near = [(dy, dx, (1 - (dy * dy + dx * dx) * grid * grid / (radius * radius)) ** 2) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1)
            if (dy * dy + dx * dx) * grid * grid < radius * radius]
    spread = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(w).alias("w")) for dy, dx, w in near]))
    return (counts.select("y", "x", "n", spread.alias("k")).groupBy((F.col("y") + F.col("k.dy")).alias("cell_y"), (F.col("x") + F.col("k.dx")).alias("cell_x"))
            .agg(F.sum(F.col("n") * F.col("k.w")).alias("heat")))


def heat_tags(points: DataFrame, share: float = 0.5, grid: float = 0.25, radius: float = 1.0, lat: str = "Lat", long: str = "Long",
              tag: str = "hotspot") -> DataFrame:
    """``points`` with ``tag`` 'Yes' where the heat of their cell is at least ``share`` of the surface's maximum, else null: the same at any number of rows."""
    heat = heat_surface(points, grid, radius, lat, long)
    hot = heat.where(F.col("heat") >= share * heat.agg(F.max("heat")).scalar())
    hot = hot.select(F.col("cell_y").alias("__y"), F.col("cell_x").alias("__x"), F.lit("Yes").alias(tag))
    out = points.join(hot, (F.floor(F.col(lat) / grid) == F.col("__y")) & (F.floor(F.col(long) / grid) == F.col("__x")), "left")
    return out.select(*[points[c] for c in points.columns], tag)
