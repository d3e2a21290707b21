"""Point-in-polygon join without geography types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from velomet.functions.geo import inside_ring, ring_edges

CELL_DEGREES = 0.05
#: Cells per side that an area's box may span before a coarser grid is taken for it.
SPAN = 8


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    point_id: str,
    carry: Sequence[str],
    ring: str = "ring",
    lon: str = "longitude",
    lat: str = "latitude",
    cell: float = CELL_DEGREES,
) -> DataFrame:
    """``point_id`` and the carried columns for every polygon that contains the point.

    ``ring`` is one closed ring or an array of rings: the parts of an area and the holes in them, in
    any order. A point is inside when a ray from it crosses the outlines an odd number of times.

    Areas are spread over the cells of a grid that their bounding box touches, and points are joined to
    them on the cell, so only neighbours are tested. Each area takes the grid, of sizes doubling from
    ``cell``, in which its box spans at most SPAN cells a side; a point looks into every grid in use.
    What is spread is the area's number and box; the outline joins once a point lies in the box. The
    join on cells is a plain one that the adaptive planner splits where a cell holds many points.
    """
    nested = polygons.schema[ring].dataType.elementType.typeName() == "array"
    rings = F.col(ring) if nested else F.array(F.col(ring))
    # Areas are numbered by what they are; equal ones share a box and each keep their outline.
    numbered = polygons.select(*carry, rings.alias("rings"), F.xxhash64(*carry, F.to_json(F.struct(rings))).alias("area"))
    corners = F.flatten(F.col("rings"))
    xs, ys = F.transform(corners, lambda p: p["lon"]), F.transform(corners, lambda p: p["lat"])
    boxes = numbered.select(
        "area",
        F.array_min(xs).alias("west"),
        F.array_max(xs).alias("east"),
        F.array_min(ys).alias("south"),
        F.array_max(ys).alias("north"),
    ).dropDuplicates(["area"])
    widest = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))
    level = F.greatest(F.lit(0), F.ceil(F.log2(widest / (cell * SPAN)))).cast("int")
    boxes = boxes.withColumn("grid", F.coalesce(level, F.lit(0)))

    def index(value):
        return F.floor(value / (F.lit(cell) * F.pow(F.lit(2.0), F.col("grid"))))

    # The grids in use: at most a few dozen numbers, since a globe has 360 degrees.
    grids = [r["grid"] for r in boxes.select("grid").distinct().collect()]
    areas = boxes.withColumn("cx", F.explode(F.sequence(index(F.col("west")), index(F.col("east"))))).withColumn(
        "cy", F.explode(F.sequence(index(F.col("south")), index(F.col("north"))))
    )
    spots = (
        points.select(point_id, F.col(lon).alias("px"), F.col(lat).alias("py"))
        .withColumn("grid", F.explode(F.array(*map(F.lit, grids)).cast("array<int>")))
        .select("*", index(F.col("px")).alias("cx"), index(F.col("py")).alias("cy"))
    )
    in_box = F.col("px").between(F.col("west"), F.col("east")) & F.col("py").between(F.col("south"), F.col("north"))
    near = spots.join(areas, ["grid", "cx", "cy"]).filter(in_box).select(point_id, "px", "py", "area")
    outlines = numbered.select(*carry, "area", F.flatten(F.transform("rings", ring_edges)).alias("edges"))
    return near.join(outlines, "area").filter(inside_ring(F.col("px"), F.col("py"), F.col("edges"))).select(point_id, *carry)
