"""Distance and point-in-ring tests on plain coordinates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from velomet.fixed_values import EARTH_RADIUS_METERS


def great_circle_meters(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Haversine distance on a sphere; NULL when any coordinate is NULL."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Rounding can push the chord of antipodes a hair above 1, which asin would reject.
    bounded = F.when(chord.isNotNull(), F.least(F.lit(1.0), chord))
    return F.lit(2 * EARTH_RADIUS_METERS) * F.asin(F.sqrt(bounded))


def ring_edges(ring: Column) -> Column:
    """A closed ring of ``struct<lon,lat>`` as its edges ``struct<x1,y1,x2,y2>``."""
    return F.transform(
        F.sequence(F.lit(1), F.size(ring)),
        lambda i: F.struct(
            F.element_at(ring, i)["lon"].alias("x1"),
            F.element_at(ring, i)["lat"].alias("y1"),
            F.element_at(ring, i % F.size(ring) + 1)["lon"].alias("x2"),
            F.element_at(ring, i % F.size(ring) + 1)["lat"].alias("y2"),
        ),
    )


def inside_ring(lon: Column, lat: Column, edges: Column) -> Column:
    """Ray casting: inside when a ray to the east crosses an odd number of edges.

    An edge spans ``(y1 > lat) <> (y2 > lat)``: a point on a lower or left border is inside and
    one on an upper or right border outside, so areas that share a border never both claim it.
    """

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > lat) != (e["y2"] > lat)
        at = (e["x2"] - e["x1"]) * F.try_divide(lat - e["y1"], e["y2"] - e["y1"]) + e["x1"]
        return F.when(spans & (lon < at), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda n, e: n + crosses(e)) % 2 == 1
