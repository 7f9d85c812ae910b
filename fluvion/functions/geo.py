"""Spherical geometry as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean radii in metres that the engine's queries refer to.
EARTH_RADIUS_M = 6_371_008.8
EARTH_RADIUS_ROUND_M = 6_371_000.0


def _num(c: Column | float) -> Column:
    return c if isinstance(c, Column) else F.lit(float(c))


def haversine_m(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres on a sphere of ``radius``."""
    p1, p2 = F.radians(_num(lat1)), F.radians(_num(lat2))
    dp, dl = p2 - p1, F.radians(_num(lon2) - _num(lon1))
    s, t = F.sin(dp / 2), F.sin(dl / 2)
    h = s * s + F.cos(p1) * F.cos(p2) * t * t
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def valid_position(lat: Column, lon: Column) -> Column:
    """Both parts there and in range; longitudes may use -180..180 or 0..360."""
    return F.coalesce(lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90, 90) & lon.between(-180, 360), F.lit(False))


def wrap_lon(lon: Column) -> Column:
    """Longitude in [-180, 180). Values already there stay exactly as they are."""
    return F.when((lon >= -180) & (lon < 180), lon).otherwise(F.when(lon >= 180, lon - 360.0).otherwise(lon + 360.0))


def symmetric_relative_error(a: Column, b: Column) -> Column:
    """|a-b| over the larger magnitude; 0 where both are 0, null where either is missing."""
    top = F.greatest(F.abs(a), F.abs(b))
    return F.when(top == 0, F.lit(0.0)).otherwise(F.abs(a - b) / top)


def segment_distance_m(lat, lon, lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Distance in metres from a point to a short segment, on the plane that touches the sphere at the point; longitudes of either convention."""
    k = F.cos(F.radians(_num(lat)))
    turn = lambda lo, to: (d := _num(to) - _num(lo)) - 360.0 * F.rint(d / 360.0)
    east, north = lambda d: F.radians(d) * k * radius, lambda la: F.radians(_num(la) - _num(lat)) * radius
    # the second end by its difference from the first, so that the segment stays short where the point is far from it
    x1, y1 = east(turn(lon, lon1)), north(lat1)
    x2, y2 = east(turn(lon, lon1) + turn(lon1, lon2)), north(lat2)
    dx, dy = x2 - x1, y2 - y1
    along = F.coalesce(-(x1 * dx + y1 * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), along))
    return F.sqrt(F.pow(x1 + t * dx, F.lit(2.0)) + F.pow(y1 + t * dy, F.lit(2.0)))


def polyline_distance_m(lat: Column, lon: Column, line: Column, radius: float = EARTH_RADIUS_M) -> Column:
    """Distance in metres from a point to a line, an array of struct<lat, lon>; to the point itself for a line of one, null for none."""
    n = F.size(line)
    parts = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: segment_distance_m(lat, lon, F.get(line, i - 1)["lat"], F.get(line, i - 1)["lon"], F.coalesce(F.get(line, i), F.get(line, i - 1))["lat"], F.coalesce(F.get(line, i), F.get(line, i - 1))["lon"], radius))
    return F.when(n > 0, F.array_min(parts))
