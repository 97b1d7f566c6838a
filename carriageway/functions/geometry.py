"""Points, lines and polygons as Column expressions over WKT text and doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carriageway.functions.rules import as_col, banded, rounded

# Earth radius in miles, metres per degree, reference point and
# city centres (latitude, longitude), distance bands in miles.
EARTH_MILES = 3958.8
METRES_PER_DEGREE = 111139
CHARLOTTE = (35.2271, -80.8431)
CITY_CENTRES = (CHARLOTTE, (35.7796, -78.6382), (36.0726, -79.7920))
AREA_BANDS = [(10, "Urban"), (30, "Suburban")]

POINTS = "array<struct<x:double,y:double>>"


def _half_chord(lat_a, lon_a, lat_b, lon_b) -> Column:
    north = F.sin(F.radians(lat_b - lat_a) / 2)
    east = F.sin(F.radians(lon_b - lon_a) / 2)
    return north * north + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * east * east


def miles_between(lat_a, lon_a, lat_b, lon_b, digits: int | None = 4) -> Column:
    """Great-circle distance in miles."""
    chord = _half_chord(*(c if isinstance(c, Column) else F.lit(c) for c in (lat_a, lon_a, lat_b, lon_b)))
    miles = F.lit(2 * EARTH_MILES) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))
    return miles if digits is None else rounded(miles, digits)


def planar_bearing(lat: Column | str, lon: Column | str, origin=CHARLOTTE) -> Column:
    """Angle from a reference point on the flat degree grid, 0 = north, in -180..180."""
    return F.degrees(F.atan2(as_col(lon) - F.lit(origin[1]), as_col(lat) - F.lit(origin[0])))


def compass_bearing(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Initial great-circle course, 0 to 360."""
    turn = F.radians(lon_b - lon_a)
    east = F.sin(turn) * F.cos(F.radians(lat_b))
    north = F.cos(F.radians(lat_a)) * F.sin(F.radians(lat_b)) - F.sin(F.radians(lat_a)) * F.cos(
        F.radians(lat_b)
    ) * F.cos(turn)
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def destination(lat: Column, lon: Column, course: Column, miles: Column) -> Column:
    """Struct (lat, lon) reached along a course."""
    arc, course, phi = miles / EARTH_MILES, F.radians(course), F.radians(lat)
    sin_end = F.sin(phi) * F.cos(arc) + F.cos(phi) * F.sin(arc) * F.cos(course)
    swing = F.atan2(F.sin(course) * F.sin(arc) * F.cos(phi), F.cos(arc) - F.sin(phi) * sin_end)
    return F.struct(
        F.degrees(F.asin(sin_end)).alias("lat"), F.degrees(F.radians(lon) + swing).alias("lon")
    )


def nearest_city_miles(lat: Column | str, lon: Column | str) -> Column:
    lat, lon = as_col(lat), as_col(lon)
    return F.least(*[miles_between(lat, lon, c_lat, c_lon) for c_lat, c_lon in CITY_CENTRES])


def area_type(nearest_miles: Column | str) -> Column:
    return banded(nearest_miles, "<=", AREA_BANDS, "Rural")


def planar_degrees(lat: Column | str, lon: Column | str, lat0: float, lon0: float) -> Column:
    """Straight-line distance on the degree grid."""
    return F.sqrt(F.pow(as_col(lon) - F.lit(lon0), F.lit(2)) + F.pow(as_col(lat) - F.lit(lat0), F.lit(2)))


def in_box(lat: Column | str, lon: Column | str, lat0: float, lon0: float, reach: float) -> Column:
    """Square around a point: a filter the file scan can use before exact distance."""
    return as_col(lat).between(lat0 - reach, lat0 + reach) & as_col(lon).between(lon0 - reach, lon0 + reach)


def point_wkt(lon: Column | str, lat: Column | str) -> Column:
    return F.concat(
        F.lit("POINT ("), as_col(lon).cast("string"), F.lit(" "), as_col(lat).cast("string"), F.lit(")")
    )


def _xy_text(x: Column, y: Column) -> Column:
    return F.concat(x.cast("string"), F.lit(" "), y.cast("string"))


def line_wkt(*points: tuple[Column, Column]) -> Column:
    """LINESTRING through (lon, lat) points in order."""
    return F.concat(
        F.lit("LINESTRING ("), F.concat_ws(", ", *[_xy_text(x, y) for x, y in points]), F.lit(")")
    )


def ring_points(lat: Column | str, lon: Column | str, radius: Column | str, corners: int) -> Column:
    """Corners of a regular polygon, first corner repeated at the end to close it."""
    lat, lon, radius = as_col(lat), as_col(lon), as_col(radius)
    step = 2 * 3.141592653589793 / corners

    def corner(i: Column) -> Column:
        turn = (i % corners).cast("double") * F.lit(step)
        return F.struct((lon + radius * F.cos(turn)).alias("x"), (lat + radius * F.sin(turn)).alias("y"))

    return F.transform(F.sequence(F.lit(0), F.lit(corners)), corner)


def polygon_wkt(points: Column) -> Column:
    return F.concat(
        F.lit("POLYGON (("),
        F.array_join(F.transform(points, lambda p: _xy_text(p["x"], p["y"])), ", "),
        F.lit("))"),
    )


def parse_wkt(wkt: Column | str) -> Column:
    """Coordinates of a POINT, LINESTRING or single-ring POLYGON; NULL for blank text."""
    body = F.regexp_extract(as_col(wkt), r"\(+([^()]+)\)+", 1)
    pairs = F.split(body, r"\s*,\s*")
    return F.when(
        body != "",
        F.transform(
            pairs,
            lambda pair: F.struct(
                F.split_part(F.trim(pair), F.lit(" "), F.lit(1)).cast("double").alias("x"),
                F.split_part(F.trim(pair), F.lit(" "), F.lit(-1)).cast("double").alias("y"),
            ),
        ),
    )


def line_degrees(points: Column) -> Column:
    """Planar length of a point list."""
    steps = F.zip_with(
        F.slice(points, 1, F.size(points) - 1),
        F.slice(points, 2, F.size(points) - 1),
        lambda a, b: F.sqrt(F.pow(b["x"] - a["x"], F.lit(2)) + F.pow(b["y"] - a["y"], F.lit(2))),
    )
    return F.aggregate(steps, F.lit(0.0), lambda total, step: total + step)


def line_metres(wkt: Column | str) -> Column:
    return rounded(line_degrees(parse_wkt(wkt)) * METRES_PER_DEGREE, 0)


def start_point(wkt: Column | str) -> Column:
    return F.element_at(parse_wkt(wkt), 1)


def contains(points: Column, x: Column | str, y: Column | str) -> Column:
    """Even-odd test of a point against a closed ring of corners."""
    x, y = as_col(x), as_col(y)

    def crosses(a: Column, b: Column) -> Column:
        straddles = (a["y"] > y) != (b["y"] > y)
        return straddles & (x < a["x"] + (b["x"] - a["x"]) * F.try_divide(y - a["y"], b["y"] - a["y"]))

    edges = F.zip_with(
        F.slice(points, 1, F.size(points) - 1), F.slice(points, 2, F.size(points) - 1), crosses
    )
    return F.size(F.filter(edges, lambda hit: hit)) % 2 == 1


def extent(points: Column) -> Column:
    """Struct xmin, ymin, xmax, ymax of a point list."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def geojson_geometry(wkt: Column | str) -> Column:
    """GeoJSON geometry text of a WKT point, line or polygon."""
    wkt = as_col(wkt)
    coords = F.transform(
        parse_wkt(wkt),
        lambda p: F.concat(F.lit("["), p["x"].cast("string"), F.lit(","), p["y"].cast("string"), F.lit("]")),
    )
    joined = F.array_join(coords, ",")

    def shape(kind: str, opening: str, closing: str) -> Column:
        return F.concat(F.lit(f'{{"type":"{kind}","coordinates":{opening}'), joined, F.lit(closing + "}"))

    return (
        F.when(F.startswith(wkt, F.lit("POINT")), shape("Point", "", ""))
        .when(F.startswith(wkt, F.lit("LINESTRING")), shape("LineString", "[", "]"))
        .when(F.startswith(wkt, F.lit("POLYGON")), shape("Polygon", "[[", "]]"))
    )
