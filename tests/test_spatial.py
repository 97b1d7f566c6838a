"""Cells, polygons and proximity joins against brute force in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carriageway.functions import cells, geometry
from carriageway.operators.spatial import cell_side, cells_of, first_level, inside_polygons, near_cells, same_cell_during


def crossing_test(ring, x, y):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
            inside = not inside
    return inside


RINGS = {
    "square": [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)],
    "arrow": [(0.5, 0.5), (2.0, 0.5), (1.2, 1.0), (2.0, 1.5), (0.5, 1.5), (0.5, 0.5)],
    "far": [(-3.0, -3.0), (-2.5, -3.0), (-2.5, -2.0), (-3.0, -3.0)],
}


@pytest.mark.parametrize("salts", [1, 8])
def test_polygon_join(spark, salts):
    rng = random.Random(1)
    points = [(n, rng.uniform(-3.5, 2.5), rng.uniform(-3.5, 2.5)) for n in range(400)]
    # A third of all points on one spot, and points on edges and corners.
    points += [(1000 + n, 0.75, 0.75) for n in range(200)] + [(2000, 0.0, 0.0), (2001, 1.0, 0.5), (2002, 0.5, 1.5)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    polygons = spark.createDataFrame(
        [(name, [{"x": x, "y": y} for x, y in ring]) for name, ring in RINGS.items()],
        "name string, corners array<struct<x:double,y:double>>")
    got = inside_polygons(df, polygons, "corners", "x", "y", salts, [F.col("id")])
    want = sorted((n, name) for n, x, y in points for name, ring in RINGS.items() if crossing_test(ring, x, y))
    assert sorted((r["id"], r["name"]) for r in got.collect()) == want


def star(n, x, y, outer, inner):
    ring = [(x + (outer if k % 2 else inner) * math.cos(math.pi * k / n), y + (outer if k % 2 else inner) * math.sin(math.pi * k / n)) for k in range(2 * n)]
    return [*ring, ring[0]]


def test_polygons_of_all_sizes(spark):
    """Country-wide, city-wide and tiny outlines, points on cell borders among them."""
    rings = {"wide": star(7, -80.0, 35.0, 12.0, 5.0), "city": star(5, -80.0, 35.0, 0.6, 0.2), "spot": star(4, -80.01, 35.01, 0.004, 0.002),
             "bow": [(-90.0, 30.0), (-84.0, 36.0), (-84.0, 30.0), (-90.0, 36.0), (-90.0, 30.0)]}
    rng = random.Random(2)
    points = [(n, rng.uniform(-94, -66), rng.uniform(22, 48)) for n in range(1500)]
    points += [(5000 + n, rng.gauss(-80, 0.3), rng.gauss(35, 0.3)) for n in range(400)] + [(8000 + n, rng.gauss(-80.01, 0.003), rng.gauss(35.01, 0.003)) for n in range(200)]
    points += [(9000 + 25 * a + b, -84.0 + a / 4, 32.0 + b / 4) for a in range(25) for b in range(25)] + [(99_999, None, 1.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    polygons = spark.createDataFrame([(n, [{"x": x, "y": y} for x, y in r]) for n, r in rings.items()] + [("none", None)],
                                     "name string, corners array<struct<x:double,y:double>>")
    got = inside_polygons(df, polygons, "corners", "x", "y", 4, [F.col("id")])
    want = sorted((n, name) for n, x, y in points if x is not None for name, ring in rings.items() if crossing_test(ring, x, y))
    assert sorted((r["id"], r["name"]) for r in got.collect()) == want
    assert inside_polygons(df, polygons.limit(0), "corners", "x", "y").count() == 0


def test_cover_grows_with_the_border(spark):
    """A tenfold outline has no more cells than its border needs, and most of its area is whole cells."""
    for size in (1.0, 10.0, 40.0):
        ring = np.array(star(12, 0.3, 0.2, size / 2, size / 2.2))
        level = spark.createDataFrame([([{"x": float(x), "y": float(y)} for x, y in ring],)], "c array<struct<x:double,y:double>>").select(
            first_level(geometry.extent(F.col("c")))).first()[0]
        cells_in = cells_of(ring, level)
        finest = cell_side(max(c[0] for c in cells_in))
        border = sum(not c[3] for c in cells_in)
        assert border <= 4 * 3.2 * size / finest + 50 and len(cells_in) < 1000
        whole = sum(cell_side(c[0]) ** 2 for c in cells_in if c[3])
        assert whole > 0.6 * math.pi * (size / 2.1) ** 2


def test_ring_is_symmetric_and_complete(spark):
    df = spark.createDataFrame([("8:3:-2",)], "c string")
    ring = df.select(cells.ring_cells("c", 2)).first()[0]
    assert len(ring) == len(set(ring)) == 19 and "8:3:-2" in ring
    for other in ring:
        back = spark.createDataFrame([(other,)], "c string").select(cells.ring_cells("c", 2)).first()[0]
        assert "8:3:-2" in back
        break


def test_point_is_inside_its_cell_boundary(spark):
    df = spark.range(500).select(
        (35.0 + F.rand(3)).alias("latitude"), (-81.0 + F.rand(4) * 2).alias("longitude"))
    for res in (6, 7, 8):
        inside = df.withColumn("ring", cells.cell_boundary(cells.hex_cell("latitude", "longitude", res)))
        assert inside.where(~geometry.contains(F.col("ring"), "longitude", "latitude")).count() == 0


def test_bad_and_missing_cells(spark):
    df = spark.createDataFrame([(None, -80.0), (35.0, None), (35.0, -80.0)], "latitude double, longitude double")
    assert [r[0] is None for r in df.select(cells.hex_cell("latitude", "longitude", 8)).collect()] == [True, True, False]


def test_near_cells_equals_walk_from_points(spark):
    points = spark.range(300).select("id", cells.hex_cell(35.0 + F.rand(1) * 0.1, -80.0 + F.rand(2) * 0.1, 8).alias("cell"))
    points = points.cache()
    segs = spark.range(20).select(F.col("id").alias("seg"), cells.hex_cell(35.0 + F.rand(5) * 0.1, -80.0 + F.rand(6) * 0.1, 8).alias("seg_cell")).cache()
    totals = points.groupBy(F.col("cell").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    got = near_cells(totals, "at", segs, "seg_cell", 2).groupBy("seg").agg(F.sum("n").alias("n"))
    walked = cells.explode_ring(points, "cell", 2).join(segs, F.col("h3_neighbor") == F.col("seg_cell")).groupBy("seg").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, walked.collect()))


@pytest.mark.parametrize("salts", [1, 5])
def test_time_range_join_keeps_both_ends(spark, salts):
    points = spark.createDataFrame([(1, "c", 10), (2, "c", 20), (3, "c", 21), (4, "d", 15), (5, None, 15)], "id int, cell string, t int")
    zones = spark.createDataFrame([("z", "c", 10, 20), ("y", "d", 0, 9)], "zone string, zc string, a int, b int")
    got = same_cell_during(points, zones, "cell", "zc", "t", "a", "b", [F.col("id")], salts)
    assert sorted((r["id"], r["zone"]) for r in got.collect()) == [(1, "z"), (2, "z")]


def test_time_range_join_is_a_short_loop(spark):
    """Times of unlike types are converted once a row, not once a pair, and the pairs are not made inside the function that makes the cells."""
    points = spark.sql("SELECT id, 35.0 + id / 9000 AS latitude, -80.0D AS longitude, TIMESTAMP_NTZ '2023-01-01 00:00:00' + INTERVAL '1' DAY * cast(id AS int) AS t FROM range(40)")
    points = points.withColumn("cell", cells.hex_cell("latitude", "longitude", 8))
    zones = spark.sql("SELECT concat('z', id) AS zone, TIMESTAMP '2023-01-11 00:00:00' + INTERVAL '1' DAY * cast(id AS int) AS a, TIMESTAMP '2023-01-21 00:00:00' AS b, 35.0 + id / 1e6 AS lat FROM range(3)")
    zones = zones.select("zone", "a", "b", cells.hex_cell("lat", F.lit(-80.0), 8).alias("zc"))
    got = same_cell_during(points, zones, "cell", "zc", "t", "a", "b", [F.col("id")], 3)
    here = points.first()["cell"]
    want = sorted((p["id"], f"z{k}") for p in points.collect() for k in range(3) if p["cell"] == here and 10 + k <= p["id"] <= 20)
    assert sorted((r["id"], r["zone"]) for r in got.collect()) == want and want
    assert got.columns == ["id", "latitude", "longitude", "t", "cell", "zone", "a", "b", "zc"]
    joins = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert joins and all("SortMergeJoin" in line and ">=" in line and "cast(" not in line for line in joins)


def test_wkt_round_trip_and_blank(spark):
    df = spark.createDataFrame([("LINESTRING (0 0, 3 4, 3 5)",), ("POINT (1.5 -2)",), ("",), (None,)], "w string")
    rows = df.select(geometry.parse_wkt("w").alias("p"), geometry.line_degrees(geometry.parse_wkt("w")).alias("d")).collect()
    assert [(p["x"], p["y"]) for p in rows[0]["p"]] == [(0.0, 0.0), (3.0, 4.0), (3.0, 5.0)] and rows[0]["d"] == 6.0
    assert rows[1]["p"][0]["y"] == -2.0 and rows[2]["p"] is None and rows[3]["p"] is None


def test_great_circle(spark):
    d = spark.range(1).select(geometry.miles_between(35.2271, -80.8431, 35.7796, -78.6382)).first()[0]
    a = math.sin(math.radians(0.5525) / 2) ** 2 + math.cos(math.radians(35.2271)) * math.cos(math.radians(35.7796)) * math.sin(math.radians(2.2049) / 2) ** 2
    assert d == pytest.approx(2 * 3958.8 * math.atan2(math.sqrt(a), math.sqrt(1 - a)), abs=1e-4)
