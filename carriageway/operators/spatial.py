"""Joins and rollups on hex cells and polygons.

Points are the large side everywhere. Rings and polygon covers are exploded on
the other side, and points are combined per cell before a join wherever only
sums are needed; a polygon join lists a point once per cell size in use, three
for polygons of like size. Hot cells are split by
``salts``: points spread over that many join keys, areas repeated under each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carriageway.functions.cells import ring_cells
from carriageway.functions.geometry import contains, extent
from carriageway.functions.rules import banded


def salted(points: DataFrame, areas: DataFrame, spread: Sequence[Column], salts: int) -> tuple[DataFrame, DataFrame]:
    """Give both sides a ``_salt`` key: points one value each, areas all of them."""
    if salts <= 1:
        return points.withColumn("_salt", F.lit(0)), areas.withColumn("_salt", F.lit(0))
    return (
        points.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")),
        areas.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))),
    )


def near_cells(
    cell_totals: DataFrame, cell: str, segments: DataFrame, segment_cell: str, k: int
) -> DataFrame:
    """Segments beside the totals of every cell within k steps of them.

    A ring is symmetric, so walking it from the segment finds the same pairs as
    walking it from each point, without 3k(k+1)+1 copies of every point.
    """
    reach = segments.where(F.col(segment_cell).isNotNull()).withColumn(
        "_reach", F.explode(ring_cells(segment_cell, k))
    )
    return reach.join(cell_totals, F.col("_reach") == F.col(cell), "inner").drop("_reach")


def of_one_kind(sides: Sequence[tuple[DataFrame, Sequence[str]]]) -> list[DataFrame]:
    """Times that a join compares, in their common type.

    A join converts columns of unlike types anew for every pair it looks at, a
    time without zone by a time-zone look-up; here each row's are converted once.
    """
    kinds = {dict(df.dtypes)[c] for df, columns in sides for c in columns}
    if len(kinds) < 2 or not kinds <= {"date", "timestamp", "timestamp_ntz"}:
        return [df for df, _ in sides]
    wide = "timestamp" if "timestamp" in kinds else "timestamp_ntz"
    return [df.withColumns({c: F.col(c).cast(wide) for c in columns}) for df, columns in sides]


def same_cell_during(
    points: DataFrame,
    zones: DataFrame,
    cell: str,
    zone_cell: str,
    when: str,
    start: str,
    end: str,
    spread: Sequence[Column],
    salts: int = 8,
) -> DataFrame:
    """Points in a zone's cell while the zone is open (both ends included).

    Pairs grow with points times zones of a cell, so the loop over them must be
    short: a merge join keeps it in a function of its own. Behind a broadcast it
    is generated into the one that makes the cell ids, which is too long to be
    compiled; and a broadcast would hold every zone once per salt.
    """
    left, right = salted(points.withColumn("_at", F.col(when)), zones.withColumns({"_from": F.col(start), "_to": F.col(end)}), spread, salts)
    left, right = of_one_kind([(left, ["_at"]), (right.withColumnRenamed("_salt", "_zone_salt"), ["_from", "_to"])])
    cond = (
        (F.col(cell) == F.col(zone_cell))
        & (F.col("_salt") == F.col("_zone_salt"))
        & (F.col("_at") >= F.col("_from"))
        & (F.col("_at") <= F.col("_to"))
    )
    return left.join(right.hint("merge"), cond, "inner").drop("_salt", "_zone_salt", "_at", "_from", "_to")


#: Side of the coarsest cells in degrees, how many times a side is cut per level, and the finest level.
COARSEST, CUT, FINEST = 16.0, 4, 4
#: Levels that a border cell may lie below the cells a polygon starts with.
DEEPER = 2


def cell_side(level):
    """Side of the cells of a level in degrees: a power of two, so cell borders are exact."""
    return COARSEST / CUT**level


def first_level(box: Column) -> Column:
    """The finest level at which a polygon's extent spans three cells at most."""
    side = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(FINEST), F.floor(F.log(float(CUT), 2 * COARSEST / F.greatest(side, F.lit(1e-12)))))), F.lit(0)).cast("int")


def met_by_edges(cells: np.ndarray, side: float, ring: np.ndarray) -> np.ndarray:
    """Which closed cells (x, y numbers) an edge of the ring may touch; never false for one that does."""
    low, hit = cells * side, np.zeros(len(cells), bool)
    a, b = ring[:-1], ring[1:]
    step = max(1, 2_000_000 // max(len(a), 1))
    for at in range(0, len(cells), step):
        lo = low[at:at + step, None, :]
        hi = lo + side
        near = ((np.minimum(a, b) <= hi) & (np.maximum(a, b) >= lo)).all(axis=2)
        sides = [(b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (b[:, 1] - a[:, 1]) * (x - a[:, 0])
                 for x in (lo[..., 0], hi[..., 0]) for y in (lo[..., 1], hi[..., 1])]
        slack = 1e-9 * (1 + np.abs(np.stack(sides)).max(axis=0))
        apart = np.logical_or(np.all([s > slack for s in sides], axis=0), np.all([s < -slack for s in sides], axis=0))
        hit[at:at + step] = (near & ~apart).any(axis=1)
    return hit


def holds(ring: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Even-odd test of points that no edge touches."""
    inside = np.zeros(len(points), bool)
    for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
        cross = (y1 > points[:, 1]) != (y2 > points[:, 1])
        inside ^= cross & (points[:, 0] < x1 + (x2 - x1) * (points[:, 1] - y1) / ((y2 - y1) or 1.0))
    return inside


def cells_of(ring: np.ndarray, level: int) -> list[tuple[int, int, int, bool]]:
    """Disjoint cells (level, x, y, whole) that cover a ring. A whole cell lies inside; only cells on the border are cut further."""
    lo, hi = (np.floor(f(ring, axis=0) / cell_side(level)).astype(int) for f in (np.min, np.max))
    now = np.array([(x, y) for x in range(lo[0], hi[0] + 1) for y in range(lo[1], hi[1] + 1)])
    out, last = [], min(level + DEEPER, FINEST)
    while len(now):
        border = met_by_edges(now, cell_side(level), ring)
        free = now[~border]
        whole = free[holds(ring, (free + 0.5) * cell_side(level))] if len(free) else free
        out += [(level, int(x), int(y), True) for x, y in whole]
        now = now[border]
        if level == last:
            return out + [(level, int(x), int(y), False) for x, y in now]
        now = (now[:, None, :] * CUT + np.array([(x, y) for x in range(CUT) for y in range(CUT)])).reshape(-1, 2)
        level += 1
    return out


def polygon_cover(polygons: DataFrame, corners: str) -> DataFrame:
    """Each polygon under the cells (_level, _cx, _cy) that cover it; ``_whole`` cells need no test. Their number follows the border, not the area."""
    names = polygons.columns

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cells = [], []
            for k, (ring, level) in enumerate(zip(batch.column(corners).to_pylist(), batch.column("_first").to_pylist())):
                if ring:
                    own = cells_of(np.array([(p["x"], p["y"]) for p in ring], float), level)
                    at += [k] * len(own)
                    cells += own
            columns = list(zip(*cells)) if cells else [[], [], [], []]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(at, pa.int64())) for c in names],
                                              *[pa.array(c, t) for c, t in zip(columns, kinds)]], [*names, "_level", "_cx", "_cy", "_whole"])

    schema = T.StructType([*polygons.schema.fields, *[T.StructField(n, t) for n, t in (
        ("_level", T.IntegerType()), ("_cx", T.LongType()), ("_cy", T.LongType()), ("_whole", T.BooleanType()))]])
    return polygons.withColumn("_first", first_level(extent(F.col(corners)))).mapInArrow(cover, schema)


def inside_polygons(
    points: DataFrame,
    polygons: DataFrame,
    corners: str,
    x: str,
    y: str,
    salts: int = 8,
    spread: Sequence[Column] | None = None,
) -> DataFrame:
    """Points joined to every polygon that holds them.

    Both sides meet on square cells of several sizes: a polygon is listed under
    the cells of its cover, a point under its own cell of each size in use.
    Points in whole cells are inside; the even-odd test decides in border cells.
    """
    levels = polygons.agg(F.min(first_level(extent(F.col(corners)))), F.max(first_level(extent(F.col(corners))))).first()
    used = range(levels[0] or 0, min((levels[1] or 0) + DEEPER, FINEST) + 1)
    left, right = salted(points, polygon_cover(polygons, corners), spread or [F.col(x), F.col(y)], salts)
    own = [F.struct(F.lit(k).alias("level"), F.floor(F.col(x) / cell_side(k)).alias("cx"), F.floor(F.col(y) / cell_side(k)).alias("cy")) for k in used]
    left = left.withColumn("_own", F.explode(F.array(*own))).withColumn("_ps", F.col("_salt")).drop("_salt")
    cond = ((F.col("_own.level") == F.col("_level")) & (F.col("_own.cx") == F.col("_cx")) & (F.col("_own.cy") == F.col("_cy"))
            & (F.col("_ps") == F.col("_salt")))
    met = left.join(right, cond, "inner").where(F.col("_whole") | contains(F.col(corners), x, y))
    return met.drop("_own", "_ps", "_salt", "_level", "_cx", "_cy", "_whole")


# Z-score cuts of the hot and cold spot classes.
HOT_CLASSES = [
    (3.0, "Hot Spot 99% Confidence"),
    (2.0, "Hot Spot 95% Confidence"),
    (1.5, "Hot Spot 90% Confidence"),
]
COLD_CUT, COLD_LABEL, NEITHER = -1.5, "Cold Spot (low activity)", "Not Significant"


def hotspot_class(z: str) -> Column:
    cold = F.when(F.col(z) <= COLD_CUT, COLD_LABEL).otherwise(NEITHER)
    return F.when(F.col(z) >= HOT_CLASSES[-1][0], banded(z, ">=", HOT_CLASSES, NEITHER)).otherwise(cold)


def uncovered(busy: DataFrame, covered: DataFrame, cell: str) -> DataFrame:
    """Every busy cell with a flag telling whether it is in the covered set."""
    marks = covered.select(F.col(cell).alias("_covered_cell")).distinct()
    joined = busy.join(marks, F.col(cell) == F.col("_covered_cell"), "left")
    return joined.withColumn("is_covered", F.col("_covered_cell").isNotNull()).drop("_covered_cell")
