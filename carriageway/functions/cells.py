"""Hexagonal grid cells as Column arithmetic.

A cell is the text ``res:q:r`` (axial coordinates). The grid is laid over an
equirectangular plane in kilometres; one step coarser multiplies the edge by
the square root of seven. Everything runs inside generated code, so indexing a
table is a projection, not a job.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.functions.rules import as_col

# Grid origin, kilometres per degree, edge at resolution 8 (cell
# area 0.7374 square kilometres).
ORIGIN_LAT, ORIGIN_LON = 35.5, -79.5
KM_PER_DEG_LAT = 110.574
KM_PER_DEG_LON = 111.320 * math.cos(math.radians(35.5))
EDGE_KM_R8 = 0.53275
AREA_KM2_R8 = 0.7374


def edge_km(res: int) -> float:
    return EDGE_KM_R8 * math.sqrt(7.0) ** (8 - res)


def _km(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Kilometres east and north of the grid origin."""
    return (lon - F.lit(ORIGIN_LON)) * F.lit(KM_PER_DEG_LON), (lat - F.lit(ORIGIN_LAT)) * F.lit(KM_PER_DEG_LAT)


def _axial_of(x: Column, y: Column, res: int) -> tuple[Column, Column]:
    """Fractional axial coordinates."""
    edge = F.lit(edge_km(res))
    return (F.lit(math.sqrt(3) / 3) * x - y / F.lit(3.0)) / edge, (F.lit(2.0 / 3.0) * y) / edge


def _nearest_id(q: Column, r: Column, res: int) -> Column:
    """Id of the cell nearest to fractional axial coordinates."""
    s = -q - r
    near_q, near_r, near_s = (F.floor(v + F.lit(0.5)) for v in (q, r, s))
    off_q, off_r, off_s = F.abs(near_q - q), F.abs(near_r - r), F.abs(near_s - s)
    q_worst = (off_q > off_s) & (off_q > off_r)
    s_worst = off_s > off_r
    cell_q = F.when(q_worst, -near_s - near_r).otherwise(near_q)
    cell_r = F.when(q_worst | s_worst, near_r).otherwise(-near_q - near_s)
    return F.concat(F.lit(f"{res}:"), cell_q.cast("string"), F.lit(":"), cell_r.cast("string"))


def hex_cell(lat: Column | str, lon: Column | str, res: int) -> Column:
    """Cell holding a point; NULL if a coordinate is."""
    return _nearest_id(*_axial_of(*_km(as_col(lat), as_col(lon)), res), res)


def with_cells(
    df: DataFrame, resolutions=(6, 7, 8), lat: str = "latitude", lon: str = "longitude", prefix: str = "h3_index_r"
) -> DataFrame:
    """Cell columns at several resolutions.

    In two projections: the id uses each axial coordinate many times, and one
    nested expression would repeat the whole arithmetic each time.
    """
    axial_columns = {}
    for res in resolutions:
        q, r = _axial_of(*_km(F.col(lat), F.col(lon)), res)
        axial_columns |= {f"_q{res}": q, f"_r{res}": r}
    placed = df.withColumns(axial_columns)
    ids = {f"{prefix}{res}": _nearest_id(F.col(f"_q{res}"), F.col(f"_r{res}"), res) for res in resolutions}
    return placed.withColumns(ids).drop(*axial_columns)


def axial(cell: Column | str) -> tuple[Column, Column, Column]:
    """Resolution, q and r of a cell."""
    cell = as_col(cell)
    return tuple(F.split_part(cell, F.lit(":"), F.lit(i)).try_cast("int") for i in (1, 2, 3))


def ring_offsets(k: int) -> list[tuple[int, int]]:
    """Axial steps to every cell within k steps (3k(k+1)+1 of them)."""
    span = range(-k, k + 1)
    return [(dq, dr) for dq in span for dr in span if abs(dq + dr) <= k]


def ring_cells(cell: Column | str, k: int) -> Column:
    """Array of the cells within k steps, the cell itself included."""
    res, q, r = axial(cell)
    steps = F.array(*[F.struct(F.lit(dq).alias("dq"), F.lit(dr).alias("dr")) for dq, dr in ring_offsets(k)])
    return F.transform(steps, lambda o: F.concat_ws(":", res, q + o["dq"], r + o["dr"]))


def explode_ring(df: DataFrame, cell: str, k: int, out: str = "h3_neighbor") -> DataFrame:
    """One row per cell of the ring."""
    return df.where(F.col(cell).isNotNull()).withColumn(out, F.explode(ring_cells(cell, k)))


def cell_boundary(cell: Column | str) -> Column:
    """Closed ring of corner points (x = longitude, y = latitude)."""
    res, q, r = axial(cell)
    edge = F.lit(EDGE_KM_R8) * F.pow(F.lit(math.sqrt(7.0)), F.lit(8) - res)
    x = edge * (F.lit(math.sqrt(3.0)) * q + F.lit(math.sqrt(3.0) / 2.0) * r)
    y = edge * F.lit(1.5) * r

    def corner(i: Column) -> Column:
        turn = F.radians(F.lit(60.0) * (i % 6) - F.lit(30.0))
        return F.struct(
            (F.lit(ORIGIN_LON) + (x + edge * F.cos(turn)) / F.lit(KM_PER_DEG_LON)).alias("x"),
            (F.lit(ORIGIN_LAT) + (y + edge * F.sin(turn)) / F.lit(KM_PER_DEG_LAT)).alias("y"),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(6)), corner)
