"""High-traffic zones, adaptive cells and trips by zone.

* ``heavy_hitters``: keys above a share of the rows, from one sketch pass and
  exact counts of its few candidates.
* ``error_by_zone``: prediction errors of the high-traffic pickup cells.
* ``quadtree``: cells that split until they hold few enough trips.
* ``trips_in_zones``: trips met with polygons by an equi-join on grid cells.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CODE_PROFILE, CleaningProfile
from .clean import bbox_condition

# ---------------------------------------------------------------------------
# Heavy hitters
# ---------------------------------------------------------------------------


def heavy_hitters(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, n): the keys that at least ``share`` of the rows have, with exact counts; a null key is none.

    A frequent-items sketch of fixed size passes over the rows once. Its
    counts err by at most ``2.7 / tracked`` of the rows, a third of ``share``
    here: so every key above the share is among its first ``2 / share``, and
    none is lost. These candidates, at most that many, are counted exactly by
    a broadcast semi-join. No table of all keys is made.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie in (0, 1]")
    wanted, tracked = math.ceil(2 / share) + 1, math.ceil(8 / share) + 8
    rows = df.select(F.col(key).alias("item"))
    seen = rows.agg(F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(item, {wanted}, {tracked})").alias("top"))
    seen = seen.select("total", F.explode("top").alias("t")).select("total", F.col("t.item").alias("candidate")).filter("candidate is not null")
    counted = rows.join(F.broadcast(seen), F.col("item") == F.col("candidate")).groupBy("item", "total").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= F.lit(float(share)) * F.col("total")).select(F.col("item").alias(key), "n")


# ---------------------------------------------------------------------------
# Errors by high-traffic zone
# ---------------------------------------------------------------------------

#: Places of a cell's two numbers in one key: each lies within 2^20 of zero.
_HALF = 1 << 20


def cell_key(lon: Column, lat: Column, cell: float) -> Column:
    """One number for the grid cell of a point, null for a point without place."""
    x, y = F.floor(lon / F.lit(cell)).cast("bigint"), F.floor(lat / F.lit(cell)).cast("bigint")
    return F.when(~F.isnan(lon) & ~F.isnan(lat), (x + _HALF) * (2 * _HALF) + y + _HALF)


def cell_parts(key: Column) -> tuple[Column, Column]:
    return (F.floor(key / (2 * _HALF)).cast("bigint") - _HALF), (key % (2 * _HALF) - _HALF)


def error_by_zone(preds: DataFrame, share: float = 0.0025, cell: float = 0.01, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """(cell_x, cell_y, n, rmse, mae, bias) of the pickup cells with at least ``share`` of the trips.

    All other trips are one more row, without a cell. The heavy cells are few
    (``1 / share`` at most), so they are broadcast.
    """
    keyed = preds.withColumn("zone", cell_key(F.col("pickup_longitude"), F.col("pickup_latitude"), cell))
    heavy = heavy_hitters(keyed, "zone", share).select(F.col("zone").alias("heavy"))
    e = F.col(label) - F.col(prediction)
    met = keyed.join(F.broadcast(heavy), F.col("zone") == F.col("heavy"), "left").groupBy("heavy")
    out = met.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"))
    x, y = cell_parts(F.col("heavy"))
    return out.select(x.alias("cell_x"), y.alias("cell_y"), "n", *(F.round(c, digits).alias(c) for c in ("rmse", "mae", "bias")))


# ---------------------------------------------------------------------------
# Adaptive cells
# ---------------------------------------------------------------------------


def morton(x: Column, y: Column, bits: int) -> Column:
    """The bits of two numbers interleaved, x below y: the cell's place on a z-order curve."""
    spread = [F.shiftleft(F.shiftright(v, b).bitwiseAND(F.lit(1).cast("bigint")), 2 * b + up) for up, v in enumerate((x, y)) for b in range(bits)]
    return reduce(add, spread)


def quadtree(trips: DataFrame, most: int, levels: int = 12, p: CleaningProfile = CODE_PROFILE) -> DataFrame:
    """(level, cell, n, west, south, east, north): pickups in cells that split until they hold at most ``most`` trips.

    The box is the root; a cell has four children, and cells of the last level
    do not split. Cells are numbered on the z-order curve, so a cell's parent
    is its number without the last two bits. Trips are counted once, at the
    finest level; all other levels are sums of those counts, so a hot place
    is a single row from the first aggregate on. Empty cells have no row.
    """
    side = 1 << levels
    west, east, south, north = p.lon_min, p.lon_max, p.lat_min, p.lat_max

    def place(col: str, low: float, high: float) -> Column:
        return F.least(F.floor((F.col(col) - low) / (high - low) * side), F.lit(side - 1)).cast("bigint")

    points = trips.filter(bbox_condition(p, ends=("pickup",))).select(place("pickup_longitude", west, east).alias("x"), place("pickup_latitude", south, north).alias("y"))
    finest = points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).select(morton(F.col("x"), F.col("y"), levels).alias("z"), "n")
    above = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    cells = finest.select("z", "n", above.alias("level")).groupBy("level", F.expr(f"shiftright(z, 2 * ({levels} - level))").alias("cell")).agg(F.sum("n").alias("n"))
    parents = cells.filter(F.col("n") > most).select((F.col("level") + 1).alias("of_level"), F.col("cell").alias("of_cell"))
    leaf = (F.col("n") <= most) | (F.col("level") == levels)
    split = cells.filter(leaf).join(parents, (F.col("level") == F.col("of_level")) & (F.shiftright("cell", 2) == F.col("of_cell")), "left")
    leaves = split.filter((F.col("level") == 0) | F.col("of_level").isNotNull())

    def bits(up: int) -> Column:
        return reduce(add, [F.shiftleft(F.shiftright("cell", 2 * b + up).bitwiseAND(F.lit(1).cast("bigint")), b) for b in range(levels)])

    width = F.lit(1.0) / F.pow(F.lit(2.0), F.col("level"))
    edges = [
        (low + (bits(up) + more) * width * (high - low)).alias(name)
        for name, up, more, low, high in (("west", 0, 0, west, east), ("south", 1, 0, south, north), ("east", 0, 1, west, east), ("north", 1, 1, south, north))
    ]
    return leaves.select("level", "cell", "n", *edges)


# ---------------------------------------------------------------------------
# Trips by zone
# ---------------------------------------------------------------------------


def zones_around(cells: DataFrame, cell: float, radius: float) -> DataFrame:
    """(zone, ring): a six-sided polygon around the centre of each cell (cell_x, cell_y)."""
    cx, cy = (F.col("cell_x") + 0.5) * cell, (F.col("cell_y") + 0.5) * cell
    turns = [(math.cos(math.pi * k / 3 + 0.3) * radius, math.sin(math.pi * k / 3 + 0.3) * radius) for k in range(6)]
    ring = F.array(*(F.struct((cx + dx).alias("x"), (cy + dy).alias("y")) for dx, dy in turns))
    return cells.select(F.concat_ws("_", "cell_x", "cell_y").alias("zone"), ring.alias("ring"))


def _edges(ring: Column) -> Column:
    following = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def in_ring(x: Column, y: Column, edges: Column) -> Column:
    """Whether a point lies in a polygon of any shape: a ray to the east crosses its edges an odd number of times."""

    def crosses(e: Column) -> Column:
        over = (e["y1"] > y) != (e["y2"] > y)
        return over & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])

    return F.size(F.filter(edges, crosses)) % 2 == 1


def cover(zones: DataFrame, cell: float) -> DataFrame:
    """(cell, zone, edges): the grid cells that a zone touches; edges are null where the zone holds the whole cell.

    A cell that no edge's bounding box meets lies inside or outside as a
    whole, as its centre does.
    """
    with_edges = zones.select("zone", _edges(F.col("ring")).alias("edges"), F.transform("ring", lambda v: v["x"]).alias("xs"), F.transform("ring", lambda v: v["y"]).alias("ys"))

    def steps(values: str) -> Column:
        low, high = (F.floor(f(values) / F.lit(cell)).cast("bigint") for f in (F.array_min, F.array_max))
        return F.explode(F.sequence(low, high))

    cells = with_edges.withColumn("i", steps("xs")).withColumn("j", steps("ys"))
    west, south = F.col("i") * F.lit(cell), F.col("j") * F.lit(cell)
    slack = cell * 1e-6  # a point on a cell's edge may be rounded either way

    def meets(e: Column) -> Column:
        return (
            (F.least(e["x1"], e["x2"]) <= west + cell + slack)
            & (F.greatest(e["x1"], e["x2"]) >= west - slack)
            & (F.least(e["y1"], e["y2"]) <= south + cell + slack)
            & (F.greatest(e["y1"], e["y2"]) >= south - slack)
        )

    border = F.exists("edges", meets)
    whole = ~border & in_ring(west + cell / 2, south + cell / 2, F.col("edges"))
    key = (F.col("i") + _HALF) * (2 * _HALF) + F.col("j") + _HALF
    return cells.select(key.alias("cover_cell"), "zone", F.when(border, F.col("edges")).alias("edges"), (border | whole).alias("touched")).filter("touched").drop("touched")


def trips_in_zones(trips: DataFrame, zones: DataFrame, cell: float = 0.005, end: str = "pickup") -> DataFrame:
    """Trips with the zones that hold their ``end``; a trip in several zones comes once for each, one in none is left out.

    Trips and covers meet on the number of a grid cell, so the plan has no
    nested loop; the exact test runs on border cells only. A cell with very
    many trips is a skewed key of that join, which adaptive execution splits.
    """
    x, y = F.col(f"{end}_longitude"), F.col(f"{end}_latitude")
    placed = trips.withColumn("trip_cell", cell_key(x, y, cell))
    met = placed.join(cover(zones, cell), F.col("trip_cell") == F.col("cover_cell"))
    return met.filter(F.col("edges").isNull() | in_ring(x, y, F.col("edges"))).drop("trip_cell", "cover_cell", "edges")


def fares_by_zone(trips: DataFrame, zones: DataFrame, cell: float = 0.005, end: str = "pickup", digits: int = 6) -> DataFrame:
    """(zone, trip_count, avg_fare) of the trips that begin (or end) in each zone."""
    found = trips_in_zones(trips, zones, cell, end).groupBy("zone")
    return found.agg(F.count(F.lit(1)).alias("trip_count"), F.round(F.avg("fare_amount"), digits).alias("avg_fare"))
