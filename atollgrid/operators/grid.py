"""Tiles, polygons and points (G1 to G17, J4, J5, J7, T3) without a geometry library."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import GRIDS, antimeridian_boxes
from .sampling import keep_first


def tiles_of_boxes(boxes: DataFrame, region: str = "non-pacific", west="x0", south="y0", east="x1", north="y1") -> DataFrame:
    """A row for each tile that a box touches (ix, iy, label). Tiles come from the box by arithmetic, so there is
    no join of boxes with tiles."""
    ox, oy, w = GRIDS[region]
    n = lambda c, o: F.floor((F.col(c) - o) / w).cast("int")
    d = boxes.withColumn("ix", F.explode(F.sequence(n(west, ox), n(east, ox)))).withColumn("iy", F.explode(F.sequence(n(south, oy), n(north, oy))))
    return d.withColumn("label", F.concat_ws("_", "ix", "iy"))


def grid_tiles(boxes: DataFrame, order: str, region: str = "non-pacific", **sides: str) -> DataFrame:
    """The tiles of all countries, each once, with the first country's columns (by `order`)."""
    return keep_first(tiles_of_boxes(boxes, region, **sides), ["label"], [order])


def plan_tasks(tiles: DataFrame, years: DataFrame) -> DataFrame:
    """Every tile in every year, as text. The few years are exploded from one array: no cross join."""
    ys = sorted({str(r["year"]) for r in years.select("year").distinct().collect()})  # a list of years
    return tiles.select(F.col("label").alias("id"), F.explode(F.array(*[F.lit(y) for y in ys])).alias("year"), "region")


def unfinished(tasks: DataFrame, key: Column, existing: DataFrame, existing_key: str) -> DataFrame:
    """Tasks whose key isn't among the existing ones."""
    return tasks.withColumn("_key", key).join(existing.select(F.col(existing_key).alias("_key")), "_key", "left_anti").drop("_key")


def crop(df: DataFrame, x0, y0, x1, y1, x="x", y="y") -> DataFrame:
    """Pixels inside a box; the filter reaches the scan."""
    return df.filter(F.col(x).between(x0, x1) & F.col(y).between(y0, y1))


def _inside(x: np.ndarray, y: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(x), bool)
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, np.roll(ring, -1, axis=0), strict=True):
            if y0 != y1:
                out ^= ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
    return out


def _from_edges(x: np.ndarray, y: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    best = np.full(len(x), np.inf)
    for ring in rings:
        for a, b in zip(ring, np.roll(ring, -1, axis=0), strict=True):
            d = b - a
            t = np.clip(((x - a[0]) * d[0] + (y - a[1]) * d[1]) / max(float(d @ d), 1e-30), 0, 1)
            best = np.minimum(best, np.hypot(x - a[0] - t * d[0], y - a[1] - t * d[1]))
    return best


def in_polygon(rings: list, buffer: float = 0.0):
    """A pandas UDF (x, y) -> whether a point is in the polygon of these rings (holes by even-odd) or
    within `buffer` of it. The rings are one country's: fixed, and small beside the pixels."""
    return in_union([rings], buffer)


def in_union(polygons: list, buffer: float = 0.0):
    """in_polygon() of the union of polygons, each a list of rings; where they overlap a point is in it all the same."""
    parts = [[np.asarray(r, float) for r in rings] for rings in polygons]

    @F.pandas_udf("boolean")
    def inside(x: pd.Series, y: pd.Series) -> pd.Series:
        a, b = x.to_numpy(float), y.to_numpy(float)
        found = np.zeros(len(a), bool)
        for rings in parts:
            found |= _inside(a, b, rings)
            if buffer > 0:
                found |= _from_edges(a, b, rings) <= buffer
        return pd.Series(found)

    return inside


def clip(df: DataFrame, rings: list, size: float, x: str = "x", y: str = "y", all_touched: bool = True) -> DataFrame:
    """Pixels, squares of side `size` about (x, y), that touch a polygon; or whose middles are in it. The polygon's box
    reaches the scan."""
    p, h = np.concatenate([np.asarray(r, float) for r in rings]), size / 2 * all_touched
    (x0, y0), (x1, y1) = p.min(0).tolist(), p.max(0).tolist()
    d = crop(df, x0 - h, y0 - h, x1 + h, y1 + h, x, y)
    middle = (F.col(x), F.col(y))
    return d.filter(touches_polygon(rings)(*[c - F.lit(h) for c in middle], *[c + F.lit(h) for c in middle]) if all_touched else in_polygon(rings)(*middle))


def touches_polygon(rings: list):
    """A pandas UDF (x0, y0, x1, y1) -> whether a box touches the polygon: a corner inside, an edge's end in the
    box, or edges that cross."""
    polygon = [np.asarray(r, float) for r in rings]

    @F.pandas_udf("boolean")
    def touches(x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
        a, b, c, d = (v.to_numpy(float) for v in (x0, y0, x1, y1))
        hit = np.zeros(len(a), bool)
        for x, y in ((a, b), (c, b), (c, d), (a, d)):
            hit |= _inside(x, y, polygon)
        for ring in polygon:
            for (px, py), (qx, qy) in zip(ring, np.roll(ring, -1, axis=0), strict=True):
                hit |= (a <= px) & (px <= c) & (b <= py) & (py <= d)
                for sx, sy, ex, ey in ((a, b, c, b), (c, b, c, d), (c, d, a, d), (a, d, a, b)):
                    side = lambda ox, oy, vx, vy, wx, wy: np.sign((vx - ox) * (wy - oy) - (vy - oy) * (wx - ox))
                    hit |= (side(sx, sy, ex, ey, px, py) * side(sx, sy, ex, ey, qx, qy) < 0) & (side(px, py, qx, qy, sx, sy) * side(px, py, qx, qy, ex, ey) < 0)
        return pd.Series(hit)

    return touches


def tiles_of_polygon(spark, rings: list, region: str = "non-pacific") -> DataFrame:
    """(ix, iy, label) of tiles that touch the polygon of all rings: those of its box, then the predicate."""
    ox, oy, w = GRIDS[region]
    p = np.concatenate([np.asarray(r, float) for r in rings])
    box = spark.createDataFrame([(float(p[:, 0].min()), float(p[:, 1].min()), float(p[:, 0].max()), float(p[:, 1].max()))], "x0 double, y0 double, x1 double, y1 double")
    t = tiles_of_boxes(box, region)
    sides = [F.col("ix") * w + ox, F.col("iy") * w + oy, (F.col("ix") + 1) * w + ox, (F.col("iy") + 1) * w + oy]
    return t.filter(touches_polygon(rings)(*sides)).select("ix", "iy", "label")


def merged_polygons(df: DataFrame, country: str, rings: str) -> DataFrame:
    """A country's polygons, of all its rows, as one list, whose union in_union() tests."""
    return df.groupBy(country).agg(F.collect_list(rings).alias(rings))


def join_regions(points: DataFrame, boxes: DataFrame, x: str = "x", y: str = "y", cell: float = 100_000.0) -> DataFrame:
    """Points with the columns of the boxes (west, south, east, north) that hold them, left. A range join made an
    equi-join on the cells that boxes touch; the sides are then compared."""
    n = lambda c: F.floor(F.col(c) / cell)
    b = boxes.withColumn("_cx", F.explode(F.sequence(n("west"), n("east")))).withColumn("_cy", F.explode(F.sequence(n("south"), n("north"))))
    p = points.withColumns({"_px": n(x), "_py": n(y)})
    inside = F.col(x).between(F.col("west"), F.col("east")) & F.col(y).between(F.col("south"), F.col("north"))
    return p.join(b, (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy")) & inside, "left").drop("_px", "_py", "_cx", "_cy")


def convex_hull(points: list) -> list[tuple[float, float]]:
    """Monotone chain, counterclockwise from the leftmost, without collinear points."""
    p = sorted({(float(x), float(y)) for x, y in points})
    if len(p) < 3:
        return p

    def half(q):
        out = []
        for c in q:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (c[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (c[0] - out[-2][0]):
                out.pop()
            out.append(c)
        return out

    low, high = half(p), half(p[::-1])
    return low[:-1] + high[:-1]


def pixel_square(x, y, size: float = 300.0) -> Column:
    """The sides of the square pixel about a point."""
    h = size / 2
    return F.struct((F.col(x) - h).alias("west"), (F.col(y) - h).alias("south"), (F.col(x) + h).alias("east"), (F.col(y) + h).alias("north"))


def split_boxes(df: DataFrame, west: str = "west", east: str = "east") -> DataFrame:
    """Boxes that cross the antimeridian as their two parts."""
    return df.withColumn("_box", F.explode(antimeridian_boxes(west, east))).withColumns({west: F.col("_box.west"), east: F.col("_box.east")}).drop("_box")


def map_extent(df: DataFrame, x="x", y="y", least: float = 50_000.0, padding: float = 0.1, bars=(1_000, 5_000, 10_000, 25_000, 50_000, 100_000, 250_000, 500_000)) -> DataFrame:
    """One row: the square map's middle and width, and the first scale bar that is at most a quarter of it."""
    d = df.agg(*[f(c).alias(f"{n}{c}") for c in (x, y) for n, f in (("lo", F.min), ("hi", F.max))])
    size = F.greatest(F.col(f"hi{x}") - F.col(f"lo{x}"), F.col(f"hi{y}") - F.col(f"lo{y}"), F.lit(least)) * (1 + padding)
    d = d.select(((F.col(f"lo{x}") + F.col(f"hi{x}")) / 2).alias("cx"), ((F.col(f"lo{y}") + F.col(f"hi{y}")) / 2).alias("cy"), size.alias("extent"))
    fits = F.filter(F.array(*[F.lit(float(b)) for b in sorted(bars, reverse=True)]), lambda b: b <= F.col("extent") / 4)
    return d.withColumn("bar", F.try_element_at(fits, F.lit(1)))


def bilinear(df: DataFrame, points: DataFrame, value: str, out: str, key: list[str] = ()) -> DataFrame:
    """Value at points (fx, fy in pixels) from their four pixels, weighted; weights of missing pixels are shared out."""
    p = points.withColumn("_id", F.monotonically_increasing_id())
    fx, fy = F.floor("fx"), F.floor("fy")
    corner = [F.struct((fx + i).cast("int").alias("x"), (fy + j).cast("int").alias("y"), ((1 - F.abs(F.col("fx") - fx - i)) * (1 - F.abs(F.col("fy") - fy - j))).alias("w")) for i in (0, 1) for j in (0, 1)]
    each = p.select(*p.columns, F.inline(F.array(*corner))).filter("w > 0").join(df.select(*key, "x", "y", F.col(value).cast("double").alias("_v")), [*key, "x", "y"], "left")
    ok = F.col("_v").isNotNull() & ~F.isnan("_v")
    s = each.groupBy(*p.columns).agg((F.sum(F.when(ok, F.col("w") * F.col("_v"))) / F.sum(F.when(ok, F.col("w")))).alias(out))
    return s.drop("_id")


def regions(df: DataFrame, country: str, of: dict[str, str], other: str = "non-pacific") -> DataFrame:
    """Countries with their region's label, sorted by name."""
    m = F.create_map(*[F.lit(x) for kv in of.items() for x in kv])
    return df.withColumn("region", F.coalesce(F.try_element_at(m, F.col(country)), F.lit(other))).orderBy(country)


def numbered(df: DataFrame, key: list[str], order: list[str], out: str = "n") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
