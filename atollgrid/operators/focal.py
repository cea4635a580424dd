"""Neighbourhood operators (N1 to N5): morphology on blocks with borders, the others as pairs of one-dimensional window passes.

A tile's rows, then its columns, are these windows' partitions: each is one pixel wide, so a tile is worked by thousands of
tasks' worth of partitions and a pixel is shuffled twice, whatever the neighbourhood's size. `key` names the tile's columns.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pixels a side of a block that one task works on at a time.
BLOCK = 256


def row(key: list[str], radius: int | None = None):
    w = Window.partitionBy(*key, "y").orderBy("x")
    return w if radius is None else w.rangeBetween(-radius, radius)


def column(key: list[str], radius: int | None = None):
    w = Window.partitionBy(*key, "x").orderBy("y")
    return w if radius is None else w.rangeBetween(-radius, radius)


def minimum_filter(df: DataFrame, value: str, out: str, key: list[str], radius: int = 1) -> DataFrame:
    """Least value around each pixel; pixels outside, or missing, count as 0."""
    n = 2 * radius + 1
    least = lambda c, w: F.when(F.count(c).over(w) == n, F.min(c).over(w)).otherwise(F.lit(0))
    return df.withColumn("_row", least(F.col(value), row(key, radius))).withColumn(out, least(F.col("_row"), column(key, radius))).drop("_row")


def _edge_sum(c: Column, at: Column, w, radius: int, low: Column, high: Column) -> Column:
    """Sum over a frame in which pixels beyond the edge repeat the edge's."""
    zero = F.lit(0)
    before, after = F.greatest(zero, F.lit(radius) - (at - low)), F.greatest(zero, F.lit(radius) - (high - at))
    return F.sum(c).over(w) + before * F.first(c).over(w) + after * F.last(c).over(w)


def local_share(df: DataFrame, hit: str, valid: str, out: str, key: list[str], radius: int = 2) -> DataFrame:
    """Percent of the valid pixels around that are hits, edges repeated; NaN without a valid one. hit, valid: 0 or 1."""
    x, y, tile = F.col("x"), F.col("y"), Window.partitionBy(*key, "y")
    side = Window.partitionBy(*key, "x")
    d = df.withColumns({"_a": F.col(hit) * F.col(valid), "_v": F.col(valid).cast("int")})
    d = d.withColumns({c: _edge_sum(F.col(c), x, row(key, radius), radius, F.min("x").over(tile), F.max("x").over(tile)) for c in ("_a", "_v")})
    d = d.withColumns({c: _edge_sum(F.col(c), y, column(key, radius), radius, F.min("y").over(side), F.max("y").over(side)) for c in ("_a", "_v")})
    return d.withColumn(out, F.when(F.col("_v") > 0, F.col("_a") / F.col("_v") * 100).otherwise(F.lit(float("nan")))).drop("_a", "_v")


def heterogeneity(df: DataFrame, value: str, out: str, key: list[str], radius: int = 2) -> DataFrame:
    """How many classes over 0 stand around each pixel, NaN for none. Classes are bits, or-ed over rows, then columns;
    repeating edges adds no class. Classes: 1 to 62."""
    bit = F.when(F.col(value) > 0, F.expr(f"shiftleft(1L, int(`{value}`))")).otherwise(F.lit(0).cast("long"))
    d = df.withColumn("_b", bit).withColumn("_b", F.bit_or("_b").over(row(key, radius))).withColumn("_b", F.bit_or("_b").over(column(key, radius)))
    return d.withColumn(out, F.when(F.col("_b") != 0, F.bit_count("_b").cast("double")).otherwise(F.lit(float("nan")))).drop("_b")


def terrain(df: DataFrame, elevation: str, resolution: float, key: list[str]) -> DataFrame:
    """Slope and aspect in degrees from Sobel differences; edges repeat. Rows run downwards."""
    z = F.col(elevation).cast("double")
    d = df.withColumns({"_l": F.coalesce(F.lag(z).over(row(key)), z), "_r": F.coalesce(F.lead(z).over(row(key)), z)})
    d = d.withColumns({"_d": F.col("_r") - F.col("_l"), "_s": F.col("_l") + 2 * z + F.col("_r")})
    up, down = lambda c: F.coalesce(F.lag(c).over(column(key)), F.col(c)), lambda c: F.coalesce(F.lead(c).over(column(key)), F.col(c))
    d = d.withColumns({"_dx": (up("_d") + 2 * F.col("_d") + down("_d")) / (8 * resolution), "_dy": (down("_s") - up("_s")) / (8 * resolution)})
    turn = F.lit(90.0) - F.degrees(F.atan2(-F.col("_dy"), F.col("_dx")))
    slope = F.degrees(F.atan(F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))))
    return d.withColumns({"slope": slope, "aspect": F.pmod(turn, F.lit(360.0))}).drop("_l", "_r", "_d", "_s", "_dx", "_dy")


def disk_widths(radius: int) -> dict[int, int]:
    """Half width of each row of a disk."""
    return {dy: int(math.sqrt(radius * radius - dy * dy)) for dy in range(-radius, radius + 1)}


def _spread(grid: np.ndarray, radius: int, outside: int) -> np.ndarray:
    """The largest (outside: 0) or least (outside: 1) value of the disk around each cell; beyond the grid is outside."""
    pick, (h, w) = np.maximum if outside == 0 else np.minimum, grid.shape
    wide = np.pad(grid, radius, constant_values=outside)
    out = grid.copy()
    for dy, half in disk_widths(radius).items():
        for dx in range(-half, half + 1):
            pick(out, wide[radius + dy : radius + dy + h, radius + dx : radius + dx + w], out=out)
    return out


def morphology(df: DataFrame, mask: str, out: str, key: list[str], steps: list[tuple[int, int]], block: int = BLOCK) -> DataFrame:
    """df with `out`: the steps (radius, 0 to dilate or 1 to erode) on a 0/1 mask, with disks. Pixels that aren't there
    count as 0 when dilating and as 1 when eroding.

    One shuffle of key, place and mask, of blocks with a border of the steps' radii in all, within which a block's own
    pixels need no other's; the result is joined back by place, so other columns never pass through Python.
    """
    border = sum(r for r, _ in steps)
    kinds = dict(df.dtypes)
    near = lambda c: F.explode(F.sequence(F.floor((F.col(c) - border) / block), F.floor((F.col(c) + border) / block)))
    slim = df.select(*key, "y", "x", F.col(mask).cast("int").alias("_m")).withColumn("_by", near("y")).withColumn("_bx", near("x"))

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        by, bx = int(pdf["_by"].iloc[0]), int(pdf["_bx"].iloc[0])
        y, x = (pdf[c].to_numpy(np.int64) - b * block + border for c, b in (("y", by), ("x", bx)))
        size = block + 2 * border
        there, grid = np.zeros((size, size), bool), np.zeros((size, size), np.uint8)
        there[y, x], grid[y, x] = True, pdf["_m"].to_numpy()
        for radius, outside in steps:
            grid = _spread(np.where(there, grid, np.uint8(outside)), radius, outside)
        own = (y >= border) & (y < border + block) & (x >= border) & (x < border + block)
        return pdf.loc[own, [*key, "y", "x"]].assign(**{"_out": grid[y[own], x[own]].astype("int32")})

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*key, "y", "x"]) + ", _out int"
    done = slim.groupBy(*key, "_by", "_bx").applyInPandas(work, schema)
    rest = df.drop(out) if out != mask else df.drop(mask)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*key, "y", "x"]]
    return rest.alias("l").join(done.alias("r"), same, "left").select("l.*", F.col("r._out").alias(out))


def dilation(df: DataFrame, mask: str, out: str, key: list[str], radius: int) -> DataFrame:
    """1 where a pixel of the disk around is 1; outside counts as 0."""
    return morphology(df, mask, out, key, [(radius, 0)])


def erosion(df: DataFrame, mask: str, out: str, key: list[str], radius: int) -> DataFrame:
    """1 where all pixels of the disk around are 1; outside counts as 1."""
    return morphology(df, mask, out, key, [(radius, 1)])


def clean_mask(df: DataFrame, mask: str, out: str, key: list[str], steps=(("opening", 3), ("dilation", 5), ("erosion", 2))) -> DataFrame:
    """Morphological steps on a 0/1 mask, with disks of the given radius (the element's shape is our choice)."""
    parts = {"opening": (1, 0), "closing": (0, 1), "dilation": (0,), "erosion": (1,)}
    return morphology(df, mask, out, key, [(radius, outside) for step, radius in steps for outside in parts[step]])
