"""Fusing scenes and halves of rasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def solar_day(time, longitude=0.0) -> Column:
    """The day by the sun at a longitude."""
    lon = F.lit(longitude) if isinstance(longitude, float) else F.col(longitude)
    return F.to_date(F.col(time).cast("timestamp_ntz") + F.make_dt_interval(secs=lon * F.lit(240.0)))


def fuse(df: DataFrame, bands: list[str], key: list[str], time: str, qa: str = "qa_pixel", order: list[str] = ()) -> DataFrame:
    """One row a key: quality of the first scene where it is neither 0 nor 1, else the last scene's; of each
    band the first value that isn't 0, else 0. Aggregations alone, so scenes are fused before the shuffle."""
    at = F.struct(F.col(time), *[F.col(o) for o in order]) if order else F.col(time)
    first = lambda c, ok: F.min_by(F.when(ok, F.col(c)), F.when(ok, at))
    quality = F.coalesce(first(qa, ~F.col(qa).isin(0, 1)), F.max_by(qa, at)).alias(qa)
    return df.groupBy(*key).agg(quality, *[F.coalesce(first(b, F.col(b) != 0), F.lit(0)).alias(b) for b in bands])


def in_box(west: float, south: float, east: float, north: float, lon: str = "lon", lat: str = "lat") -> Column:
    """Whether a place is in a box, which crosses the antimeridian where its west is over its east."""
    x = F.col(lon)
    inside = (x >= west) | (x <= east) if west > east else x.between(west, east)
    return inside & F.col(lat).between(south, north)


def load(pixels: DataFrame, bands: list[str], box: tuple[float, float, float, float], key: list[str], time: str = "time", lon: str = "lon", lat: str = "lat", qa: str = "qa_pixel", order: list[str] = ()) -> DataFrame:
    """scenes' pixels on the tile's own grid, in a box, of the bands alone, one row a pixel (key) and solar day.
    The box and the bands reach the scan; scenes of a day are fused before the shuffle."""
    d = pixels.filter(in_box(*box, lon, lat)).select(*key, time, *order, qa, *bands, solar_day(time, lon).alias("day"))
    return fuse(d, bands, [*key, "day"], time, qa, order)


def shift_west(df: DataFrame, lon: str = "lon") -> DataFrame:
    """Longitudes from 0 to 360, so that both halves of an antimeridian tile join up."""
    return df.withColumn(lon, F.when(F.col(lon) < 0, F.col(lon) + 360).otherwise(F.col(lon)))


def merge_halves(west: DataFrame, east: DataFrame, key: list[str], value: str) -> DataFrame:
    """west's value where it isn't 0, else east's."""
    w, e = west.select(*key, F.col(value).alias("_w")), east.select(*key, F.col(value).alias("_e"))
    return w.join(e, key, "full").select(*key, F.when(F.col("_w") != 0, F.col("_w")).otherwise(F.coalesce("_e", "_w")).alias(value))


def join_halves(items: DataFrame, west: str = "west") -> tuple[DataFrame, DataFrame]:
    """Items of the east (bbox from 0 up) and of the west; raises unless there are both."""
    e, w = items.filter(F.col(west) >= 0), items.filter(F.col(west) < 0)
    if e.isEmpty() or w.isEmpty():
        raise ValueError("a tile over the antimeridian needs items of both sides")
    return e, w


def ring_longitude(ring: str) -> Column:
    """The mean longitude of a ring of (x, y) points, the closing one left out; its sign says the side."""
    open_ = F.when(F.get(ring, 0) == F.element_at(ring, -1), F.slice(ring, 1, F.size(ring) - 1)).otherwise(F.col(ring))
    return F.aggregate(open_, F.lit(0.0), lambda a, p: a + p[0]) / F.size(open_)


def over_antimeridian(pixels: DataFrame, points: DataFrame, value: str, step: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Points (lon, lat) with the value there, bilinear, of pixels `step` degrees apart on both sides of the
    antimeridian: longitudes run from 0 to 360, so that the halves are one grid."""
    from ..operators.grid import bilinear

    at = lambda c: F.col(c) / F.lit(step)
    d = shift_west(pixels, lon).select(F.round(at(lon)).cast("int").alias("x"), F.round(at(lat)).cast("int").alias("y"), value)
    p = shift_west(points.withColumns({"_lon": F.col(lon), "_lat": F.col(lat)}), "_lon")
    p = p.withColumns({"fx": at("_lon"), "fy": at("_lat")}).drop("_lon", "_lat")
    return bilinear(d, p, value, value).drop("fx", "fy")


def align(first: DataFrame, *rest: DataFrame, key: list[str], how: str = "full") -> DataFrame:
    """Layers side by side on their coordinates; one shuffle each, reused from join to join."""
    for df in rest:
        first = first.join(df, key, how)
    return first
