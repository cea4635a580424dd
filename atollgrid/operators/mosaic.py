"""Mosaic index by quadkey (A16, S18) and what a viewer asks (V1 to V4)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import GRIDS, class_color, equal_area, grid_tile, rescale_byte, tooltip

MIN_ZOOM, MAX_ZOOM = 5, 14


def quadkey(x, y, zoom: int = MIN_ZOOM):
    """The quadkey of a web tile."""
    digit = lambda b: (F.shiftright(x, b).bitwiseAND(F.lit(1)) + 2 * F.shiftright(y, b).bitwiseAND(F.lit(1))).cast("string")
    return F.concat(*[digit(b) for b in range(zoom - 1, -1, -1)])


def tile_x(lon, zoom: int = MIN_ZOOM):
    n = 1 << zoom
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((lon + 180.0) / 360.0 * n))).cast("int")


def tile_y(lat, zoom: int = MIN_ZOOM):
    n, r = 1 << zoom, F.radians(F.greatest(F.lit(-85.05112878), F.least(F.lit(85.05112878), lat)))
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((1 - F.ln(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * n))).cast("int")


def mosaic_index(items: DataFrame, zoom: int = MIN_ZOOM, link: str = "href") -> DataFrame:
    """(quadkey, assets) with the sorted links of the items whose boxes touch a web tile."""
    c = F.col
    d = items.withColumn("_x", F.explode(F.sequence(tile_x(c("west"), zoom), tile_x(c("east"), zoom)))).withColumn("_y", F.explode(F.sequence(tile_y(c("north"), zoom), tile_y(c("south"), zoom))))
    return d.groupBy(quadkey(c("_x"), c("_y"), zoom).alias("quadkey")).agg(F.array_sort(F.collect_set(link)).alias("assets"))


def mosaic_document(items: DataFrame, year: str, zoom: int = MIN_ZOOM) -> DataFrame:
    """One row, the mosaic as a JSON document; raises without items."""
    if items.isEmpty():
        raise ValueError(f"No STAC items found for year {year}")
    tiles = mosaic_index(items, zoom).agg(F.map_from_entries(F.collect_list(F.struct("quadkey", "assets"))).alias("tiles"))
    box = items.agg(F.array(F.min("west"), F.min("south"), F.max("east"), F.max("north")).alias("bounds")).first()["bounds"]
    doc = F.struct(F.lit("0.0.3").alias("mosaicjson"), F.lit(year).alias("name"), F.lit(zoom).alias("minzoom"), F.lit(MAX_ZOOM).alias("maxzoom"), F.array(*[F.lit(float(v)) for v in box]).alias("bounds"), F.col("tiles"))
    return tiles.select(F.to_json(doc).alias("value"))


def viewer_config(mosaics: DataFrame) -> DataFrame:
    """V4: (dataset, years, default_year), and a row `all` over every dataset."""
    each = mosaics.select("dataset", "year").unionByName(mosaics.select(F.lit("all").alias("dataset"), "year"))
    years = each.groupBy("dataset").agg(F.array_sort(F.collect_set("year")).alias("years"))
    return years.withColumn("default_year", F.try_element_at("years", F.lit(-1)))


def mosaic_path(mosaics: DataFrame, dataset: str, year: str) -> str:
    """V3: the path of a dataset's year; raises with the years there are."""
    rows = mosaics.filter(F.col("dataset") == dataset).select("year", "path").collect()  # a row a year
    found = {r["year"]: r["path"] for r in rows}
    if year not in found:
        raise KeyError(f"{dataset} has no {year}; available: {sorted(found)}")
    return found[year]


def tile_cells(pixels: DataFrame, west: float, south: float, east: float, north: float, size: int = 256) -> DataFrame:
    """V1: the pixels (lon, lat) of a web tile, with the row and col of the tile's cell that each lies in."""
    d = pixels.filter(F.col("lon").between(west, east) & F.col("lat").between(south, north))
    place = {"row": (north - F.col("lat")) / (north - south), "col": (F.col("lon") - west) / (east - west)}
    return d.withColumns({k: F.least(F.floor(v * size), F.lit(size - 1)).cast("int") for k, v in place.items()})


def render_tile(pixels: DataFrame, west: float, south: float, east: float, north: float, value: str, low: float, high: float, size: int = 256, order: str = "asset") -> DataFrame:
    """V1: (row, col, value, byte) of a web tile: pixels binned into it, the first asset's value where several meet."""
    return render_bands(pixels, west, south, east, north, {value: F.col(value)}, (low, high), size, order).withColumnRenamed(f"{value}_byte", "byte")


def render_bands(pixels: DataFrame, west: float, south: float, east: float, north: float, bands: dict[str, Column], rescale: tuple[float, float], size: int = 256, order: str = "asset") -> DataFrame:
    """V1: (row, col, and of each band its value and NAME_byte) of a web tile. Bands are expressions over the pixels'
    columns, each the first asset's that has it where several pixels meet in a cell."""
    d = tile_cells(pixels, west, south, east, north, size).withColumns({f"_{n}": e for n, e in bands.items()})
    first = [F.min_by(f"_{n}", F.when(F.col(f"_{n}").isNotNull(), F.struct(order, f"_{n}"))).alias(n) for n in bands]
    d = d.groupBy("row", "col").agg(*first).filter(F.coalesce(*[F.col(n).cast("double") for n in bands]).isNotNull())
    return d.withColumns({f"{n}_byte": rescale_byte(n, *rescale) for n in bands})


def render_classes(pixels: DataFrame, west: float, south: float, east: float, north: float, value: str, colors: dict[int, str], size: int = 256, order: str = "asset") -> DataFrame:
    """(row, col, value, color) of a web tile of classes; cells of classes without a colour are left out."""
    d = tile_cells(pixels, west, south, east, north, size).filter(F.col(value).isNotNull())
    d = d.groupBy("row", "col").agg(F.min_by(value, F.struct(order, value)).alias(value))
    return d.withColumn("color", class_color(value, colors)).filter("color is not null")


def pixel_of(lon, lat, resolution: float = 30.0) -> dict[str, Column]:
    """V2: tile (ix, iy) and pixel (y from the tile's north, x from its west) in which a longitude and latitude lie."""
    px, py = equal_area(lon, lat)
    (ox, oy, width), (ix, iy) = GRIDS["non-pacific"], grid_tile(px, py)
    x = F.floor((px - F.lit(ox) - ix * F.lit(width)) / F.lit(resolution)).cast("int")
    y = F.floor((F.lit(oy) + (iy + 1) * F.lit(width) - py) / F.lit(resolution)).cast("int")
    return {"ix": ix, "iy": iy, "y": y, "x": x}


def point_values(points: DataFrame, layers: DataFrame, values: list[str], resolution: float = 30.0) -> DataFrame:
    """V2: points (lon, lat) with the layers' values where they lie, and `tip`, the tooltip. Points become tile and pixel
    numbers by arithmetic, so the look-up is an equi-join on these."""
    p = points.withColumns(pixel_of("lon", "lat", resolution))
    return p.join(layers.select("ix", "iy", "y", "x", *values), ["ix", "iy", "y", "x"], "left").withColumn("tip", tooltip(values, values))
