"""The reference workflows end to end: composite, training, prediction (M8, sections 3.1 to 3.3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import OFFSET, SCALE, UNSCALED, scale_reflectance, spectral_indices
from ..operators import compare, focal, geomad, masks, ml, sampling
from ..sources import catalog, rasters

BANDS = ["nir08", "red", "green", "blue", "swir16", "swir22"]


def annual_composite(obs: DataFrame, bands: list[str], key: list[str], least: int = 10, clean: bool = True, include_shadow: bool = True, block: int = geomad.BLOCK) -> DataFrame:
    """Observations to the geometric median composite: guard, masks with morphological clean-up, aggregate. The quality
    bands end before the aggregate's shuffle."""
    d = geomad.require_timesteps(obs, key, least)
    if clean:
        d = masks.mask_nodata(d, bands)
        found = masks.cloud() | (masks.shadow() if include_shadow else F.lit(False))
        d = focal.clean_mask(d.withColumn("_m", found.cast("int")), "_m", "_m", [*key, "time"])
        d = masks.mask_cloud_and_shadow(d, bands, mask=F.col("_m") == 1, also=("qa_radsat",))
        d = masks.mask_saturated(d, bands)
    else:
        d = masks.mask_observations(d, bands, include_shadow)
    return geomad.geomad(d, bands, key, block, scale=SCALE, offset=OFFSET)


def features(composite: DataFrame, bands: list[str]) -> DataFrame:
    """Reflectance and indices beside the composite's own deviations and count."""
    scaled = composite.withColumns({b: scale_reflectance(b) for b in bands if b not in UNSCALED})
    return scaled.withColumns({k: v.cast("float") for k, v in spectral_indices().items()})


def with_terrain(feat: DataFrame, dem: DataFrame, resolution: float, key: list[str]) -> DataFrame:
    """Elevation, slope and aspect joined on coordinates."""
    t = focal.terrain(dem.withColumn("elevation", F.col("elevation").cast("double")), "elevation", resolution, key)
    return feat.join(t.select(*key, "y", "x", *[F.col(c).cast("float").alias(c) for c in ("elevation", "slope", "aspect")]), [*key, "y", "x"], "left")


def dem_terrain(items: DataFrame, pixels: DataFrame, points: DataFrame, west: float, east: float, step: float, resolution: float, key: list[str]) -> DataFrame:
    """Elevation, slope and aspect at a tile's points (key, y, x, lon, lat) from 1 to 9 items' pixels (lon, lat,
    elevation, step degrees apart). A tile over the antimeridian (west over east) needs items of both sides."""
    catalog.bounded(items, 1, 9)
    if west > east:
        rasters.join_halves(items)
    d = rasters.over_antimeridian(pixels, points, "elevation", step)
    return focal.terrain(d, "elevation", resolution, key)


def classify(composite: DataFrame, dem: DataFrame, model, bands: list[str], key: list[str], resolution: float = 30.0, threshold: float = 30.0) -> DataFrame:
    """M8: scale, indices, terrain, join, score: one plan, no collect."""
    d = with_terrain(features(composite, bands), dem, resolution, key)
    variables = [c for c in d.columns if c not in (*key, "y", "x", "count")]
    return ml.predict(d, model, variables, threshold).select(*key, "y", "x", "classification", "classification_unfiltered", "classification_probability")


def training_points(layers: DataFrame, feat: DataFrame, names: list[str], key: list[str], id_: str, n: int = 2100, least: int = 300) -> DataFrame:
    """Section 3.3: agreed classes, valid pixels only (P17), stratified sample, features, outliers away."""
    stable = compare.eroded_agreement(layers, key).select(*key, "y", "x", id_, F.col("stable").alias("lulc"))
    d = stable.filter(F.col("lulc") != 255).join(feat, [*key, "y", "x"]).filter(~F.isnan(F.col("red").cast("double")))
    d = ml.drop_missing(sampling.sample(d, "lulc", id_, n=n, least=least), names)
    scaled = ml.standardise(d.select(id_, "lulc", *[F.col(f).cast("double").alias(f) for f in names]), names)
    far = sampling.worst(ml.kmeans_distance(scaled, "lulc", names), "lulc", "distance", id_).filter("outlier")
    return d.join(far.select(id_), id_, "left_anti")
