"""A query per operator over the adapters, and the SQL that says the same."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import compare, focal, geomad, grid, masks, ml, mosaic, reclass, sampling
from ..sources import catalog, rasters
from ..sources.countries import PACIFIC, country_table, list_countries
from . import pipelines
from .adapters import BANDS, FEATURES, SAMPLES_CTE, adapter, cte, samples

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
KEY = ["tile"]


def query(sql: str | None = None, name: str | None = None):
    """Registers a query, and its SQL if SQL can say it."""

    def register(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE[name or f.__name__] = sql
        return f

    return register


def many(xs, form: str, sep: str = ", ") -> str:
    return sep.join(form.replace("$", x) for x in xs)


# --- masks of observations

_NODATA = "(" + many(BANDS, "$ = 0", " OR ") + " OR (qa_pixel & 1) <> 0)"
_CLOUD = "((qa_pixel & 224) = 0 AND qa_pixel NOT IN (0, 1))"
_SHADOW = "((qa_pixel & 16) <> 0 AND qa_pixel NOT IN (0, 1) AND (qa_pixel & 64) = 0)"
_M1 = f"m1 AS (SELECT tile, y, x, time, scene, {many(BANDS, f'CASE WHEN {_NODATA} THEN 0 ELSE $ END AS $')}, qa_pixel, qa_radsat FROM px_obs)"
_M2 = f"m2 AS (SELECT tile, y, x, time, scene, {many([*BANDS, 'qa_pixel', 'qa_radsat'], f'CASE WHEN {_CLOUD} OR {_SHADOW} THEN 0 ELSE $ END AS $')} FROM m1)"
_M3 = f"m3 AS (SELECT tile, y, x, time, scene, {many([*BANDS, 'qa_pixel'], 'CASE WHEN qa_radsat <> 0 THEN 0 ELSE $ END AS $')}, qa_radsat FROM m2)"
_MASKS = f"WITH {cte('px_obs')}, {_M1}, {_M2}, {_M3}"
_OBS = f"scene, {many(BANDS, '$')}, qa_pixel"


def obs(spark, sf_dir):
    return adapter(spark, sf_dir, "px_obs")


@query(f"WITH {cte('px_obs')}, {_M1} SELECT {_OBS} FROM m1")
def mask_nodata(spark, sf_dir):
    return masks.mask_nodata(obs(spark, sf_dir), BANDS).select("scene", *BANDS, "qa_pixel")


@query(f"WITH {cte('px_obs')}, {_M2.replace('FROM m1', 'FROM px_obs')} SELECT {_OBS} FROM m2")
def mask_cloud_shadow(spark, sf_dir):
    return masks.mask_cloud_and_shadow(obs(spark, sf_dir), BANDS).select("scene", *BANDS, "qa_pixel")


@query(f"WITH {cte('px_obs')}, {_M3.replace('FROM m2', 'FROM px_obs')} SELECT {_OBS} FROM m3")
def mask_saturated(spark, sf_dir):
    return masks.mask_saturated(obs(spark, sf_dir), BANDS, also=("qa_pixel",)).select("scene", *BANDS, "qa_pixel")


@query(_MASKS + f" SELECT {_OBS} FROM m3")
def mask_chain(spark, sf_dir):
    return masks.mask_observations(obs(spark, sf_dir), BANDS).select("scene", *BANDS, "qa_pixel")


@query(f"WITH {cte('px_obs')} SELECT qa_pixel, CAST(count(*) AS BIGINT) AS n, array_to_string(list_filter([" + ", ".join(f"CASE WHEN (qa_pixel & {1 << i}) <> 0 THEN '{n}' END" for i, n in enumerate(C.QA_BITS)) + "], lambda s: s IS NOT NULL), ',') AS names FROM px_obs GROUP BY qa_pixel")
def qa_decode(spark, sf_dir):
    return obs(spark, sf_dir).groupBy("qa_pixel").agg(F.count(F.lit(1)).alias("n")).withColumn("names", C.qa_names("qa_pixel"))


# --- reflectance, indices, statistics

_REFL = "CASE WHEN $ IN (0, 65535) THEN NULL ELSE CAST(greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), $ * 2.75e-5 + -2e-1)) AS FLOAT) END"


def _micro(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), F.floor(c.cast("double") * 1e6 + 0.5).cast("long"))


@query(f"WITH {cte('px_obs')} SELECT scene, {many(BANDS, f'CAST(floor(CAST({_REFL} AS DOUBLE) * 1e6 + 0.5) AS BIGINT) AS $')} FROM px_obs")
def scale_reflectance(spark, sf_dir):
    return obs(spark, sf_dir).select("scene", *[_micro(C.scale_reflectance(b)).alias(b) for b in BANDS])


_INDEX = {
    "ndvi": ("nir08 - red", "nir08 + red", ""), "ndwi": ("green - nir08", "green + nir08", ""), "mndwi": ("green - swir16", "green + swir16", ""), "ndti": ("red - green", "red + green", ""),
    "bsi": ("(swir16 + red) - (nir08 + blue)", "(swir16 + red) + (nir08 + blue)", ""), "mbi": ("swir16 - swir22 - nir08", "swir16 + swir22 + nir08", " + 0.5"), "baei": ("red + 3e-1", "green + swir16", ""),
}
_FINITE = "CASE WHEN isnan($) OR isinf($) THEN NULL ELSE round($, 5) END"


def _finite(c):
    c = F.col(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(F.round(c, 5))


_SCALED = f"scaled AS (SELECT pixel, {many(BANDS, f"CAST(coalesce({_REFL}, CAST('NaN' AS FLOAT)) AS DOUBLE) AS $")} FROM px_grid)"
_INDICES = "idx AS (SELECT pixel, " + ", ".join(f"({a}) / ({b}){c} AS {n}" for n, (a, b, c) in _INDEX.items()) + ", (swir16 - nir08) / (swir16 + nir08) - (nir08 - red) / (nir08 + red) AS bui FROM scaled)"


_ODD = "CASE WHEN isnan($) THEN 'nan' WHEN isinf($) AND $ > 0 THEN 'inf' WHEN isinf($) THEN '-inf' ELSE '' END"


@query(f"WITH {cte('px_grid')}, {_SCALED}, {_INDICES} SELECT pixel, {many([*_INDEX, 'bui'], _FINITE + ' AS $')} FROM idx")
def spectral_indices(spark, sf_dir):
    d = adapter(spark, sf_dir, "px_grid").select("pixel", *[C.scale_reflectance(b).alias(b) for b in BANDS])
    return d.withColumns(C.spectral_indices()).select("pixel", *[_finite(n).alias(n) for n in [*_INDEX, "bui"]])


@query(f"WITH {cte('px_grid')}, d AS (SELECT pixel, CAST(pixel % 3 - 1 AS DOUBLE) AS a, CAST(pixel % 2 AS DOUBLE) AS b, CASE WHEN pixel % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS c FROM px_grid), v AS (SELECT pixel, a / b AS ab, c / b AS cb FROM d) SELECT pixel, {many(('ab', 'cb'), _FINITE + ' AS $, ' + _ODD + ' AS $_odd')} FROM v")
def ieee_division(spark, sf_dir):
    d = adapter(spark, sf_dir, "px_grid").select("pixel", (F.col("pixel") % 3 - 1).cast("double").alias("a"), (F.col("pixel") % 2).cast("double").alias("b"), F.when(F.col("pixel") % 5 == 0, float("nan")).otherwise(0.0).alias("c"))
    d = d.select("pixel", C.ieee_divide("a", "b").alias("ab"), C.ieee_divide("c", "b").alias("cb"))
    odd = lambda c: F.when(F.isnan(c), "nan").when(F.col(c) == float("inf"), "inf").when(F.col(c) == float("-inf"), "-inf").otherwise("")
    return d.select("pixel", *[x for c in ("ab", "cb") for x in (_finite(c).alias(c), odd(c).alias(f"{c}_odd"))])


@query(f"WITH {cte('px_grid')}, {_SCALED} SELECT pixel, {many(BANDS[1:4], 'CASE WHEN isnan($) THEN NULL ELSE round((greatest(CAST(0 AS DOUBLE), least(3e-1, $)) - 0) / 3e-1, 5) END AS $')} FROM scaled")
def rgb_stretch(spark, sf_dir):
    d = adapter(spark, sf_dir, "px_grid").select("pixel", *[C.scale_reflectance(b).cast("double").alias(b) for b in BANDS[1:4]])
    return d.withColumns({b: C.stretch(b, 0.0, 0.3) for b in BANDS[1:4]}).select("pixel", *[_finite(b).alias(b) for b in BANDS[1:4]])


@query(f"WITH {cte('px_grid')} " + " UNION ALL ".join(f"SELECT '{b}' AS band, CAST(min(CASE WHEN {b} <> 0 THEN {b} END) AS DOUBLE) AS \"min\", CAST(median(CASE WHEN {b} <> 0 THEN {b} END) AS DOUBLE) AS \"median\", CAST(max(CASE WHEN {b} <> 0 THEN {b} END) AS DOUBLE) AS \"max\", round(count(*) FILTER ({b} = 0) / count(*) * 100, 6) AS missing FROM px_grid" for b in BANDS))
def band_stats(spark, sf_dir):
    return compare.band_stats(adapter(spark, sf_dir, "px_grid"), BANDS).withColumn("missing", F.round("missing", 6))


# --- fusing, counts, composites

_OK = many(BANDS, "$ <> 0", " AND ")


@query(_MASKS + f" SELECT tile, y, x, CAST(count(*) FILTER ({_OK}) AS INT) AS \"count\" FROM m3 GROUP BY tile, y, x")
def clear_count(spark, sf_dir):
    return geomad.clear_count(masks.mask_observations(obs(spark, sf_dir), BANDS), BANDS, KEY)


_MEDIANS = f"med AS (SELECT tile, y, x, {many(BANDS, f'coalesce(CAST(floor(median($) FILTER ({_OK}) + 0.5) AS INT), 0) AS $')}, CAST(count(*) FILTER ({_OK}) AS INT) AS n FROM m3 GROUP BY tile, y, x)"


_N, _R = (f"CAST({_REFL.replace('$', b)} AS DOUBLE)" for b in ("nir08", "red"))


@query(f"{_MASKS}, {_MEDIANS} SELECT tile, y, x, {many(BANDS, '$')}, n AS \"count\", round(({_N} - {_R}) / nullif({_N} + {_R}, 0), 5) AS ndvi FROM med")
def median_composite(spark, sf_dir):
    """The flagship: quality masks, composite of each pixel's clear observations, reflectance, vegetation index."""
    d = geomad.median_composite(masks.mask_observations(obs(spark, sf_dir), BANDS), BANDS, KEY)
    n, r = C.scale_reflectance("nir08").cast("double"), C.scale_reflectance("red").cast("double")
    ndvi = C.ieee_divide(n - r, n + r)
    return d.withColumn("ndvi", ndvi).withColumn("ndvi", _finite("ndvi"))


@query()
def geomad_composite(spark, sf_dir):
    d = masks.mask_observations(obs(spark, sf_dir), BANDS).select("tile", "y", "x", *BANDS)
    return geomad.geomad(d, BANDS, KEY, scale=C.SCALE, offset=C.OFFSET)


_S = lambda b: f"({b} * 2.75e-5 + -2e-1)"
_DEVIATIONS = f"""
ok AS (SELECT tile, y, x, {many(BANDS, f'{_S("$")} AS $')} FROM m3 WHERE {_OK}),
mid AS (SELECT tile, y, x, {many(BANDS, 'avg($) AS c_$')} FROM ok GROUP BY tile, y, x),
far AS (
  SELECT ok.tile, ok.y, ok.x, greatest(0, 1 - ({many(BANDS, '$ * c_$', ' + ')}) / sqrt(({many(BANDS, '$ * $', ' + ')}) * ({many(BANDS, 'c_$ * c_$', ' + ')}))) AS s,
    sqrt({many(BANDS, '($ - c_$) * ($ - c_$)', ' + ')}) AS e, ({many(BANDS, 'abs($ - c_$)', ' + ')}) / ({many(BANDS, 'abs($ + c_$)', ' + ')}) AS b
  FROM ok JOIN mid ON ok.tile = mid.tile AND ok.y = mid.y AND ok.x = mid.x),
dev AS (SELECT tile, y, x, round(median(s), 4) AS smad, round(median(e), 4) AS emad, round(median(b), 4) AS bcmad, CAST(count(*) AS INT) AS "count" FROM far GROUP BY tile, y, x)"""


@query(f"{_MASKS}, {_DEVIATIONS} SELECT * FROM dev")
def geomad_deviations(spark, sf_dir):
    """The three deviations on scaled values, about the mean: the estimate before its first iteration."""
    d = masks.mask_observations(obs(spark, sf_dir), BANDS).select("tile", "y", "x", *BANDS)
    d = geomad.geomad(d, BANDS, KEY, iterations=0, scale=C.SCALE, offset=C.OFFSET, kind="double").filter("count > 0")
    return d.select("tile", "y", "x", *[F.round(c, 4).alias(c) for c in ("smad", "emad", "bcmad")], "count")


@query()
def annual_composite(spark, sf_dir):
    d = obs(spark, sf_dir).withColumn("time", F.date_trunc("year", F.col("time")))
    d = rasters.fuse(d, [*BANDS, "qa_radsat"], ["tile", "y", "x", "time"], "scene")
    return pipelines.annual_composite(d, BANDS, KEY, least=2)


_QUARTER = "date_trunc('quarter', time)"


@query(f"WITH {cte('px_obs')} SELECT tile, y, x, CAST({_QUARTER} AS DATE) AS q, coalesce(arg_min(qa_pixel, scene) FILTER (qa_pixel NOT IN (0, 1)), arg_max(qa_pixel, scene)) AS qa_pixel, {many(BANDS, 'coalesce(arg_min($, scene) FILTER ($ <> 0), 0) AS $')} FROM px_obs GROUP BY ALL")
def fuse_solar_day(spark, sf_dir):
    d = obs(spark, sf_dir).withColumn("q", F.date_trunc("quarter", "time").cast("date"))
    return rasters.fuse(d, BANDS, ["tile", "y", "x", "q"], "scene")


_LON = "CASE WHEN x < 25 THEN 156e0 + x ELSE x - 204e0 END"  # 25 columns on either side of the antimeridian


@query(f"WITH {cte('px_obs')}, p AS (SELECT *, {_LON} AS lon FROM px_obs), d AS (SELECT *, CAST(time + to_seconds(lon * 240) AS DATE) AS day FROM p WHERE (lon >= 17e1 OR lon <= -175e0) AND y BETWEEN 0 AND 2) SELECT y, x, day, coalesce(arg_min(qa_pixel, (time, scene)) FILTER (qa_pixel NOT IN (0, 1)), arg_max(qa_pixel, (time, scene))) AS qa_pixel, {many(BANDS[:2], 'coalesce(arg_min($, (time, scene)) FILTER ($ <> 0), 0) AS $')} FROM d GROUP BY y, x, day")
def load_scenes(spark, sf_dir):
    lon = F.when(F.col("x") < 25, F.col("x") + 156.0).otherwise(F.col("x") - 204.0)
    d = obs(spark, sf_dir).withColumns({"lon": lon, "lat": F.col("y").cast("double"), "time": F.col("time").cast("timestamp")})
    return rasters.load(d, BANDS[:2], (170.0, 0.0, -175.0, 2.0), ["y", "x"], order=["scene"])


@query(f"WITH {cte('scenes')} SELECT concat(platform, '-', CASE WHEN sensor % 3 = 0 THEN 'T1' ELSE 'T2' END) AS scene_group, CAST(count(*) AS BIGINT) AS n FROM scenes GROUP BY 1")
def scene_counts(spark, sf_dir):
    tier = F.when(F.col("sensor") % 3 == 0, "T1").otherwise("T2")
    return adapter(spark, sf_dir, "scenes").groupBy(F.concat("platform", F.lit("-"), tier).alias("scene_group")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {cte('scenes')}, e AS (SELECT sensor % 50 AS tile, count(DISTINCT CAST(time AS DATE)) AS n FROM scenes GROUP BY 1) SELECT e.tile, CAST(count(*) AS BIGINT) AS scenes FROM scenes s JOIN e ON s.sensor % 50 = e.tile WHERE e.n >= 10 GROUP BY e.tile")
def min_timesteps(spark, sf_dir):
    d = adapter(spark, sf_dir, "scenes").select((F.col("sensor") % 50).alias("tile"), F.to_date("time").alias("time"))
    return geomad.require_timesteps(d, KEY, 10).groupBy("tile").agg(F.count(F.lit(1)).alias("scenes"))


@query(f"WITH {cte('px_obs')}, s AS (SELECT tile, y, min(time) AS a, max(time) AS b FROM px_obs GROUP BY tile, y) SELECT tile, y, concat(CAST(year(a) AS VARCHAR), '-01-01T00:00:00.000Z') AS start_datetime, concat(CAST(CAST(floor((year(a) + year(b)) / 2) AS INT) AS VARCHAR), '-06-30T00:00:00.000Z') AS datetime, concat(CAST(year(b) AS VARCHAR), '-12-31T23:59:59.000Z') AS end_datetime FROM s")
def stac_interval(spark, sf_dir):
    s = obs(spark, sf_dir).groupBy("tile", "y").agg(F.min("time").alias("a"), F.max("time").alias("b"))
    return s.select("tile", "y", *[v.alias(k) for k, v in C.year_bounds("a", "b").items()])


# --- classes

def _map_sql(code: str, mapping: dict) -> str:
    return f"coalesce(CASE {code} " + " ".join(f"WHEN {c} THEN {cls}" for cls, codes in mapping.items() for c in codes) + " END, 255)"


_PRODUCTS = {"wc": ("wc_code", reclass.WORLDCOVER), "cci": ("cci_code", reclass.CCI), "io": ("io_code", reclass.IO)}
_LAYERS = "layers AS (SELECT tile, pixel, y, x, part_of, elevation, " + ", ".join(f"{_map_sql(c, m)} AS {p}" for p, (c, m) in _PRODUCTS.items()) + " FROM px_grid)"
_GRID = f"WITH {cte('px_grid')}, {_LAYERS}"
_WCQ = "((CASE WHEN q1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN q2 > 0 THEN 1 ELSE 0 END) + (CASE WHEN q3 > 0 THEN 1 ELSE 0 END) >= 2 OR (q1 < 0 AND q2 < 0 AND q3 < 0))"


def layers(spark, sf_dir):
    d = adapter(spark, sf_dir, "px_grid")
    return d.select("tile", "pixel", "y", "x", "part_of", "elevation", *[reclass.standardise(c, m).alias(p) for p, (c, m) in _PRODUCTS.items()])


def _reclass(product):
    @query(f"{_GRID} SELECT pixel, {product} AS class FROM layers", name=f"reclass_{product}")
    def run(spark, sf_dir):
        return layers(spark, sf_dir).select("pixel", F.col(product).alias("class"))


for _p in _PRODUCTS:
    _reclass(_p)


@query(f"WITH {cte('px_grid')} SELECT pixel, {_WCQ} AS ok FROM px_grid")
def wc_quality(spark, sf_dir):
    return adapter(spark, sf_dir, "px_grid").select("pixel", reclass.worldcover_quality("q1", "q2", "q3").alias("ok"))


@query(f"WITH {cte('px_grid')}, f AS (SELECT part_of, max(CASE WHEN processed = 1 AND changes = 0 AND observations >= 3 THEN 1 ELSE 0 END) AS a FROM px_grid GROUP BY 1) SELECT pixel, CASE WHEN a = 1 THEN processed = 1 AND changes = 0 AND observations >= 3 ELSE processed = 1 AND changes = 0 AND observations >= 1 END AS ok FROM px_grid JOIN f USING (part_of)")
def cci_quality_fallback(spark, sf_dir):
    return reclass.cci_quality_rows(adapter(spark, sf_dir, "px_grid"), "processed", "changes", "observations", ["part_of"]).select("pixel", "ok")


@query(f"WITH {cte('px_grid')} SELECT pixel, CASE WHEN {_WCQ} AND x BETWEEN 5 AND 44 THEN {_map_sql('wc_code', reclass.WORLDCOVER)} ELSE 255 END AS class FROM px_grid")
def prepared_layer(spark, sf_dir):
    d = adapter(spark, sf_dir, "px_grid")
    return reclass.prepare(d, "wc_code", reclass.WORLDCOVER, "class", reclass.worldcover_quality("q1", "q2", "q3"), F.col("x").between(5, 44)).select("pixel", "class")


@query("SELECT * FROM (VALUES " + ", ".join(f"({v}, '{a}', '{b}')" for v, (a, b) in reclass.CLASSES.items()) + ") t(value, label, color)")
def class_table(spark, sf_dir):
    return reclass.class_table(spark)


_AGREE = "CASE WHEN wc = cci OR wc = io THEN wc WHEN cci = io THEN cci ELSE 255 END"
_FLAG = "CASE WHEN (wc = cci OR cci = io OR wc = io) AND (CASE WHEN wc > 0 THEN 1 ELSE 0 END + CASE WHEN cci > 0 THEN 1 ELSE 0 END + CASE WHEN io > 0 THEN 1 ELSE 0 END) >= 2 THEN 1 ELSE 0 END"


@query(f"{_GRID} SELECT pixel, {_AGREE} AS majority, {_FLAG} AS agree FROM layers")
def agreement_2of3(spark, sf_dir):
    return layers(spark, sf_dir).select("pixel", compare.agreement().alias("majority"), compare.agreement_flag().alias("agree"))


@query(f"{_GRID}, a AS (SELECT tile, pixel, y, x, {_AGREE} AS majority, {_FLAG} AS agree FROM layers), n AS (SELECT p.pixel, count(*) AS k, min(q.agree) AS low FROM a p JOIN a q ON p.tile = q.tile AND q.y BETWEEN p.y - 1 AND p.y + 1 AND q.x BETWEEN p.x - 1 AND p.x + 1 GROUP BY p.pixel) SELECT a.pixel, CASE WHEN k = 9 AND low = 1 AND majority > 0 THEN majority ELSE 255 END AS stable FROM a JOIN n ON a.pixel = n.pixel")
def agreement_eroded(spark, sf_dir):
    return compare.eroded_agreement(layers(spark, sf_dir), KEY).select("pixel", "stable")


# --- neighbourhoods

_EDGE = "b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM layers), o AS (SELECT * FROM (VALUES (-2), (-1), (0), (1), (2)) t(d))"
_AROUND = "JOIN layers q ON q.tile = p.tile AND q.x = least(greatest(p.x + dx.d, b.x0), b.x1) AND q.y = least(greatest(p.y + dy.d, b.y0), b.y1)"


@query(f"{_GRID}, {_EDGE} SELECT p.pixel, CASE WHEN sum(CASE WHEN q.wc <> 255 AND q.cci <> 255 THEN 1 ELSE 0 END) = 0 THEN NULL ELSE round(sum(CASE WHEN q.wc <> 255 AND q.cci <> 255 AND q.wc = q.cci THEN 1 ELSE 0 END) / sum(CASE WHEN q.wc <> 255 AND q.cci <> 255 THEN 1 ELSE 0 END) * 100, 5) END AS share FROM layers p, b, o dx, o dy {_AROUND.replace('JOIN layers q ON', ', layers q WHERE')} GROUP BY p.pixel")
def local_agreement_5x5(spark, sf_dir):
    return _local(spark, sf_dir).select("pixel", F.when(~F.isnan("share"), F.round("share", 5)).alias("share"))


def _local(spark, sf_dir):
    d = layers(spark, sf_dir).withColumns({"hit": (F.col("wc") == F.col("cci")).cast("int"), "valid": ((F.col("wc") != 255) & (F.col("cci") != 255)).cast("int")})
    return focal.local_share(d, "hit", "valid", "share", KEY)


_HET = f"het AS (SELECT p.pixel, p.wc, count(DISTINCT CASE WHEN q.wc < 255 THEN q.wc END) AS kinds FROM layers p, b, o dx, o dy {_AROUND.replace('JOIN layers q ON', ', layers q WHERE')} GROUP BY p.pixel, p.wc)"


def _classes(spark, sf_dir):
    d = layers(spark, sf_dir).withColumn("v", F.when(F.col("wc") < 255, F.col("wc")).otherwise(0))
    return focal.heterogeneity(d, "v", "kinds", KEY)


@query(f"{_GRID}, {_EDGE}, {_HET} SELECT pixel, CASE WHEN kinds > 0 THEN CAST(kinds AS DOUBLE) END AS kinds FROM het")
def heterogeneity_5x5(spark, sf_dir):
    return _classes(spark, sf_dir).select("pixel", F.when(~F.isnan("kinds"), F.col("kinds")).alias("kinds"))


_SOBEL = "".join(f", max(CASE WHEN dy.d = {j} AND dx.d = {i} THEN q.elevation END) AS z{j + 1}{i + 1}" for j in (-1, 0, 1) for i in (-1, 0, 1))


@query(f"{_GRID}, b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM layers), o AS (SELECT * FROM (VALUES (-1), (0), (1)) t(d)), n AS (SELECT p.pixel{_SOBEL} FROM layers p, b, o dx, o dy {_AROUND.replace('JOIN layers q ON', ', layers q WHERE')} GROUP BY p.pixel), g AS (SELECT pixel, ((z02 - z00) + 2 * (z12 - z10) + (z22 - z20)) / 240 AS dx, ((z20 + 2 * z21 + z22) - (z00 + 2 * z01 + z02)) / 240 AS dy FROM n), t AS (SELECT pixel, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope, 90 - degrees(atan2(-dy, dx)) AS turn FROM g) SELECT pixel, round(slope, 5) AS slope, round(CASE WHEN turn < 0 THEN turn + 360 ELSE turn END, 4) % 360 AS aspect FROM t")
def terrain(spark, sf_dir):
    d = focal.terrain(layers(spark, sf_dir), "elevation", 30.0, KEY)
    return d.select("pixel", F.round("slope", 5).alias("slope"), (F.round("aspect", 4) % 360).alias("aspect"))


def _disk_sql(radius: int) -> str:
    w = focal.disk_widths(radius)
    return "(VALUES " + ", ".join(f"({j}, {i})" for j in w for i in range(-w[j], w[j] + 1)) + ") t(j, i)"


def _morph(name: str, of: str, radius: int, f: str) -> str:
    at = f"(SELECT tile, y - j AS y, x - i AS x, m FROM {of}, {_disk_sql(radius)})"
    return f"{name}n AS MATERIALIZED (SELECT tile, y, x, {f}(m) AS m FROM {at} GROUP BY tile, y, x), {name} AS MATERIALIZED (SELECT p.tile, p.pixel, p.y, p.x, n.m AS m FROM {of} p JOIN {name}n n ON n.tile = p.tile AND n.y = p.y AND n.x = p.x)"


@query(f"WITH {cte('px_grid')}, s0 AS (SELECT tile, pixel, y, x, CASE WHEN wc_code IN (50, 80) OR io_code = 5 THEN 1 ELSE 0 END AS m FROM px_grid), {_morph('s1', 's0', 3, 'min')}, {_morph('s2', 's1', 3, 'max')}, {_morph('s3', 's2', 5, 'max')}, {_morph('s4', 's3', 2, 'min')} SELECT pixel, m AS mask FROM s4")
def cloud_morphology(spark, sf_dir):
    d = adapter(spark, sf_dir, "px_grid").withColumn("m", (F.col("wc_code").isin(50, 80) | (F.col("io_code") == 5)).cast("int"))
    return focal.clean_mask(d, "m", "mask", KEY).select("pixel", "mask")


# --- comparison

@query(f"{_GRID}, n AS (SELECT tile, CAST(floor(y / 10) AS INT) AS cy, CAST(floor(x / 10) AS INT) AS cx, wc, count(*) AS n FROM layers GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY tile, cy, cx ORDER BY n DESC, wc) AS k FROM n) SELECT tile, cy, cx, wc AS majority FROM r WHERE k = 1")
def majority_resample(spark, sf_dir):
    return compare.majority(layers(spark, sf_dir), "wc", 10, KEY)


@query(f"{_GRID} SELECT tile, CAST(floor(y / 10) AS INT) AS cy, CAST(floor(x / 10) AS INT) AS cx, round(avg(elevation), 5) AS elevation FROM layers GROUP BY ALL")
def decimate(spark, sf_dir):
    return compare.decimate(layers(spark, sf_dir), ["elevation"], 10, KEY).withColumn("elevation", F.round("elevation", 5))


@query(f"{_GRID}, n AS (SELECT tile, CAST(floor(y / 10) AS INT) AS cy, CAST(floor(x / 10) AS INT) AS cx, io, count(*) AS n FROM layers GROUP BY ALL), p AS (SELECT tile, cy, cx, io, CAST(floor(100 * n / sum(n) OVER (PARTITION BY tile, cy, cx)) AS INT) AS p FROM n) SELECT tile, cy, cx, concat('{{', string_agg(concat('\"', CAST(io AS VARCHAR), '\":\"', CAST(p AS VARCHAR), '%\"'), ',' ORDER BY io), '}}') AS mix FROM p GROUP BY tile, cy, cx")
def subclass_mix(spark, sf_dir):
    return compare.class_mix(layers(spark, sf_dir), "io", 10, KEY)


@query(f"{_GRID}, p AS (SELECT pixel AS point, x * 30.0e0 + (pixel % 13) * 2 AS px, 100000 - y * 30.0e0 - (pixel % 11) AS py FROM layers), r AS (SELECT point, CAST(floor(px / 30 + 0.5) AS INT) AS x, CAST(floor((100000 - py) / 30 + 0.5) AS INT) AS y FROM p) SELECT r.point, l.wc FROM r LEFT JOIN layers l ON r.x = l.x AND r.y = l.y")
def nearest_sample(spark, sf_dir):
    d = layers(spark, sf_dir)
    p = d.select(F.col("pixel").alias("point"), (F.col("x") * 30.0 + (F.col("pixel") % 13) * 2).alias("px"), (F.lit(100000) - F.col("y") * 30.0 - F.col("pixel") % 11).alias("py"))
    return compare.nearest_sample(p, d.select("y", "x", "wc"), 0.0, 100000.0, 30.0).select("point", "wc")


@query(f"{_GRID}, n AS (SELECT wc AS source, cci AS target, count(*) AS n FROM layers GROUP BY ALL HAVING count(*) > 10) SELECT source, target, CAST(n AS BIGINT) AS n, CAST(dense_rank() OVER (ORDER BY source) - 1 AS INT) AS source_node, CAST(dense_rank() OVER (ORDER BY target) - 1 AS INT) AS target_node FROM n")
def transitions(spark, sf_dir):
    return compare.transitions(layers(spark, sf_dir), "wc", "cci")


@query(f"{_GRID} " + " UNION ALL ".join(f"SELECT '{p}' AS product, {c} AS class, round(count(*) FILTER ({p} = {c}) * 9e-2, 5) AS km2 FROM layers" for p in _PRODUCTS for c in range(1, 8)))
def class_area(spark, sf_dir):
    return compare.class_area(layers(spark, sf_dir), list(_PRODUCTS), range(1, 8)).withColumn("km2", F.round("km2", 5))


@query(f"{_GRID}, t AS (SELECT count(*) AS t FROM layers WHERE io <> 255) SELECT io AS class, CAST(count(*) AS BIGINT) AS n, round(count(*) / max(t), 6) AS share FROM layers, t WHERE io <> 255 GROUP BY io")
def class_histogram(spark, sf_dir):
    return compare.class_histogram(layers(spark, sf_dir), "io", 255).withColumn("share", F.round("share", 6))


_SHARES = f"shares AS (SELECT p.pixel, p.wc, sum(CASE WHEN q.wc <> 255 AND q.cci <> 255 AND q.wc = q.cci THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN q.wc <> 255 AND q.cci <> 255 THEN 1 ELSE 0 END), 0) * 100 AS share FROM layers p, b, o dx, o dy {_AROUND.replace('JOIN layers q ON', ', layers q WHERE')} GROUP BY p.pixel, p.wc)"


@query(f"{_GRID}, {_EDGE}, {_SHARES}, n AS (SELECT wc AS class, CAST(least(floor(share / 10), 9) AS INT) AS bin, count(*) AS n FROM shares WHERE share IS NOT NULL GROUP BY ALL) SELECT class, bin, CAST(n AS BIGINT) AS n, round(n / (sum(n) OVER (PARTITION BY class) * 10), 6) AS density FROM n")
def agreement_histogram(spark, sf_dir):
    return compare.share_histogram(_local(spark, sf_dir), "wc", "share").withColumn("density", F.round("density", 6))


@query(f"{_GRID}, {_EDGE}, {_HET} SELECT h.kinds AS \"group\", " + ", ".join(f"round(quantile_cont(l.elevation, {q}), 5) AS {n}" for q, n in ((0.0, '"min"'), (0.25, "q1"), (0.5, '"median"'), (0.75, "q3"), (1.0, '"max"'))) + " FROM het h JOIN layers l ON h.pixel = l.pixel WHERE h.kinds > 0 GROUP BY 1")
def agreement_boxplot(spark, sf_dir):
    d = _classes(spark, sf_dir).filter(~F.isnan("kinds")).withColumn("kinds", F.col("kinds").cast("long"))
    d = compare.five_numbers(d, "kinds", "elevation")
    return d.select("group", *[F.round(c, 5).alias(c) for c in ("min", "q1", "median", "q3", "max")])


@query(f"WITH {cte('px_obs')}, o AS (SELECT y * 50 + x AS point, year(time) AS year, max(qa_pixel % 7) AS class FROM px_obs WHERE qa_pixel <> 0 GROUP BY ALL) SELECT point, concat('{{', string_agg(concat('\"', CAST(year AS VARCHAR), '\":', CAST(class AS VARCHAR)), ',' ORDER BY year), '}}') AS classes FROM o GROUP BY point")
def yearly_class_map(spark, sf_dir):
    d = obs(spark, sf_dir).select((F.col("y") * 50 + F.col("x")).alias("point"), F.year("time").alias("year"), F.when(F.col("qa_pixel") != 0, F.col("qa_pixel") % 7).alias("class"))
    return compare.yearly_classes(d, "point", "year", "class")


# --- sampling

def _rank_sql(id_: str) -> str:
    return f"((({id_} % 4294967296 + (({id_} >> 32) % 2147483648) * 40503 + 42) % 4294967296) * 1540483477) % 4294967296"


_RANK = _rank_sql("pixel")


def _stable(spark, sf_dir):
    return layers(spark, sf_dir).filter("wc <> 255").select("pixel", "wc")


_POOL = f"{_GRID}, s AS (SELECT pixel, wc, row_number() OVER (PARTITION BY wc ORDER BY {_RANK}, pixel) AS r, count(*) OVER (PARTITION BY wc) AS have, count(*) OVER () AS total FROM layers WHERE wc <> 255)"


@query(f"{_POOL} SELECT pixel, wc FROM s WHERE r <= CASE WHEN have >= greatest(30.0, 500.0 * have / total) THEN round_even(greatest(30.0e0, 500.0e0 * have / total), 0) ELSE have END")
def sample_stratified(spark, sf_dir):
    return sampling.sample(_stable(spark, sf_dir), "wc", "pixel", n=500, least=30, drop=None)


@query(f"{_POOL}, k AS (SELECT count(DISTINCT wc) AS k FROM s) SELECT pixel, wc FROM s, k WHERE r <= least(floor(400 / k), have)")
def sample_equal(spark, sf_dir):
    return sampling.sample(_stable(spark, sf_dir), "wc", "pixel", "equal_stratified_random", 400, drop=None)


@query(f"{_POOL} SELECT pixel, wc FROM s WHERE r <= least(CASE wc WHEN 1 THEN 40 WHEN 3 THEN 15 ELSE 0 END, have)")
def sample_manual(spark, sf_dir):
    return sampling.sample(_stable(spark, sf_dir), "wc", "pixel", "manual", manual={"1": 40, "3": 15}, drop=None)


@query(f"{_GRID} SELECT pixel, wc FROM layers WHERE wc <> 255 ORDER BY {_RANK}, pixel LIMIT 100")
def sample_random(spark, sf_dir):
    return sampling.sample(_stable(spark, sf_dir), "wc", "pixel", "random", 100, drop=None)


_SPLIT = f"WITH {SAMPLES_CTE}, r AS (SELECT id, lulc, row_number() OVER (PARTITION BY lulc ORDER BY {_rank_sql('id')}, id) AS r, count(*) OVER (PARTITION BY lulc) AS n FROM samples)"


@query(f"{_SPLIT} SELECT id, lulc, r <= floor(7e-1 * n) AS train FROM r")
def stratified_split(spark, sf_dir):
    return sampling.stratified_split(samples(spark, sf_dir), "lulc", "id").select("id", "lulc", "train")


@query(f"{_GRID}, {_EDGE}, {_SHARES} SELECT pixel, wc FROM shares WHERE share > CASE WHEN wc IN (1, 5, 6, 7) THEN 95 WHEN wc IN (2, 3, 4) THEN 80 END AND share + 1 > CASE WHEN wc IN (1, 5, 6, 7) THEN 95 WHEN wc IN (2, 3, 4) THEN 80 END")
def select_training(spark, sf_dir):
    d = _local(spark, sf_dir).filter(~F.isnan("share")).withColumn("other", F.col("share") + 1)
    return sampling.training_pixels(d, "wc", "share", "other").select("pixel", "wc")


# --- learning

_STATS = f"WITH {SAMPLES_CTE}, st AS (SELECT {many(FEATURES, 'avg($) AS m$, stddev_pop($) AS s$')} FROM samples)"


@query(f"{_STATS} SELECT id, {many(FEATURES, 'round(($ - m$) / s$, 6) AS $')} FROM samples, st")
def standardise_features(spark, sf_dir):
    return ml.standardise(samples(spark, sf_dir), FEATURES).select("id", *[F.round(f, 6).alias(f) for f in FEATURES])


@query(f"WITH {SAMPLES_CTE}, c AS (SELECT lulc, {many(FEATURES, 'avg($) AS c$')}, count(*) AS n FROM samples GROUP BY lulc), d AS (SELECT id, s.lulc, n, sqrt({many(FEATURES, '($ - c$) * ($ - c$)', ' + ')}) AS distance FROM samples s JOIN c ON s.lulc = c.lulc), r AS (SELECT *, row_number() OVER (PARTITION BY lulc ORDER BY distance DESC, id) AS r FROM d) SELECT id, lulc, round(distance, 6) AS distance, r <= greatest(1, floor(5e-2 * n)) AS outlier FROM r")
def outlier_topk(spark, sf_dir):
    d = ml.class_centroid_distance(samples(spark, sf_dir), "lulc", FEATURES)
    return sampling.worst(d, "lulc", "distance", "id").select("id", "lulc", F.round("distance", 6).alias("distance"), "outlier")


@query()
def kmeans_outliers(spark, sf_dir):
    d = ml.kmeans_distance(ml.standardise(samples(spark, sf_dir), FEATURES), "lulc", FEATURES)
    return sampling.worst(d, "lulc", "distance", "id").filter(~F.col("outlier")).select("id", "lulc", F.round("distance", 6).alias("distance"))


def _forest(spark, sf_dir):
    d = sampling.stratified_split(samples(spark, sf_dir), "lulc", "id")
    return d, ml.train_forest(d.filter("train"), "lulc", FEATURES, trees=50, depth=8)


@query()
def rf_train_predict(spark, sf_dir):
    d, model = _forest(spark, sf_dir)
    return ml.predict(d.filter(~F.col("train")), model, FEATURES).select("id", "lulc", "classification", "classification_unfiltered", "classification_probability")


@query()
def rf_importance(spark, sf_dir):
    return ml.importances(spark, _forest(spark, sf_dir)[1])


_RULE = "CASE WHEN f0 > 0 THEN (lulc + CASE WHEN f1 > 0.1e0 THEN 1 ELSE 0 END) % 10 ELSE lulc END"


@query(f"WITH {SAMPLES_CTE}, p AS (SELECT lulc AS t, {_RULE} AS g FROM samples), c AS (SELECT DISTINCT t AS class FROM p UNION SELECT DISTINCT g FROM p), s AS (SELECT class, (SELECT count(*) FROM p WHERE t = class) AS support, (SELECT count(*) FROM p WHERE g = class) AS called, (SELECT count(*) FROM p WHERE t = class AND g = class) AS hit FROM c), r AS (SELECT class, coalesce(hit / nullif(called, 0), 0) AS a, coalesce(hit / nullif(support, 0), 0) AS b, support FROM s) SELECT class, round(a, 6) AS \"precision\", round(b, 6) AS recall, round(coalesce(2 * a * b / nullif(a + b, 0), 0), 6) AS f1, CAST(support AS BIGINT) AS support FROM r")
def classification_report(spark, sf_dir):
    d = samples(spark, sf_dir).withColumn("guess", F.expr(_RULE.replace("0.1e0", "0.1D")))
    return ml.classification_report(d, "lulc", "guess").select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(f"WITH {SAMPLES_CTE}, p AS (SELECT id, lulc, CAST(floor(abs(f0) * 100) AS INT) AS pc FROM samples) SELECT id, pc AS percent, CASE WHEN pc >= 10 THEN 1 ELSE 0 END AS sure, CASE WHEN pc >= 10 THEN lulc ELSE 255 END AS class FROM p")
def probability_threshold(spark, sf_dir):
    d = samples(spark, sf_dir).withColumn("percent", C.whole_percent(F.abs("f0")))
    return d.select("id", "percent", C.probability_binary("percent", 10).alias("sure"), C.confident_class("lulc", F.col("percent"), 10).alias("class"))


_PAIRS = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i + 1 :]]


@query(f"WITH {SAMPLES_CTE}, c AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS correlation FROM samples" for a, b in _PAIRS) + ") SELECT a, b, round(correlation, 6) AS correlation FROM c WHERE abs(correlation) > 2e-2")
def feature_correlation(spark, sf_dir):
    return ml.correlated_pairs(samples(spark, sf_dir), FEATURES, 0.02).withColumn("correlation", F.round("correlation", 6))


@query(f"WITH {SAMPLES_CTE} SELECT id FROM samples WHERE f0 >= 0 OR f0 < 0")
def drop_missing(spark, sf_dir):
    return ml.drop_missing(samples(spark, sf_dir), FEATURES).select("id")


# --- tasks, items, tiles

@query(f"WITH {cte('countries')} SELECT name AS id, CAST(y AS VARCHAR) AS year, region FROM countries, (SELECT DISTINCT year(o_orderdate) AS y FROM orders) t")
def plan_tasks(spark, sf_dir):
    years = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.year("o_orderdate").alias("year")).distinct()
    return grid.plan_tasks(adapter(spark, sf_dir, "countries").withColumnRenamed("name", "label"), years)


_KEY_SQL = "concat(CASE WHEN region = 'pacific' THEN 'dep' ELSE 'ci' END, '_ls_geomad/0-2-0/', lpad(CAST(tx AS VARCHAR), 3, '0'), '/', lpad(CAST(ty AS VARCHAR), 3, '0'), '/', year, '/', CASE WHEN region = 'pacific' THEN 'dep' ELSE 'ci' END, '_ls_geomad_', lpad(CAST(tx AS VARCHAR), 3, '0'), '_', lpad(CAST(ty AS VARCHAR), 3, '0'), '_', year, '.stac-item.json')"


def _keys(d):
    return C.item_key(C.owner_prefix("region"), "ls", "geomad", "0.2.0", "tx", "ty", "year")


@query(f"WITH {cte('tasks')} SELECT task, {_KEY_SQL} AS key FROM tasks")
def stac_keys(spark, sf_dir):
    d = adapter(spark, sf_dir, "tasks")
    return d.select("task", _keys(d).alias("key"))


@query(f"WITH {cte('tasks')}, k AS (SELECT *, {_KEY_SQL} AS key FROM tasks) SELECT task, id, year, region FROM k WHERE key NOT IN (SELECT key FROM k WHERE task % 3 = 0)")
def filter_tasks(spark, sf_dir):
    d = adapter(spark, sf_dir, "tasks")
    done = d.filter("task % 3 = 0").select(_keys(d).alias("key"))
    return grid.unfinished(d, _keys(d), done, "key").select("task", "id", "year", "region")


@query(f"WITH {cte('tasks')} SELECT task, CASE WHEN CAST(year AS INT) <= 2012 THEN concat(CAST(CAST(year AS INT) - 1 AS VARCHAR), '/', CAST(CAST(year AS INT) + 1 AS VARCHAR)) ELSE year END AS search, NOT (CAST(year AS INT) <= 2012 AND region = 'pacific') AS first_tier, CASE WHEN region = 'pacific' THEN 'dep' ELSE 'ci' END AS owner FROM tasks")
def search_window(spark, sf_dir):
    return adapter(spark, sf_dir, "tasks").select("task", C.search_window("year").alias("search"), C.tier_filter("year", "region").alias("first_tier"), C.owner_prefix("region").alias("owner"))


@query(f"WITH {cte('tasks')} SELECT task, tx AS x, ty AS y FROM tasks")
def tile_ids(spark, sf_dir):
    d = adapter(spark, sf_dir, "tasks").withColumn("t", C.tile_id_parts("id"))
    return d.select("task", F.col("t.x").cast("long").alias("x"), F.col("t.y").cast("long").alias("y"))


@query(f"WITH {cte('items')} SELECT id FROM items WHERE west <= 60 AND east >= -20 AND south <= 30 AND north >= -30 AND \"start\" >= TIMESTAMP '1995-01-01' AND \"start\" <= TIMESTAMP '1996-12-31' AND tier = 'T1'")
def item_search(spark, sf_dir):
    return catalog.search(adapter(spark, sf_dir, "items"), (-20, -30, 60, 30), "1995-01-01", "1996-12-31", ["T1"], end="start").select("id")


@query(f"WITH {cte('items')} SELECT id, concat(href, CASE WHEN id % 2 = 0 THEN '?v=2' ELSE '' END) AS href FROM items")
def self_link(spark, sf_dir):
    link = lambda rel, href: F.struct(F.lit(rel).alias("rel"), href.alias("href"))
    second = F.when(F.col("id") % 2 == 0, F.concat("href", F.lit("?v=2"))).otherwise(F.col("href"))
    links = F.array(link("self", F.col("href")), link("root", F.lit("https://example.com")), link("self", second))
    return adapter(spark, sf_dir, "items").select("id", C.self_link(links).alias("href"))


_TX = "CAST(greatest(0, least(31, floor(($ + 180.0e0) / 360.0e0 * 32))) AS BIGINT)"
_TY = "CAST(greatest(0, least(31, floor((1 - ln(tan(radians($)) + 1 / cos(radians($))) / pi()) / 2 * 32))) AS BIGINT)"
_QK = "concat(" + ", ".join(f"CAST(((tx >> {b}) & 1) + 2 * ((ty >> {b}) & 1) AS VARCHAR)" for b in (4, 3, 2, 1, 0)) + ")"


@query(f"WITH {cte('items')}, a AS (SELECT href, unnest(range({_TX.replace('$', 'west')}, {_TX.replace('$', 'east')} + 1)) AS tx, north, south FROM items), b AS (SELECT href, tx, unnest(range({_TY.replace('$', 'north')}, {_TY.replace('$', 'south')} + 1)) AS ty FROM a) SELECT {_QK} AS quadkey, string_agg(DISTINCT href, ',' ORDER BY href) AS assets FROM b GROUP BY 1")
def mosaic_index(spark, sf_dir):
    return mosaic.mosaic_index(adapter(spark, sf_dir, "items")).withColumn("assets", F.array_join("assets", ","))


_MOSAICS = "m AS (SELECT DISTINCT o_orderstatus AS dataset, CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders)"


@query(f"WITH {_MOSAICS}, e AS (SELECT * FROM m UNION ALL SELECT 'all', year FROM m) SELECT dataset, string_agg(DISTINCT year, ',' ORDER BY year) AS years, max(year) AS default_year FROM e GROUP BY dataset")
def viewer_config(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderstatus").alias("dataset"), F.year("o_orderdate").cast("string").alias("year")).distinct()
    return mosaic.viewer_config(d).withColumn("years", F.array_join("years", ","))


_TILES = f"tiles AS (SELECT name, region, nation, unnest(range(CAST(floor((x0 + 2e7) / 96000) AS BIGINT), CAST(floor((x1 + 2e7) / 96000) AS BIGINT) + 1)) AS ix, y0, y1 FROM countries), t2 AS (SELECT name, region, nation, ix, unnest(range(CAST(floor((y0 + 1e7) / 96000) AS BIGINT), CAST(floor((y1 + 1e7) / 96000) AS BIGINT) + 1)) AS iy FROM tiles)"


@query(f"WITH {cte('countries')}, {_TILES} SELECT name, concat(CAST(ix AS VARCHAR), '_', CAST(iy AS VARCHAR)) AS label FROM t2")
def tiles_for_country(spark, sf_dir):
    return grid.tiles_of_boxes(adapter(spark, sf_dir, "countries")).select("name", "label")


@query(f"WITH {cte('countries')}, {_TILES}, r AS (SELECT *, row_number() OVER (PARTITION BY ix, iy ORDER BY nation) AS r FROM t2) SELECT concat(CAST(ix AS VARCHAR), '_', CAST(iy AS VARCHAR)) AS label, name, region FROM r WHERE r = 1")
def tile_dedupe(spark, sf_dir):
    return grid.grid_tiles(adapter(spark, sf_dir, "countries"), "nation").select("label", "name", "region")


@query(f"WITH {cte('items')}, b AS (SELECT id, CASE WHEN id % 4 = 0 THEN east ELSE west END AS w, CASE WHEN id % 4 = 0 THEN west ELSE east END AS e FROM items) SELECT id, w AS west, CASE WHEN w > e THEN 180.0e0 ELSE e END AS east FROM b UNION ALL SELECT id, -180.0e0, e FROM b WHERE w > e")
def antimeridian_split(spark, sf_dir):
    d = adapter(spark, sf_dir, "items")
    odd = F.col("id") % 4 == 0
    d = d.select("id", F.when(odd, F.col("east")).otherwise(F.col("west")).alias("west"), F.when(odd, F.col("west")).otherwise(F.col("east")).alias("east"))
    return grid.split_boxes(d)


_E = 0.0818191908426215
_CEA_K = math.cos(math.pi / 6) / math.sqrt(1 - (_E * 0.5) ** 2)


_METRES = f"s AS (SELECT id, west, sin(radians(south)) AS s FROM items), q AS (SELECT id, radians(west) * {6378137.0 * _CEA_K!r}e0 AS px, {6378137.0 / (2 * _CEA_K)!r}e0 * {1 - _E * _E!r}e0 * (s / (1 - {_E * _E!r}e0 * s * s) - {1 / (2 * _E)!r}e0 * ln((1 - {_E!r}e0 * s) / (1 + {_E!r}e0 * s))) AS py FROM s)"
_PIXELS = "z AS (SELECT id, CAST(floor((px + 2e7) / 96000) AS INT) AS ix, CAST(floor((py + 1e7) / 96000) AS INT) AS iy, px, py FROM q), k AS (SELECT id, ix, iy, CAST(floor((iy * 96000e0 + 96000 - 1e7 - py) / 30) AS INT) AS y, CAST(floor((px + 2e7 - ix * 96000e0) / 30) AS INT) AS x FROM z)"


@query(f"WITH {cte('items')}, {_METRES}, {_PIXELS}, l AS (SELECT ix, iy, y, x, CAST(min(id) % 9 AS INT) AS lulc FROM k WHERE id % 3 = 0 GROUP BY ALL) SELECT k.id, l.lulc, CASE WHEN lulc > 0 THEN concat('lulc=', lulc) END AS tip FROM k LEFT JOIN l ON k.ix = l.ix AND k.iy = l.iy AND k.y = l.y AND k.x = l.x")
def point_lookup(spark, sf_dir):
    d = adapter(spark, sf_dir, "items").select("id", F.col("west").alias("lon"), F.col("south").alias("lat"))
    known = d.filter("id % 3 = 0").withColumns(mosaic.pixel_of("lon", "lat"))
    known = known.groupBy("ix", "iy", "y", "x").agg((F.min("id") % 9).cast("int").alias("lulc"))
    return mosaic.point_values(d, known, ["lulc"]).select("id", "lulc", "tip")


@query(f"WITH {cte('items')}, {_METRES} SELECT id, CAST(floor((px + 2e7) / 96000) AS INT) AS ix, CAST(floor((py + 1e7) / 96000) AS INT) AS iy FROM q")
def tile_assign(spark, sf_dir):
    px, py = C.equal_area("west", "south")
    ix, iy = C.grid_tile(px, py)
    return adapter(spark, sf_dir, "items").select("id", ix.alias("ix"), iy.alias("iy"))


@query(f"{_GRID} SELECT pixel, CASE WHEN wc IN (0, 255) AND cci IN (0, 255) THEN NULL ELSE concat('wc=', CAST(wc AS VARCHAR), ', cci=', CAST(cci AS VARCHAR)) END AS tip FROM layers")
def point_query(spark, sf_dir):
    return layers(spark, sf_dir).select("pixel", C.tooltip(["wc", "cci"], ["wc", "cci"]).alias("tip"))


@query(f"WITH {cte('items')} SELECT id, concat(printf('%.2f', abs(west)), CASE WHEN west < 0 THEN 'W' ELSE 'E' END) AS lon, concat(printf('%.2f', abs(south)), CASE WHEN south < 0 THEN 'S' ELSE 'N' END) AS lat FROM items")
def degree_labels(spark, sf_dir):
    return adapter(spark, sf_dir, "items").select("id", C.degrees_label("west", "E", "W").alias("lon"), C.degrees_label("south", "N", "S").alias("lat"))


@query(f"{_GRID}, w AS (SELECT tile, y, x, wc AS v FROM layers WHERE x < 30), e AS (SELECT tile, y, x, cci AS v FROM layers WHERE x >= 20) SELECT coalesce(w.y, e.y) AS y, coalesce(w.x, e.x) AS x, CASE WHEN w.v <> 0 THEN w.v ELSE coalesce(e.v, w.v) END AS v FROM w FULL JOIN e ON w.y = e.y AND w.x = e.x")
def merge_halves(spark, sf_dir):
    d = layers(spark, sf_dir)
    west, east = d.filter("x < 30").withColumnRenamed("wc", "v"), d.filter("x >= 20").withColumnRenamed("cci", "v")
    return rasters.merge_halves(west, east, ["y", "x"], "v")


@query(f"WITH {cte('px_grid')} SELECT pixel FROM px_grid WHERE x > 10 AND x < 30 AND y > 5 AND y < 25 AND x + y < 45")
def polygon_clip(spark, sf_dir):
    ring = [(10.0, 5.0), (30.0, 5.0), (30.0, 15.0), (20.0, 25.0), (10.0, 25.0)]
    d = adapter(spark, sf_dir, "px_grid").filter("x > 10 AND x < 30 AND y > 5 AND y < 25 AND x + y <> 45")
    return d.filter(grid.in_polygon([ring])("x", "y")).select("pixel")


@query(f"WITH {cte('countries')}, e AS (SELECT (min(x0) + max(x0)) / 2 AS cx, (min(y0) + max(y0)) / 2 AS cy, greatest(max(x0) - min(x0), max(y0) - min(y0), 5e4) * 1.1e0 AS extent FROM countries) SELECT cx, cy, round(extent, 4) AS extent, (SELECT max(b) FROM (VALUES (1e3), (5e3), (1e4), (25e3), (5e4), (1e5), (25e4), (5e5)) t(b) WHERE b <= extent / 4) AS bar FROM e")
def map_extent(spark, sf_dir):
    return grid.map_extent(adapter(spark, sf_dir, "countries"), "x0", "y0").withColumn("extent", F.round("extent", 4))


@query(f"{_GRID}, p AS (SELECT pixel, x + 2.5e-1 AS fx, y + 5e-1 AS fy FROM layers WHERE x < 49 AND y < (SELECT max(y) FROM layers)), c AS (SELECT p.pixel, l.elevation AS v, (1 - abs(fx - l.x)) * (1 - abs(fy - l.y)) AS w FROM p JOIN layers l ON l.x IN (CAST(floor(fx) AS INT), CAST(floor(fx) AS INT) + 1) AND l.y IN (CAST(floor(fy) AS INT), CAST(floor(fy) AS INT) + 1)) SELECT pixel, round(sum(w * v) / sum(w), 5) AS elevation FROM c GROUP BY pixel")
def bilinear_resample(spark, sf_dir):
    d = layers(spark, sf_dir)
    last = d.agg(F.max("y")).first()[0]
    p = d.filter((F.col("x") < 49) & (F.col("y") < last)).select("pixel", (F.col("x") + 0.25).alias("fx"), (F.col("y") + 0.5).alias("fy"))
    return grid.bilinear(d, p, "elevation", "elevation").select("pixel", F.round("elevation", 5).alias("elevation"))


@query(f"WITH {cte('items')}, {cte('countries')}, p AS (SELECT id, west * 10000 AS x, south * 10000 AS y FROM items) SELECT p.id, c.name FROM p LEFT JOIN countries c ON p.x BETWEEN c.x0 AND c.x1 AND p.y BETWEEN c.y0 AND c.y1")
def region_join(spark, sf_dir):
    p = adapter(spark, sf_dir, "items").select("id", (F.col("west") * 10000).alias("x"), (F.col("south") * 10000).alias("y"))
    b = adapter(spark, sf_dir, "countries").select("name", F.col("x0").alias("west"), F.col("y0").alias("south"), F.col("x1").alias("east"), F.col("y1").alias("north"))
    return grid.join_regions(p, b).select("id", "name")


@query(f"WITH {cte('px_grid')}, c AS (SELECT least(CAST(floor((1 - (y + 5e-1) / 50) * 16) AS INT), 15) AS yy, CAST(floor((x + 5e-1) / 50 * 16) AS INT) AS col, pixel, red FROM px_grid WHERE y < 50), r AS (SELECT yy AS \"row\", col, arg_min(red, pixel) AS red FROM c GROUP BY ALL) SELECT \"row\", col, red, CAST(floor((greatest(7000e0, least(40000e0, red)) - 7000) / 33000 * 255) AS INT) AS byte FROM r")
def tile_render(spark, sf_dir):
    d = adapter(spark, sf_dir, "px_grid").filter("y < 50").select(((F.col("x") + 0.5) / 50).alias("lon"), ((F.col("y") + 0.5) / 50).alias("lat"), "pixel", "red")
    return mosaic.render_tile(d, 0.0, 0.0, 1.0, 1.0, "red", 7000.0, 40000.0, 16, "pixel")


def _beside(ring: list[tuple[float, float]], x0: str, y0: str, x1: str, y1: str) -> str:
    """SQL: a box touches a convex, counterclockwise ring: no side of either has all of the other beyond it."""
    xs, ys = zip(*ring, strict=True)
    told = [f"{x1} >= {min(xs)!r}e0", f"{x0} <= {max(xs)!r}e0", f"{y1} >= {min(ys)!r}e0", f"{y0} <= {max(ys)!r}e0"]
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
        dx, dy = bx - ax, by - ay
        x, y = x0 if dy > 0 else x1, y1 if dx > 0 else y0  # the box's corner that is farthest to the left of the edge
        told.append(f"{dx!r}e0 * ({y} - {ay!r}e0) - {dy!r}e0 * ({x} - {ax!r}e0) >= 0")
    return "(" + " AND ".join(told) + ")"


_COUNTRY = [(0.5, 0.25), (500_000.5, 100_000.25), (200_000.5, 600_000.25)]
_PATCH = [(10.3, 5.2), (31.1, 7.7), (18.4, 30.6)]


@query(f"WITH t AS (SELECT ix, iy, ix * 96000e0 - 2e7 AS x0, iy * 96000e0 - 1e7 AS y0 FROM range(200, 220) a(ix), range(100, 120) b(iy)) SELECT CAST(ix AS INT) AS ix, CAST(iy AS INT) AS iy, concat(ix, '_', iy) AS label FROM t WHERE {_beside(_COUNTRY, 'x0', 'y0', '(x0 + 96000)', '(y0 + 96000)')}")
def tiles_of_polygon(spark, sf_dir):
    return grid.tiles_of_polygon(spark, [_COUNTRY])


@query(f"WITH {cte('px_grid')} SELECT pixel FROM px_grid WHERE {_beside(_PATCH, '(x - 5e-1)', '(y - 5e-1)', '(x + 5e-1)', '(y + 5e-1)')}")
def polygon_touched(spark, sf_dir):
    return grid.clip(adapter(spark, sf_dir, "px_grid"), [_PATCH], 1.0).select("pixel")


def _off(ring: list[tuple[float, float]]) -> str:
    """SQL: the distance of (x, y) from a ring's nearest side."""
    parts = []
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
        dx, dy = bx - ax, by - ay
        t = f"greatest(0e0, least(1e0, ((x - {ax!r}e0) * {dx!r}e0 + (y - {ay!r}e0) * {dy!r}e0) / {dx * dx + dy * dy!r}e0))"
        parts.append(f"sqrt(power(x - {ax!r}e0 - {t} * {dx!r}e0, 2) + power(y - {ay!r}e0 - {t} * {dy!r}e0, 2))")
    return f"least({', '.join(parts)})"


@query(f"WITH {cte('px_grid')} SELECT pixel FROM px_grid WHERE {_beside(_PATCH, 'x', 'y', 'x', 'y')} OR {_off(_PATCH)} <= 35e-1")
def polygon_buffer(spark, sf_dir):
    d = adapter(spark, sf_dir, "px_grid")
    return d.filter(grid.in_polygon([_PATCH], 3.5)("x", "y")).select("pixel")


@query(f"WITH {cte('px_grid')} SELECT pixel FROM px_grid WHERE {_beside(_PATCH, 'x', 'y', 'x', 'y')} OR (x BETWEEN 15 AND 25 AND y BETWEEN 6 AND 12)")
def polygon_union(spark, sf_dir):
    parts = spark.createDataFrame([("a", [_PATCH]), ("a", [[(14.5, 5.5), (25.5, 5.5), (25.5, 12.5), (14.5, 12.5)]])], "country string, rings array<array<struct<x: double, y: double>>>")
    union = grid.merged_polygons(parts, "country", "rings").first()["rings"]  # one country's rings
    return adapter(spark, sf_dir, "px_grid").filter(grid.in_union(union)("x", "y")).select("pixel")


@query(f"WITH {cte('px_grid')} SELECT pixel FROM px_grid WHERE x BETWEEN 12 AND 30 AND y BETWEEN 3 AND 21")
def crop_box(spark, sf_dir):
    return grid.crop(adapter(spark, sf_dir, "px_grid"), 12, 3, 30, 21).select("pixel")


@query(f"WITH {cte('px_grid')} SELECT pixel, x - 15e1 AS west, y - 15e1 AS south, x + 15e1 AS east, y + 15e1 AS north FROM px_grid")
def pixel_squares(spark, sf_dir):
    return adapter(spark, sf_dir, "px_grid").select("pixel", grid.pixel_square("x", "y").alias("s")).select("pixel", "s.*")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN concat('https://h', c_custkey) WHEN c_custkey % 3 = 1 THEN concat('https://data.h', c_custkey, '.org') ELSE concat('https://bucket', c_custkey, '.s3.us-west-2.amazonaws.com') END AS url, concat('s3://b/k', c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE ':2' END) AS s3 FROM customer")
def bucket_urls(spark, sf_dir):
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("https://h"), k)).when(k % 3 == 1, F.concat(F.lit("data.h"), k, F.lit(".org"))).otherwise(F.concat(F.lit("bucket"), k))
    link = F.concat(F.lit("https://x.example.com/k"), k, F.when(k % 2 == 0, ":1").otherwise(":2"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(k.alias("id"), C.bucket_url(name).alias("url"), C.s3_url(link, "https://x.example.com", "b").alias("s3"))


@query(f"{_GRID}, a AS (SELECT tile, y, x, wc FROM layers WHERE x < 35), b AS (SELECT tile, y, x, elevation FROM layers WHERE x > 9) SELECT coalesce(a.y, b.y) AS y, coalesce(a.x, b.x) AS x, wc, elevation FROM a FULL JOIN b ON a.tile = b.tile AND a.y = b.y AND a.x = b.x")
def merged_layers(spark, sf_dir):
    d = layers(spark, sf_dir)
    return rasters.align(d.filter("x < 35").select("tile", "y", "x", "wc"), d.filter("x > 9").select("tile", "y", "x", "elevation"), key=["tile", "y", "x"]).select("y", "x", "wc", "elevation")


@query(f"{_GRID} SELECT pixel, wc, cci, io FROM layers WHERE wc <> 255 AND cci <> 255 AND io <> 255")
def three_products(spark, sf_dir):
    d, key = layers(spark, sf_dir), ["tile", "y", "x"]
    wc, cci, io = (d.filter(F.col(p) != 255).select(*key, *["pixel"] * (p == "wc"), p) for p in ("wc", "cci", "io"))
    return rasters.align(wc, cci, io, key=key, how="inner").select("pixel", "wc", "cci", "io")


@query(f"WITH {cte('items')} SELECT * FROM items WHERE id = (SELECT min(id) FROM items)")
def item_by_id(spark, sf_dir):
    d = adapter(spark, sf_dir, "items")
    return catalog.by_id(d, d.agg(F.min("id")).first()[0])


@query(f"WITH {cte('items')} SELECT id, round(west + 1, 6) AS mean, west + 1 >= 0 AS east FROM items")
def sides_by_ring(spark, sf_dir):
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("west", "south"), corner("east", "south"), corner("east", "north"), corner("west", "north"), corner("west", "south"))
    d = adapter(spark, sf_dir, "items").withColumn("ring", ring)
    return d.select("id", F.round(rasters.ring_longitude("ring"), 6).alias("mean"), (rasters.ring_longitude("ring") >= 0).alias("east"))


@query(f"WITH {cte('px_grid')} SELECT pixel, CASE WHEN x < 49 THEN round(elevation + 25e-2 * (lead(elevation) OVER (PARTITION BY y ORDER BY x) - elevation), 5) END AS elevation FROM px_grid WHERE y < 20 QUALIFY x < 49")
def antimeridian_dem(spark, sf_dir):
    d = adapter(spark, sf_dir, "px_grid").filter("y < 20")
    lon = lambda c: F.when(c > 180, c - 360).otherwise(c)
    east = F.lit(155.0) + F.col("x")  # degrees; 25 columns on either side
    pixels = d.select(lon(east).alias("lon"), F.col("y").cast("double").alias("lat"), "elevation")
    points = d.filter("x < 49").select("pixel", lon(east + 0.25).alias("lon"), F.col("y").cast("double").alias("lat"))
    return rasters.over_antimeridian(pixels, points, "elevation", 1.0).select("pixel", F.round("elevation", 5).alias("elevation"))


@query("SELECT concat('item_', o_orderkey, '_', year(o_orderdate)) AS id FROM orders WHERE year(o_orderdate) = 1996")
def product_items(spark, sf_dir):
    key = F.coalesce(F.col("o_orderkey").cast("string"), F.lit(""))  # the SQL's concat leaves out nulls
    d = spark.read.parquet(f"{sf_dir}/orders.parquet")
    d = d.select(F.concat(F.lit("item_"), key, F.lit("_"), F.year("o_orderdate")).alias("id"), F.lit("2017-01-01").alias("datetime"))
    return catalog.of_product(d, "io", 1996, None).select("id")


@query(f"WITH {SAMPLES_CTE}, v AS (SELECT " + ", ".join(f"CASE WHEN id % {i + 3} = 0 THEN NULL ELSE {f} END AS {f}" for i, f in enumerate(FEATURES)) + " FROM samples) " + " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST(count(*) - count({f}) AS BIGINT) AS missing, round((count(*) - count({f})) / count(*) * 100, 6) AS percent FROM v" for f in FEATURES))
def missing_report(spark, sf_dir):
    d = samples(spark, sf_dir).select(*[F.when(F.col("id") % (i + 3) != 0, F.col(f)).alias(f) for i, f in enumerate(FEATURES)])
    return ml.missing_report(d, FEATURES).withColumn("percent", F.round("percent", 6))


_CONFUSION = f"WITH {SAMPLES_CTE}, p AS (SELECT lulc AS t, {_RULE} AS g FROM samples), c AS (SELECT DISTINCT t AS class FROM p UNION SELECT DISTINCT g FROM p), s AS (SELECT class, (SELECT count(*) FROM p WHERE t = class) AS support, (SELECT count(*) FROM p WHERE g = class) AS called, (SELECT count(*) FROM p WHERE t = class AND g = class) AS hit FROM c), r AS (SELECT coalesce(hit / nullif(called, 0), 0) AS a, coalesce(hit / nullif(support, 0), 0) AS b, support FROM s), f AS (SELECT a AS \"precision\", b AS recall, coalesce(2 * a * b / nullif(a + b, 0), 0) AS f1, support FROM r)"
_SCORES = ("precision", "recall", "f1")


@query(_CONFUSION + " SELECT " + ", ".join(f'round(avg("{c}"), 6) AS macro_{c}, round(sum("{c}" * support) / sum(support), 6) AS weighted_{c}' for c in _SCORES) + ", CAST(sum(support) AS BIGINT) AS support FROM f")
def report_averages(spark, sf_dir):
    d = samples(spark, sf_dir).withColumn("guess", F.expr(_RULE.replace("0.1e0", "0.1D")))
    r = ml.report_averages(ml.classification_report(d, "lulc", "guess"))
    return r.select(*[F.round(f"{k}_{c}", 6).alias(f"{k}_{c}") for c in _SCORES for k in ("macro", "weighted")], F.col("support").cast("long").alias("support"))


_CELLS = "c AS (SELECT least(CAST(floor((1 - (y + 5e-1) / 50) * 16) AS INT), 15) AS yy, least(CAST(floor((x + 5e-1) / 50 * 16) AS INT), 15) AS col, * FROM px_grid WHERE y < 50)"


def _at(d):
    return d.filter("y < 50").withColumns({"lon": (F.col("x") + 0.5) / 50, "lat": (F.col("y") + 0.5) / 50})


@query(f"WITH {cte('px_grid')}, {_CELLS}, r AS (SELECT yy AS \"row\", col, arg_min(red, pixel) AS red, arg_min(nir08 - red, pixel) AS gap FROM c GROUP BY ALL) SELECT *, CAST(floor((greatest(0e0, least(40000e0, red)) - 0) / 40000 * 255) AS INT) AS red_byte, CAST(floor((greatest(0e0, least(40000e0, gap)) - 0) / 40000 * 255) AS INT) AS gap_byte FROM r")
def band_render(spark, sf_dir):
    d = _at(adapter(spark, sf_dir, "px_grid"))
    return mosaic.render_bands(d, 0.0, 0.0, 1.0, 1.0, {"red": F.col("red"), "gap": F.col("nir08") - F.col("red")}, (0.0, 40000.0), 16, "pixel")


_COLORS = {v: color for v, (_, color) in reclass.CLASSES.items()}


@query(f"WITH {cte('px_grid')}, {_CELLS}, r AS (SELECT yy AS \"row\", col, arg_min({_map_sql('wc_code', reclass.WORLDCOVER)}, pixel) AS wc FROM c GROUP BY ALL) SELECT \"row\", col, wc, CASE wc " + " ".join(f"WHEN {v} THEN '{c}'" for v, c in _COLORS.items()) + " END AS color FROM r WHERE wc IN (" + ", ".join(map(str, _COLORS)) + ")")
def class_render(spark, sf_dir):
    return mosaic.render_classes(_at(layers(spark, sf_dir)), 0.0, 0.0, 1.0, 1.0, "wc", _COLORS, 16, "pixel")


@query(f"WITH {cte('px_grid')}, q AS (SELECT quantile_cont(elevation, 0.01) AS a, quantile_cont(elevation, 0.95) AS b FROM px_grid) SELECT pixel, round((greatest(a, least(b, elevation)) - a) / (b - a), 6) AS v FROM px_grid, q")
def percentile_stretch(spark, sf_dir):
    d = compare.percentile_stretch(adapter(spark, sf_dir, "px_grid"), "elevation", 1, 95, "v")
    return d.select("pixel", F.round("v", 6).alias("v"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{c}', '{'pacific' if n in PACIFIC else 'non-pacific'}')" for n, c in list_countries().items()) + ") t(name, code, region)")
def country_regions(spark, sf_dir):
    return country_table(spark)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return median_composite(spark, sf_dir)
