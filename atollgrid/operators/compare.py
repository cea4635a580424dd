"""Comparison of classified products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .focal import minimum_filter


def agreement(wc="wc", cci="cci", io="io") -> Column:
    """A5: the class on which two of three products agree, else 255. Missing ones (255) count as data, as they do in the
    flag's erosion; their agreement is 255 anyway."""
    w, c, i = F.col(wc), F.col(cci), F.col(io)
    return F.when((w == c) | (w == i), w).when(c == i, c).otherwise(F.lit(255))


def agreement_flag(wc="wc", cci="cci", io="io") -> Column:
    w, c, i = F.col(wc), F.col(cci), F.col(io)
    enough = sum(((x > 0).cast("int") for x in (w, c, i)), F.lit(0)) >= 2
    return (((w == c) | (c == i) | (w == i)) & enough).cast("int")


def eroded_agreement(df: DataFrame, key: list[str], wc="wc", cci="cci", io="io") -> DataFrame:
    """A5 with N2: the agreed class where all nine pixels around agree within themselves, else 255."""
    d = df.withColumns({"majority": agreement(wc, cci, io), "agree": agreement_flag(wc, cci, io)})
    d = minimum_filter(d, "agree", "core", key)
    return d.withColumn("stable", F.when((F.col("core") == 1) & (F.col("majority") > 0), F.col("majority")).otherwise(F.lit(255)))


def class_histogram(df: DataFrame, cls: str, drop: int | None = None) -> DataFrame:
    """A4: (class, n, share); the total comes from the few class rows."""
    d = df if drop is None else df.filter(F.col(cls) != drop)
    n = d.groupBy(F.col(cls).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))


def transitions(df: DataFrame, source: str, target: str, over: int = 10) -> DataFrame:
    """(source, target, n, source_node, target_node) of pairs seen more than `over` times; nodes number the classes."""
    d = df.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > over)
    node = lambda c: F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(c)) - 1  # noqa: E731  over class pairs
    return d.withColumns({"source_node": node("source"), "target_node": node("target")})


def class_area(df: DataFrame, products: list[str], classes, pixel_km2: float = 0.09) -> DataFrame:
    """(product, class, km2), all products in one pass."""
    aggs = [F.count_if(F.col(p) == c).alias(f"{p}_{c}") for p in products for c in classes]
    rows = [F.struct(F.lit(p).alias("product"), F.lit(c).alias("class"), (F.col(f"{p}_{c}") * pixel_km2).alias("km2")) for p in products for c in classes]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def share_histogram(df: DataFrame, cls: str, value: str, bins: int = 10, low: float = 0.0, high: float = 100.0) -> DataFrame:
    """Density of value by class in equal bins, the last closed on the right; NaN counts for nothing."""
    d = df.filter(~F.isnan(F.col(value).cast("double")) & F.col(value).between(low, high))
    width = (high - low) / bins
    b = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    n = d.groupBy(F.col(cls).alias("class"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("density", F.col("n") / (F.sum("n").over(Window.partitionBy("class")) * width))


def five_numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, min, q1, median, q3, max) of value, NaN left out."""
    p = F.percentile(F.col(value), F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    d = df.filter(~F.isnan(F.col(value).cast("double"))).groupBy(F.col(group).alias("group")).agg(p.alias("_p"))
    return d.select("group", *[F.col("_p")[i].alias(n) for i, n in enumerate(("min", "q1", "median", "q3", "max"))])


def class_mix(df: DataFrame, cls: str, factor: int, key: list[str]) -> DataFrame:
    """Each coarse cell's classes as JSON {class: whole percent, cut off}."""
    cell = {"cy": F.floor(F.col("y") / factor).cast("int"), "cx": F.floor(F.col("x") / factor).cast("int")}
    n = df.withColumns(cell).groupBy(*key, "cy", "cx", F.col(cls).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    whole = n.withColumn("_p", F.floor(100 * F.col("_n") / F.sum("_n").over(Window.partitionBy(*key, "cy", "cx"))).cast("int"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col("_c"), F.col("_p"))))
    return whole.groupBy(*key, "cy", "cx").agg(F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda s: F.concat(F.lit('"'), s["_c"].cast("string"), F.lit('":"'), s["_p"].cast("string"), F.lit('%"'))), ","), F.lit("}")).alias("mix"))


def majority(df: DataFrame, cls: str, factor: int, key: list[str]) -> DataFrame:
    """The commonest class of each coarse cell, the smallest of equals. Counts are merged before they are compared."""
    n = df.groupBy(*key, F.floor(F.col("y") / factor).cast("int").alias("cy"), F.floor(F.col("x") / factor).cast("int").alias("cx"), cls).agg(F.count(F.lit(1)).alias("_n"))
    return n.groupBy(*key, "cy", "cx").agg(F.max_by(cls, F.struct(F.col("_n"), -F.col(cls))).alias("majority"))


def decimate(df: DataFrame, values: list[str], factor: int, key: list[str]) -> DataFrame:
    """Means over factor * factor pixels."""
    cell = [F.floor(F.col(c) / factor).cast("int").alias(f"c{c}") for c in ("y", "x")]
    return df.groupBy(*key, *cell).agg(*[F.avg(v).alias(v) for v in values])


def nearest_sample(points: DataFrame, raster: DataFrame, x0: float, y0: float, resolution: float, key: list[str] = ()) -> DataFrame:
    """Raster values at points' nearest pixels; px, py are metres, y0 the top row's centre. An equi-join."""
    p = points.withColumns({"x": F.floor((F.col("px") - x0) / resolution + 0.5).cast("int"), "y": F.floor((F.lit(y0) - F.col("py")) / resolution + 0.5).cast("int")})
    return p.join(raster, [*key, "y", "x"], "left")


def yearly_classes(df: DataFrame, point: str, year: str, cls: str) -> DataFrame:
    """Each point's classes as JSON {year: class}; a year that fails (null) is left out, of two the larger stays."""
    one = df.filter(F.col(cls).isNotNull()).groupBy(point, year).agg(F.max(cls).alias(cls))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(year), F.col(cls))))
    return one.groupBy(point).agg(F.to_json(F.map_from_entries(F.transform(pairs, lambda s: F.struct(s[year].cast("string"), s[cls])))).alias("classes"))


def band_stats(df: DataFrame, bands: list[str], nodata: int = 0) -> DataFrame:
    """(band, min, median, max, missing) a band, nodata left out of the first three; missing in percent. One pass."""
    v = {b: F.when(F.col(b) != nodata, F.col(b)) for b in bands}
    aggs = [a for b in bands for a in (F.min(v[b]).alias(f"{b}_0"), F.median(v[b]).alias(f"{b}_1"), F.max(v[b]).alias(f"{b}_2"), (F.count_if(F.col(b) == nodata) / F.count(F.lit(1)) * 100).alias(f"{b}_3"))]
    row = [F.struct(F.lit(b).alias("band"), *[F.col(f"{b}_{i}").cast("double").alias(n) for i, n in enumerate(("min", "median", "max", "missing"))]) for b in bands]
    return df.agg(*aggs).select(F.inline(F.array(*row)))


def percentile_stretch(df: DataFrame, band: str, low: float, high: float, out: str) -> DataFrame:
    """Band stretched between two of its percentiles (in percent), NaN left out of them; NaN where it is NaN. The two
    numbers come from one aggregation and are constants of the second pass."""
    from ..functions.columns import stretch

    v = F.col(band).cast("double")
    a, b = df.filter(~F.isnan(v)).agg(F.percentile(v, F.array(F.lit(low / 100), F.lit(high / 100)))).first()[0] or (0.0, 1.0)
    return df.withColumn(out, stretch(band, a, b if b > a else a + 1.0))
