"""Class harmonisation: product codes to level-1 classes, quality filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Level-1 classes (label, colour) by value, and product codes by the class they mean.
CLASSES = {
    1: ("Tree cover", "rgb(0,100,0)"), 2: ("Grassland", "rgb(255,255,76)"), 3: ("Cropland", "rgb(240,150,255)"),
    4: ("Wetland", "rgb(0,150,160)"), 5: ("Built-up", "rgb(250,0,0)"), 6: ("Water", "rgb(0,100,200)"),
    7: ("Other", "rgb(180,180,180)"), 255: ("No data", "rgb(255,255,255)"),
}
CCI = {
    255: (0,), 3: (10, 11, 12, 20, 30), 2: (40, 110, 120, 121, 122, 130, 140, 150, 151, 152, 153),
    1: (50, 60, 61, 62, 70, 71, 72, 80, 81, 82, 90, 100), 4: (160, 170, 180), 5: (190,), 7: (200, 201, 202, 220), 6: (210,),
}
WORLDCOVER = {255: (0,), 6: (80,), 1: (10,), 2: (20, 30), 3: (40,), 5: (50,), 7: (60, 70, 100), 4: (90, 95)}
IO = {255: (0,), 6: (1,), 1: (2,), 4: (4,), 3: (5,), 5: (7,), 7: (8, 9, 10), 2: (11,)}


def standardise(code, mapping: dict[int, tuple[int, ...]], missing: int = 255) -> Column:
    """The class that a code means; codes in no class are missing. A map literal: no join."""
    flat = [F.lit(v) for cls, codes in mapping.items() for c in codes for v in (c, cls)]
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(F.try_element_at(F.create_map(*flat), code.cast("int")), F.lit(missing))


def class_table(spark: SparkSession) -> DataFrame:
    """(value, label, color), a row a class."""
    return spark.createDataFrame([(v, *x) for v, x in CLASSES.items()], "value int, label string, color string")


def worldcover_quality(q1, q2, q3) -> Column:
    """P10: two seasons with data at least, or none known at all."""
    q = [F.col(x) for x in (q1, q2, q3)]
    return (sum(((x > 0).cast("int") for x in q), F.lit(0)) >= 2) | ((q[0] < 0) & (q[1] < 0) & (q[2] < 0))


def cci_quality(processed, changes, observations, key: list[str]) -> Column:
    """Processed, unchanged and three observations; where that leaves nothing of a tile, one observation."""
    steady = (F.col(processed) == 1) & (F.col(changes) == 0)
    strict, relaxed = steady & (F.col(observations) >= 3), steady & (F.col(observations) >= 1)
    return F.when(F.max(strict.cast("int")).over(Window.partitionBy(*key)) == 1, strict).otherwise(relaxed)


def cci_quality_rows(df: DataFrame, processed: str, changes: str, observations: str, key: list[str], out: str = "ok") -> DataFrame:
    """P11 without a window over whole tiles: one pre-aggregated flag a tile, joined back. For tiles of any size."""
    steady = (F.col(processed) == 1) & (F.col(changes) == 0)
    strict = steady & (F.col(observations) >= 3)
    flag = df.groupBy(*key).agg(F.max(strict.cast("int")).alias("_any"))
    return df.join(flag, key).withColumn(out, F.when(F.col("_any") == 1, strict).otherwise(steady & (F.col(observations) >= 1))).drop("_any")


def prepare(df: DataFrame, code: str, mapping: dict, out: str, quality: Column | None = None, inside: Column | None = None) -> DataFrame:
    """A product's class where its quality passes and, if given, inside the country; else 255."""
    cls = standardise(code, mapping)
    for ok in (quality, inside):
        if ok is not None:
            cls = F.when(ok, cls).otherwise(F.lit(255))
    return df.withColumn(out, cls)
