"""Items, listings, tables and models (S1, S5, S6, S10, S12 to S15, S17 to S20; J9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A catalogue item document; unknown properties are left out.
ITEM = (
    "id string, type string, collection string, bbox array<double>, geometry struct<type: string, coordinates: string>, "
    "links array<struct<rel: string, href: string>>, "
    "properties struct<datetime: string, start_datetime: string, end_datetime: string, created: string, `landsat:collection_category`: string, platform: string>, "
    "assets map<string, struct<href: string>>"
)


def listing(spark: SparkSession, root: str, pattern: str = "*", suffix: str = "") -> DataFrame:
    """(path) of files under root; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root).select("path")
    return files.filter(F.col("path").endswith(suffix)) if suffix else files


def mosaic_files(paths: DataFrame) -> DataFrame:
    """(path, dataset, year) of mosaic documents among paths."""
    part = lambda i: F.regexp_extract("path", r"(\w+)_(\d{4})_mosaic\.json$", i)
    return paths.withColumns({"dataset": part(1), "year": part(2)}).filter("year <> ''")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Item documents, one a file."""
    return spark.read.schema(ITEM).option("multiLine", "true").option("recursiveFileLookup", "true").json(path)


def write_index(items: DataFrame, path: str) -> None:
    """The index of items as Parquet with its bbox in columns, so that searches reach the scan; raises without items."""
    d = items.withColumns({n: F.try_element_at("bbox", F.lit(i + 1)) for i, n in enumerate(("west", "south", "east", "north"))})
    if d.isEmpty():
        raise ValueError("No items found to index")
    d.write.mode("overwrite").parquet(path)


def overlaps(west: float, south: float, east: float, north: float) -> Column:
    return (F.col("west") <= east) & (F.col("east") >= west) & (F.col("south") <= north) & (F.col("north") >= south)


def search(items: DataFrame, box: tuple[float, float, float, float] | None = None, first: str | None = None, last: str | None = None, tiers: list[str] | None = None, start: str = "start", end: str = "end", tier: str = "tier", required: bool = False) -> DataFrame:
    """Items that overlap a box and an interval, of given tiers: plain comparisons, pushed to the scan."""
    d = items
    if box is not None:
        d = d.filter(overlaps(*box))
    if first is not None:
        d = d.filter(F.col(end) >= first)
    if last is not None:
        d = d.filter(F.col(start) <= last)
    if tiers is not None:
        d = d.filter(F.col(tier).isin(tiers))
    if required and d.isEmpty():
        raise ValueError("No STAC items found")
    return d


def by_id(items: DataFrame, id_: str) -> DataFrame:
    """The one item of an id; raises unless there is exactly one."""
    d = items.filter(F.col("id") == id_)
    if (n := d.limit(2).count()) != 1:
        raise ValueError(f"{id_}: {'no' if n == 0 else 'more than one'} item")
    return d


def bounded(items: DataFrame, least: int, most: int | None) -> DataFrame:
    """Items, if there are from least to most of them (None: any number from least on); else raises."""
    n = items.limit(least if most is None else most + 1).count()
    if n < least or most is not None and n > most:
        raise ValueError(f"{n} items where {least} {'or more' if most is None else f'to {most}'} are expected")
    return items


def read_samples(spark: SparkSession, path: str, schema: str | None = None, expected: int | None = None) -> DataFrame:
    """Sample tables with the tile id from their folder; raises if there aren't as many files as expected."""
    reader = spark.read.option("header", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    d = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)
    if expected is not None and (n := len(d.inputFiles())) != expected:
        raise ValueError(f"{n} files where {expected} are expected")
    parts = F.split(F.col("_metadata.file_path"), "/")
    return d.select("*", F.try_element_at(parts, F.lit(-3)).alias("tile_id")).drop("outlier", "time", "spatial_ref")


def parse_point(wkt: str) -> Column:
    """X and y of `POINT (x y)` text."""
    num = lambda i: F.regexp_extract(wkt, r"POINT\s*\(\s*(\S+)\s+(\S+)\s*\)", i).try_cast("double")
    return F.struct(num(1).alias("x"), num(2).alias("y"))


def boundaries(cache: DataFrame, fetched: DataFrame, codes: list[str], code: str = "GID_0") -> DataFrame:
    """Boundaries of the codes: cached ones, and fetched ones that the cache lacks."""
    more = fetched.join(cache.select(code), code, "left_anti")
    return cache.unionByName(more).filter(F.col(code).isin(codes))


def of_product(items: DataFrame, product: str, year: int = 2020, most: int | None = 29) -> DataFrame:
    """A product's items of a year, by their date; of `io`, whose dates are vague, by their id's last number of four
    digits: longer numbers that hold the year's digits don't count. Raises unless there are 1 to `most` (None: 1 or more)."""
    named = F.regexp_extract("id", r"(?s).*(?<![0-9])([0-9]{4})(?![0-9])", 1)
    d = items.filter(named == str(year)) if product == "io" else items.filter(F.substring("datetime", 1, 4) == str(year))
    return bounded(d, 1, most)


def write_tile(df: DataFrame, path: str, metadata: DataFrame | None = None) -> None:
    """Rasters by tile and year, as Parquet folders; then, once these are there, the metadata rows beside them."""
    df.write.mode("overwrite").partitionBy("tile_id", "year").parquet(path)
    if metadata is not None:
        metadata.write.mode("append").json(f"{path.rstrip('/')}-items")


def write_tasks(tasks: DataFrame, path: str) -> None:
    """Tasks as one JSON array in a text file; a task is a tile and a year, so they are few."""
    one = tasks.agg(F.to_json(F.array_sort(F.collect_list(F.struct("id", "year", "region")))).alias("value"))
    one.coalesce(1).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str) -> None:
    """Rows as CSV files with a header."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def dump(df: DataFrame, folder: str | None, name: str) -> DataFrame:
    """Df, also written to a folder for debugging where one is named; what follows then reads that."""
    if not folder:
        return df
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def write_features(df: DataFrame, path: str, x: str = "x", y: str = "y") -> None:
    """Points as newline-delimited GeoJSON features."""
    rest = [c for c in df.columns if c not in (x, y)]
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates")).alias("geometry"), F.struct(*rest).alias("properties"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def fetched_once(url: str, cache: str) -> str:
    """The folder of a saved pipeline whose zip archive is at an address: got and unpacked where the cache, a folder
    of this machine, has none of that address yet."""
    import hashlib
    import os
    import shutil
    import tempfile
    import urllib.request
    import zipfile

    own = os.path.join(cache, hashlib.sha256(url.encode()).hexdigest()[:16])
    if not os.path.isdir(own):
        os.makedirs(cache, exist_ok=True)
        with tempfile.TemporaryDirectory(dir=cache) as part:
            with urllib.request.urlopen(url) as source, open(f"{part}/model.zip", "wb") as out:
                shutil.copyfileobj(source, out)
            with zipfile.ZipFile(f"{part}/model.zip") as z:
                z.extractall(f"{part}/model")
            os.replace(f"{part}/model", own)  # whole or not at all
    return own


def load_model(path: str, cache: str | None = None):
    """A saved pipeline; of an address the copy in the cache, got once. Raises for a path that names none."""
    from pyspark.ml import PipelineModel

    if not path or path.endswith((".joblib", ".pkl")):
        raise ValueError(f"not a saved pipeline: {path}")
    if cache is not None and "://" in path and path.endswith(".zip"):
        path = f"file://{fetched_once(path, cache)}"
    return PipelineModel.load(path)
