"""Command line over the same functions: python -m atollgrid.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import sys


def years_of(spec: str) -> list[str]:
    """`2020`, `2018,2020` or `2018-2020`: commas first, then a range, digits only."""
    parts = spec.split(",") if "," in spec else [spec]
    if len(parts) == 1 and "-" in spec:
        first, last = spec.split("-")
        parts = [str(y) for y in range(int(first), int(last) + 1)]
    if not all(p.isdigit() for p in parts):
        raise ValueError(f"not years: {spec}")
    return parts


def mosaic_years(spec: str, first: int = 2000, last: int = 2025) -> list[int]:
    """P18 for mosaics: a range first, blanks allowed, bounds checked."""
    if "-" in spec:
        a, b = (int(x.strip()) for x in spec.split("-"))
        found = list(range(a, b + 1))
    else:
        found = [int(x.strip()) for x in spec.split(",")]
    if not all(first <= y <= last for y in found):
        raise ValueError(f"years are {first} to {last}: {spec}")
    return found


def tile_of(text: str) -> tuple[int, int]:
    """Two whole numbers with `,`, `-` or `_` between."""
    import re

    m = re.fullmatch(r"(\d+)[,_-](\d+)", text)
    if m is None:
        raise ValueError(f"not a tile: {text}")
    return int(m[1]), int(m[2])


def _session(name: str):
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="atollgrid")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    a = sub.add_parser("print-tasks")
    a.add_argument("--years", required=True)
    a.add_argument("--tiles", required=True, help="Parquet of tiles: label, region")
    a = sub.add_parser("list-countries")
    a.add_argument("--grids", default="all")
    a = sub.add_parser("get-grid-tiles")
    a.add_argument("--boxes", required=True, help="Parquet of countries' projected boxes: name, region, x0, y0, x1, y1")
    a.add_argument("--grids", default="all", choices=["all", "pacific", "non-pacific"])
    a.add_argument("--out", required=True)
    a = sub.add_parser("filter-tasks")
    a.add_argument("--tasks", required=True, help="JSON array of tasks")
    a.add_argument("--existing", required=True, help="folder of finished item documents")
    a.add_argument("--dataset", default="geomad")
    a.add_argument("--version", default="0-2-0")
    a = sub.add_parser("geomad")
    for f in ("--observations", "--out"):
        a.add_argument(f, required=True)
    a.add_argument("--min-timesteps", type=int, default=10)
    a = sub.add_parser("index-to-stac-geoparquet")
    for f in ("--prefix", "--out"):
        a.add_argument(f, required=True)
    a = sub.add_parser("make-mosaics")
    for f in ("--index", "--out", "--years"):
        a.add_argument(f, required=True)
    a.add_argument("--dataset", default="geomad")
    a = sub.add_parser("train-model")
    for f in ("--samples", "--out", "--features"):
        a.add_argument(f, required=True)
    a = sub.add_parser("classify")
    for f in ("--composite", "--dem", "--model", "--out"):
        a.add_argument(f, required=True)
    a.add_argument("--threshold", type=float, default=30.0)
    o = p.parse_args(argv)
    if o.command == "version":
        print("0.1.0")
        return 0
    if o.command == "list-countries":
        from .sources.countries import list_countries

        print(json.dumps(list_countries(o.grids), ensure_ascii=False))
        return 0
    from pyspark.sql import functions as F

    from .functions.columns import item_key, owner_prefix
    from .operators import grid, ml, mosaic
    from .plans import pipelines
    from .sources import catalog

    spark = _session(o.command)
    if o.command == "print-tasks":
        years = spark.createDataFrame([(y,) for y in years_of(o.years)], "year string")
        print(json.dumps([r.asDict() for r in grid.plan_tasks(spark.read.parquet(o.tiles), years).collect()]))
    elif o.command == "get-grid-tiles":
        boxes = spark.read.parquet(o.boxes)
        wanted = ["pacific", "non-pacific"] if o.grids == "all" else [o.grids]
        tiles = [grid.grid_tiles(boxes.filter(F.col("region") == r), "name", r).select("label", "ix", "iy", "name", "region") for r in wanted]
        (tiles[0].unionByName(tiles[1]) if len(tiles) > 1 else tiles[0]).write.mode("overwrite").parquet(o.out)
    elif o.command == "filter-tasks":
        tasks = spark.createDataFrame([(t["id"], t["year"], t["region"]) for t in json.loads(o.tasks)], "id string, year string, region string")
        part = F.split("id", "_")
        key = item_key(owner_prefix("region"), "ls", o.dataset, o.version, part[0], part[1], F.col("year"))
        done = catalog.listing(spark, o.existing, suffix=".stac-item.json").select(F.regexp_extract("path", r"((?:[^/]+/){5}[^/]+)$", 1).alias("key"))
        print(json.dumps([r.asDict() for r in grid.unfinished(tasks, key, done, "key").select("id", "year", "region").collect()]))
    elif o.command == "geomad":
        obs = spark.read.parquet(o.observations)
        catalog.write_tile(pipelines.annual_composite(obs, pipelines.BANDS, ["tile_id", "year"], o.min_timesteps), o.out)
    elif o.command == "index-to-stac-geoparquet":
        catalog.write_index(catalog.read_items(spark, o.prefix), o.out)
    elif o.command == "make-mosaics":
        items = spark.read.parquet(o.index).withColumn("href", F.try_element_at(F.filter("links", lambda x: x["rel"] == "self"), F.lit(-1))["href"])
        for year in mosaic_years(o.years):
            of = items.filter(F.substring("properties.datetime", 1, 4) == str(year))
            mosaic.mosaic_document(of, str(year)).write.mode("overwrite").text(f"{o.out}/{o.dataset}_{year}_mosaic.json")
    elif o.command == "train-model":
        names = o.features.split(",")
        ml.train_forest(ml.drop_missing(spark.read.parquet(o.samples), names), "lulc", names).write().overwrite().save(o.out)
    elif o.command == "classify":
        model = catalog.load_model(o.model)
        done = pipelines.classify(spark.read.parquet(o.composite), spark.read.parquet(o.dem), model, pipelines.BANDS, ["tile_id", "year"], threshold=o.threshold)
        catalog.write_tile(done, o.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
