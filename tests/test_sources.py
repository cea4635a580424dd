"""Sources, sinks, models, streams and workflows end to end on small files."""

import json
import math

import duckdb
import pytest
from atollgrid import cli
from atollgrid.operators import grid, ml
from atollgrid.plans import pipelines
from atollgrid.plans.adapters import FEATURES, samples
from atollgrid.plans.queries import ORACLE, QUERIES
from atollgrid.sources import catalog, rasters
from atollgrid.streaming.index import index_new_items
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def item(i, west):
    return {"id": f"i{i}", "type": "Feature", "bbox": [west, 0.0, west + 1, 1.0], "links": [{"rel": "self", "href": f"https://example.com/i{i}"}], "properties": {"datetime": f"20{20 + i}-06-30T00:00:00.000Z"}, "assets": {"red": {"href": "r.tif"}}}


def test_items_to_index_to_mosaic(spark, tmp_path):
    for i in range(3):
        (tmp_path / "docs" / f"{i}").mkdir(parents=True)
        (tmp_path / "docs" / f"{i}" / f"x_{i}.stac-item.json").write_text(json.dumps(item(i, 10.0 * i)))
    items = catalog.read_items(spark, str(tmp_path / "docs"))
    assert sorted(r["id"] for r in items.collect()) == ["i0", "i1", "i2"]
    assert catalog.listing(spark, str(tmp_path / "docs"), suffix=".stac-item.json").count() == 3
    assert cli.main(["index-to-stac-geoparquet", "--prefix", str(tmp_path / "docs"), "--out", str(tmp_path / "index")]) == 0
    index = spark.read.parquet(str(tmp_path / "index"))
    assert catalog.search(index, (9, 0, 12, 2)).first()["id"] == "i1" and catalog.by_id(index, "i2")["west"] is not None
    with pytest.raises(ValueError, match="No STAC items"):
        catalog.search(index, (50, 50, 51, 51), required=True)
    assert cli.main(["make-mosaics", "--index", str(tmp_path / "index"), "--out", str(tmp_path / "m"), "--years", "2020-2021"]) == 0
    doc = json.loads(spark.read.text(str(tmp_path / "m" / "geomad_2020_mosaic.json")).first()[0])
    assert doc["minzoom"] == 5 and all(x == ["https://example.com/i0"] for x in doc["tiles"].values())


def test_stream_indexes_each_item_once(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    for i in range(3):
        (docs / f"{i}.json").write_text(json.dumps(item(i, 0.0)))
        index_new_items(spark, str(docs), str(tmp_path / "index"), str(tmp_path / "seen")).awaitTermination(60)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "index")).collect()) == ["i0", "i1", "i2"]


def test_samples(spark, tmp_path):
    for t in ("1_2", "3_4"):
        f = tmp_path / t / "2020"
        f.mkdir(parents=True)
        (f / "samples.csv").write_text("lulc,geometry,red,outlier\n1,POINT (10.5 -3),0.1,0\n")
    d = catalog.read_samples(spark, str(tmp_path), expected=2)
    assert sorted(r["tile_id"] for r in d.collect()) == ["1_2", "3_4"] and "outlier" not in d.columns
    assert tuple(d.select(catalog.parse_point("geometry").alias("p")).first()["p"]) == (10.5, -3.0)
    with pytest.raises(ValueError, match="3 are expected"):
        catalog.read_samples(spark, str(tmp_path), expected=3)
    catalog.write_features(d.select(F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), "lulc"), str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0])["geometry"]["coordinates"] == [1.0, 2.0]


def test_boundaries_and_halves(spark):
    cache, new = (spark.createDataFrame([(c, 1) for c in x], "GID_0 string, g int") for x in ("AB", "BC"))
    assert sorted(r[0] for r in catalog.boundaries(cache, new, ["A", "C"]).collect()) == ["A", "C"]
    d = spark.createDataFrame([(-179.0,), (179.0,)], "west double")
    e, w = rasters.join_halves(d)
    assert e.count() == w.count() == 1 and [r[0] for r in rasters.shift_west(w, "west").collect()] == [181.0]
    with pytest.raises(ValueError):
        rasters.join_halves(e)
    with pytest.raises(ValueError):
        catalog.bounded(d, 3, 9)


def test_polygon_tiles(spark):
    w = 96_000.0
    x0, y0 = -20_000_000.0 + 200 * w, -10_000_000.0 + 100 * w
    ring = [(x0 + 10, y0 + 10), (x0 + 2.5 * w, y0 + 20), (x0 + 20, y0 + 2.5 * w)]
    got = {(r["ix"], r["iy"]) for r in grid.tiles_of_polygon(spark, [ring]).collect()}
    assert got == {(200 + i, 100 + j) for i in range(3) for j in range(3) if i + j < 3}
    inner = [(x0 + 10, y0 + 10), (x0 + 20, y0 + 10), (x0 + 15, y0 + 20)]  # wholly inside a tile
    assert [tuple(r)[:2] for r in grid.tiles_of_polygon(spark, [inner]).collect()] == [(200, 100)]


def test_model_round_trip(spark, tmp_path):
    d = samples(spark, SF)
    model = ml.train_forest(d, "lulc", FEATURES, trees=10, depth=4)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = catalog.load_model(str(tmp_path / "model"))
    odd = d.withColumn("f0", F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("f0")))
    a, b = (ml.predict(odd, m, FEATURES, 20.0).orderBy("id").collect() for m in (model, again))
    assert str(a) == str(b)
    for r in a:
        if r["id"] % 5 == 0:
            assert r["classification"] == r["classification_unfiltered"] == r["classification_probability"] == 255
        else:
            assert r["classification"] == (r["classification_unfiltered"] if r["classification_probability"] >= 20 else 255)
    with pytest.raises(ValueError, match="aren't there"):
        ml.predict(d.drop("f0"), model, FEATURES[1:])
    with pytest.raises(ValueError):
        catalog.load_model("x.joblib")


def test_composite_to_classes(spark):
    bands = pipelines.BANDS
    rows = [(0, y, x, t, *[8000 + 1000 * i + 37 * ((x * y + t) % 5) for i in range(6)], 21824, 0) for y in range(5) for x in range(5) for t in range(12)]
    obs = spark.createDataFrame(rows, "tile int, y int, x int, time int, " + ", ".join(f"{b} int" for b in bands) + ", qa_pixel int, qa_radsat int")
    comp = pipelines.annual_composite(obs, bands, ["tile"])
    assert comp.count() == 25 and comp.filter("count <> 12").isEmpty()
    feat = pipelines.features(comp, bands)
    dem = comp.select("tile", "y", "x", (F.col("x") * 3.0).alias("elevation"))
    names = [*bands, "ndvi", "elevation"]
    train = pipelines.with_terrain(feat, dem, 30.0, ["tile"]).withColumn("lulc", (F.col("x") > 2).cast("int") + 1)
    model = ml.train_forest(train, "lulc", names, trees=10, depth=4)
    got = pipelines.classify(comp, dem, model, bands, ["tile"])
    assert got.count() == 25 and {r["classification"] for r in got.collect()} <= {1, 2, 255}
    slope = train.filter("x = 2").first()["slope"]
    assert abs(slope - math.degrees(math.atan(0.1))) < 1e-4


def test_training_points(spark):
    rows = [(0, i, i // 20, i % 20, 1 + (i % 20) // 10, 1 + (i % 20) // 10, 1 + (i % 20) // 10) for i in range(400)]
    layers = spark.createDataFrame(rows, "tile int, id int, y int, x int, wc int, cci int, io int")
    feat = layers.select("tile", "y", "x", (F.col("wc") + F.rand(1)).alias("red"), F.rand(2).alias("ndvi"))
    got = pipelines.training_points(layers, feat, ["red", "ndvi"], ["tile"], "id", n=60, least=20)
    n = {r["lulc"]: r["count"] for r in got.groupBy("lulc").count().collect()}
    assert set(n) == {1, 2} and all(25 <= v <= 30 for v in n.values())


def test_tasks_cli(spark, tmp_path, capsys):
    spark.createDataFrame([("1_2", "pacific"), ("3_4", "non-pacific")], "label string, region string").write.parquet(str(tmp_path / "tiles"))
    assert cli.main(["print-tasks", "--years", "2019-2020", "--tiles", str(tmp_path / "tiles")]) == 0
    tasks = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(tasks) == 4 and {"id": "1_2", "year": "2020", "region": "pacific"} in tasks
    done = tmp_path / "out" / "dep_ls_geomad" / "0-2-0" / "001" / "002" / "2020"
    done.mkdir(parents=True)
    (done / "dep_ls_geomad_001_002_2020.stac-item.json").write_text("{}")
    assert cli.main(["filter-tasks", "--tasks", json.dumps(tasks), "--existing", str(tmp_path / "out")]) == 0
    left = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(left) == 3 and {"id": "1_2", "year": "2020", "region": "pacific"} not in left


def test_countries_and_tiles(spark, tmp_path, capsys):
    from atollgrid.sources.countries import country_table, list_countries

    found = list_countries()
    assert len(found) == 60 and list(found) == sorted(found) and found["São Tomé and Príncipe"] == "STP"
    assert len(list_countries("pacific")) == 22 and country_table(spark).filter("region = 'pacific'").count() == 22
    with pytest.raises(ValueError, match="no such grid"):
        list_countries("x")
    assert cli.main(["list-countries", "--grids", "pacific"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["Fiji"] == "FJI"
    boxes = [("Fiji", "pacific", 0.0, 0.0, 100_000.0, 10.0), ("Cuba", "non-pacific", 0.0, 0.0, 10.0, 10.0), ("Aruba", "non-pacific", 5.0, 5.0, 10.0, 10.0)]
    spark.createDataFrame(boxes, "name string, region string, x0 double, y0 double, x1 double, y1 double").write.parquet(str(tmp_path / "boxes"))
    assert cli.main(["get-grid-tiles", "--boxes", str(tmp_path / "boxes"), "--out", str(tmp_path / "tiles")]) == 0
    got = spark.read.parquet(str(tmp_path / "tiles")).collect()
    assert [r["name"] for r in got if r["region"] == "non-pacific"] == ["Aruba"] and sum(r["region"] == "pacific" for r in got) == 2


def test_sinks(spark, tmp_path):
    import json

    tasks = spark.createDataFrame([("2_1", "2020", "pacific"), ("1_1", "2020", "non-pacific")], "id string, year string, region string")
    catalog.write_tasks(tasks, str(tmp_path / "tasks"))
    assert [t["id"] for t in json.loads(spark.read.text(str(tmp_path / "tasks")).first()["value"])] == ["1_1", "2_1"]
    catalog.write_table(tasks, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 2
    tile = spark.createDataFrame([("1_1", "2020", 1)], "tile_id string, year string, v int")
    for _ in range(2):
        catalog.write_tile(tile, str(tmp_path / "tile"), tile.select("tile_id", "year"))
    assert spark.read.parquet(str(tmp_path / "tile")).count() == 1 and spark.read.json(str(tmp_path / "tile-items")).count() == 2
    assert catalog.dump(tile, None, "x") is tile and catalog.dump(tile, str(tmp_path / "debug"), "x").count() == 1


def test_model_is_got_once(spark, tmp_path):
    import shutil

    from atollgrid.operators import ml

    d = spark.createDataFrame([(i % 2, float(i % 2), float(i)) for i in range(20)], "c int, a double, b double")
    ml.train_forest(d, "c", ["a", "b"], trees=2, depth=2).write().overwrite().save(str(tmp_path / "model"))
    zipped = shutil.make_archive(str(tmp_path / "m"), "zip", str(tmp_path / "model"))
    for _ in range(2):
        assert len(catalog.load_model(f"file://{zipped}", str(tmp_path / "cache")).stages) == 2
        shutil.rmtree(tmp_path / "model", ignore_errors=True)
    (tmp_path / "m.zip").unlink()
    assert len(catalog.load_model(f"file://{zipped}", str(tmp_path / "cache")).stages) == 2


def test_product_year_is_a_whole_number(spark):
    ids = ["47P-2020", "12020_2019", "20205_2019", "2020_2019", "a2020b", "x_2020_v02", "1_2020\n", "none", None]
    d = spark.createDataFrame([(i, "2020-05-01" if k == 1 else "2017-01-01") for k, i in enumerate(ids)], "id string, datetime string")
    assert sorted(r["id"] for r in catalog.of_product(d, "io").collect()) == sorted(["47P-2020", "a2020b", "x_2020_v02", "1_2020\n"])
    assert [r["id"] for r in catalog.of_product(d, "cci").collect()] == ["12020_2019"]


def test_product_items_of_the_whole_table(spark, tmp_path):
    orders = spark.range(1_100_000).selectExpr("id AS o_orderkey", "TIMESTAMP_NTZ '1996-05-01 00:00:00' AS o_orderdate")
    odd = [(2_000_000, "1996-12-31 23:59:59"), (1996, "1992-01-01 00:00:00"), (1996, None), (None, "1996-01-01 00:00:00"), (-3, "1996-02-29 00:00:00")]
    more = spark.createDataFrame(odd, "o_orderkey long, d string").selectExpr("o_orderkey", "CAST(d AS TIMESTAMP_NTZ) AS o_orderdate")
    orders.unionByName(more).write.parquet(str(tmp_path / "orders.parquet"))
    got = QUERIES["product_items"](spark, str(tmp_path))
    assert got.count() == got.distinct().count() == 1_100_003
    assert {r["id"] for r in got.filter("id RLIKE '_(|-3|0|2|3|4|1996|2000000)_'").collect()} == {f"item_{k}_1996" for k in ("", -3, 0, 2, 3, 4, 1996, 2_000_000)}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    assert con.execute(f"SELECT count(*) FROM ({ORACLE['product_items']})").fetchall() == [(1_100_003,)]
    with pytest.raises(ValueError):
        catalog.bounded(more.filter("false"), 1, None)
