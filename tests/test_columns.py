"""Column functions, masks and grids: behaviours of the fixtures."""

import math

import pytest
from atollgrid import cli
from atollgrid.functions import columns as C
from atollgrid.operators import compare, focal, geomad, grid, masks, mosaic, reclass, sampling
from atollgrid.operators.grid import convex_hull
from atollgrid.sources import catalog, rasters
from pyspark.sql import functions as F

BANDS = ["nir08", "red", "green", "blue", "swir16", "swir22"]


def one(spark, col, **values):
    cols = [F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("one")]
    return spark.range(1).select(*cols).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(("raw", "want"), [(10000, 0.075), (0, math.nan), (65535, math.nan), (1, 0.0), (50000, 1.0)])
def test_scale(spark, raw, want):
    got = one(spark, C.scale_reflectance("r"), r=raw)
    assert math.isnan(got) if math.isnan(want) else abs(got - want) < 1e-5


def indices(spark, *v):
    d = spark.createDataFrame([v], ", ".join(f"{b} double" for b in BANDS))
    return d.select(*[c.alias(k) for k, c in C.spectral_indices().items()]).first().asDict()


def test_indices(spark):
    i = indices(spark, 0.4, 0.1, 0.2, 0.15, 0.25, 0.2)
    assert abs(i["ndvi"] - 0.6) < 1e-9 and len(i) == 8
    assert abs(indices(spark, 0.3, 0.1, 0.5, 0.15, 0.25, 0.2)["ndwi"] - 0.25) < 1e-9
    assert abs(indices(spark, 0.3, 0.1, 0.4, 0.15, 0.2, 0.2)["mndwi"] - 1 / 3) < 1e-9
    assert abs(indices(spark, 0.3, 0.1, 0.2, 0.15, 0.25, 0.2)["bui"] - (-0.05 / 0.55 - 0.5)) < 1e-9
    i = indices(spark, math.nan, 0.1, 0.2, 0.15, 0.25, 0.2)
    assert all(math.isnan(i[k]) for k in ("ndvi", "ndwi", "bsi", "mbi", "bui")) and not math.isnan(i["mndwi"])
    i = indices(spark, *[0.0] * 6)
    assert all(math.isnan(i[k]) for k in ("ndvi", "ndwi", "mndwi", "ndti", "bsi")) and i["baei"] == math.inf


def test_masks(spark):
    codes = {22280: True, 23824: True, 23888: False, 21952: False, 30048: False, 21824: False, 0: False, 1: False}
    d = spark.createDataFrame([(q, 5, 0) for q in codes], "qa_pixel int, red int, qa_radsat int")
    got = {r["qa_pixel"]: r["m"] for r in d.select("qa_pixel", (masks.cloud() | masks.shadow()).alias("m")).collect()}
    assert got == codes
    got = masks.mask_cloud_and_shadow(d, ["red"]).collect()
    assert sorted((r["red"], r["qa_pixel"]) for r in got if r["red"] == 0) == [(0, 0), (0, 0)]
    assert masks.mask_nodata(d, ["red"]).filter("qa_pixel = 1").first()["red"] == 0
    assert masks.mask_saturated(d.drop("qa_radsat"), ["red"]).filter("red <> 5").isEmpty()


def test_year_bounds(spark):
    for a, b, want in (("2020-03-01", "2020-11-15", ("2020-01-01", "2020-06-30", "2020-12-31")), ("2020-03-01", "2021-11-15", ("2020-01-01", "2020-06-30", "2021-12-31")), ("1999-02-10", "2001-10-20", ("1999-01-01", "2000-06-30", "2001-12-31"))):
        d = spark.range(1).select(F.to_date(F.lit(a)).alias("a"), F.to_date(F.lit(b)).alias("b"))
        got = d.select(*[v.alias(k) for k, v in C.year_bounds("a", "b").items()]).first()
        assert tuple(x[:10] for x in got) == want and got["end_datetime"].endswith("T23:59:59.000Z") and got["start_datetime"].endswith("T00:00:00.000Z")


def test_text_functions(spark):
    assert one(spark, C.search_window("y"), y="2012") == "2011/2013" and one(spark, C.search_window("y"), y="2013") == "2013"
    assert one(spark, C.tile_id_parts("t"), t="251-088") == (251, 88) and one(spark, C.tile_id_parts("t"), t="1_2_3") is None
    assert one(spark, C.s3_url("u", "https://h/", "b/"), u="https://h/x111") == "s3://b/x111"
    assert one(spark, C.s3_url("u", "https://h/", "b/"), u="https://h/x:1") == "s3://b/x"
    assert one(spark, C.item_key(F.lit("dep"), "ls", "geomad", "0.2.0", F.lit(66), F.lit(22), F.lit(2020))) == "dep_ls_geomad/0-2-0/066/022/2020/dep_ls_geomad_066_022_2020.stac-item.json"
    assert one(spark, C.confident_class("c", C.whole_percent("p"), 30), c=4, p=0.2999) == 255 and one(spark, C.confident_class("c", C.whole_percent("p"), 30), c=4, p=0.3) == 4
    assert one(spark, C.owner_prefix("r"), r="pacific") == "dep" and one(spark, C.owner_prefix("r", F.lit("me")), r="pacific") == "me"
    assert one(spark, C.bucket_url("b"), b="https://x") == "https://x" and one(spark, C.bucket_url("b"), b="data.x.org") == "https://data.x.org"
    assert one(spark, C.rescale_byte("v", 0.0, 2.0), v=1.0) == 127


def test_known_tiles(spark):
    for lon, lat, tile in ((103.82, 1.35, (312, 105)), (43.26, -11.7, (251, 88))):
        x, y = C.equal_area(F.lit(lon), F.lit(lat))
        ix, iy = C.grid_tile(x, y)
        assert tuple(spark.range(1).select(ix, iy).first()) == tile
    x, y = C.web_mercator_pacific(F.lit(-159.78), F.lit(-21.23))
    assert tuple(spark.range(1).select(*C.grid_tile(x, y, "pacific")).first()) == (89, 16)


def cube(spark, values):
    """A grid of rows as (tile, y, x, v)."""
    return spark.createDataFrame([(0, y, x, v) for y, r in enumerate(values) for x, v in enumerate(r)], "tile int, y int, x int, v int")


def grid_of(df, col):
    rows = df.select("y", "x", col).collect()
    out = {(r["y"], r["x"]): r[col] for r in rows}
    return [[out[y, x] for x in range(max(k[1] for k in out) + 1)] for y in range(max(k[0] for k in out) + 1)]


def test_focal(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    v = rng.integers(0, 4, (7, 9))
    d = cube(spark, v.tolist())
    p = np.pad((v > 1).astype(int), 1)
    want = [[int(p[y : y + 3, x : x + 3].min()) for x in range(9)] for y in range(7)]
    assert grid_of(focal.minimum_filter(d.withColumn("m", (F.col("v") > 1).cast("int")), "m", "o", ["tile"]), "o") == want
    e = np.pad(v, 2, mode="edge")
    want = [[len(set(e[y : y + 5, x : x + 5].ravel()) - {0}) for x in range(9)] for y in range(7)]
    assert grid_of(focal.heterogeneity(d, "v", "o", ["tile"]), "o") == want
    hit, ok = (e == 2) * (e != 0), e != 0
    want = [[100 * hit[y : y + 5, x : x + 5].sum() / ok[y : y + 5, x : x + 5].sum() for x in range(9)] for y in range(7)]
    got = grid_of(focal.local_share(d.withColumns({"h": (F.col("v") == 2).cast("int"), "k": (F.col("v") != 0).cast("int")}), "h", "k", "o", ["tile"]), "o")
    assert np.allclose(got, want)
    for f, pad, agg in ((focal.dilation, 0, np.max), (focal.erosion, 1, np.min)):
        m = np.pad((v > 1).astype(int), 3, constant_values=pad)
        disk = [(j, i) for j in range(-3, 4) for i in range(-3, 4) if i * i + j * j <= 9]
        want = [[int(agg([m[y + 3 + j, x + 3 + i] for j, i in disk])) for x in range(9)] for y in range(7)]
        assert grid_of(f(d.withColumn("m", (F.col("v") > 1).cast("int")), "m", "o", ["tile"], 3), "o") == want
    z = np.pad(v.astype(float), 1, mode="edge")
    gx = (z[:-2, 2:] + 2 * z[1:-1, 2:] + z[2:, 2:] - z[:-2, :-2] - 2 * z[1:-1, :-2] - z[2:, :-2]) / 240
    gy = (z[2:, :-2] + 2 * z[2:, 1:-1] + z[2:, 2:] - z[:-2, :-2] - 2 * z[:-2, 1:-1] - z[:-2, 2:]) / 240
    t = focal.terrain(d, "v", 30.0, ["tile"])
    assert np.allclose(grid_of(t, "slope"), np.degrees(np.arctan(np.hypot(gx, gy)))) and np.allclose(grid_of(t, "aspect"), (90 - np.degrees(np.arctan2(-gy, gx))) % 360)


def test_geomad(spark):
    import numpy as np

    rng = np.random.default_rng(42)
    rows = [(0, y, x, *map(int, rng.integers(7273, 43636, 6))) for _ in range(3) for y in range(4) for x in range(4)]
    rows += [(0, 9, 9, 100, 200, 300, 400, 500, 600), (0, 8, 8, 0, 1, 1, 1, 1, 1)]
    d = spark.createDataFrame(rows, "tile int, y int, x int, " + ", ".join(f"{b} int" for b in BANDS))
    got = {(r["y"], r["x"]): r for r in geomad.geomad(d, BANDS, ["tile"], block=4).collect()}
    one_, none = got[9, 9], got[8, 8]
    assert [one_[b] for b in BANDS] == [100, 200, 300, 400, 500, 600] and one_["count"] == 1 and abs(one_["emad"]) < 1e-3 and abs(one_["smad"]) < 1e-6
    assert none["count"] == 0 and none["red"] == 0 and math.isnan(none["emad"])
    pts = np.array([r[3:] for r in rows if r[1:3] == (2, 2)], float)
    m = np.array([got[2, 2][b] for b in BANDS], float)
    cost = lambda c: np.sqrt(((pts - c) ** 2).sum(1)).sum()
    assert all(cost(m) <= cost(m + s) + 1 for s in rng.normal(0, 200, (50, 6)))
    with pytest.raises(ValueError, match="time steps"):
        geomad.require_timesteps(d.withColumn("time", F.lit(1)), ["tile"])


def test_agreement_and_classes(spark):
    d = spark.createDataFrame([(1, 1, 2), (2, 1, 1), (1, 3, 1), (1, 2, 3), (255, 255, 1)], "wc int, cci int, io int")
    assert [r["m"] for r in d.select(compare.agreement().alias("m")).collect()] == [1, 1, 1, 255, 255]
    assert one(spark, reclass.standardise("c", reclass.CCI), c=202) == 7 and one(spark, reclass.standardise("c", reclass.CCI), c=999) == 255
    assert len([c for v in reclass.CCI.values() for c in v]) == 38 and len([c for v in reclass.WORLDCOVER.values() for c in v]) == 12


def test_sampling(spark):
    d = spark.range(1000).select("id", F.when(F.col("id") < 900, 1).when(F.col("id") < 997, 2).otherwise(3).alias("c"))
    n = {r["c"]: r["count"] for r in sampling.sample(d, "c", "id", n=100, least=5).groupBy("c").count().collect()}
    assert n == {1: 90, 2: 10, 3: 3}
    n = {r["c"]: r["count"] for r in sampling.sample(d, "c", "id", "equal_stratified_random", 90).groupBy("c").count().collect()}
    assert n == {1: 30, 2: 30, 3: 3}
    with pytest.raises(ValueError, match="aren't there"):
        sampling.sample(d, "c", "id", "manual", manual={"9": 1})
    with pytest.raises(ValueError, match="more rows"):
        sampling.sample(d, "c", "id", "random", 5000)
    assert sampling.stratified_split(d, "c", "id").filter("train").count() == 630 + 67 + 2


def test_geometry(spark):
    assert convex_hull([(0, 0), (1, 0), (1, 1), (0, 1), (2, 2), (3, 2), (3, 3), (2, 3)]) == [(0, 0), (1, 0), (3, 2), (3, 3), (2, 3), (0, 1)]
    d = spark.createDataFrame([(5.0, 5.0), (15.0, 5.0), (10.5, 5.0)], "x double, y double")
    ring = [(0, 0), (10, 0), (10, 10), (0, 10)]
    assert [r[0] for r in d.select(grid.in_polygon([ring])("x", "y")).collect()] == [True, False, False]
    assert [r[0] for r in d.select(grid.in_polygon([ring], 1.0)("x", "y")).collect()] == [True, False, True]
    box = spark.createDataFrame([(179.0, -179.0)], "west double, east double")
    assert sorted(map(tuple, grid.split_boxes(box).collect())) == [(-180.0, -179.0), (179.0, 180.0)]


def test_items(spark, tmp_path):
    links = F.array(*[F.struct(F.lit(r).alias("rel"), F.lit(h).alias("href")) for r, h in (("self", "https://example.com/items/item-123"), ("root", "x"))])
    assert spark.range(1).select(C.self_link(links)).first()[0] == "https://example.com/items/item-123"
    boxes = [(103.6, 1.2, 104.0, 1.5), (104.0, 1.2, 104.4, 1.5), (103.6, 1.5, 104.0, 1.8)]
    items = spark.createDataFrame([(*b, f"i{i}") for i, b in enumerate(boxes)], "west double, south double, east double, north double, href string")
    doc = mosaic.mosaic_document(items, "2020").first()["value"]
    assert '"minzoom":5' in doc and '"maxzoom":14' in doc
    with pytest.raises(ValueError, match="No STAC items found for year 2020"):
        mosaic.mosaic_document(items.limit(0), "2020")
    with pytest.raises(ValueError):
        catalog.by_id(items.withColumn("id", F.lit("a")), "a")
    paths = spark.createDataFrame([("s3://b/geomad_2020_mosaic.json",), ("s3://b/x.json",), ("s3://b/geomad_2019_mosaic.json",)], "path string")
    found = catalog.mosaic_files(paths)
    assert mosaic.mosaic_path(found, "geomad", "2020") == "s3://b/geomad_2020_mosaic.json"
    with pytest.raises(KeyError, match="2019"):
        mosaic.mosaic_path(found, "geomad", "2001")
    assert {r["dataset"]: r["default_year"] for r in mosaic.viewer_config(found).collect()} == {"geomad": "2020", "all": "2020"}


def test_fuse(spark):
    d = spark.createDataFrame([(1, 1, 0, 0), (1, 2, 21824, 7), (1, 3, 22280, 9), (2, 1, 0, 0), (2, 2, 1, 0)], "k int, t int, qa_pixel int, red int")
    got = {r["k"]: (r["qa_pixel"], r["red"]) for r in rasters.fuse(d, ["red"], ["k"], "t").collect()}
    assert got == {1: (21824, 7), 2: (1, 0)}


def test_cli_years():
    assert cli.years_of("2018-2020") == ["2018", "2019", "2020"] and cli.years_of("2018,2020") == ["2018", "2020"]
    with pytest.raises(ValueError):
        cli.years_of("20x0")
    assert cli.mosaic_years(" 2020 , 2021") == [2020, 2021]
    with pytest.raises(ValueError):
        cli.mosaic_years("1990")
    assert cli.tile_of("251_88") == (251, 88)
    with pytest.raises(ValueError):
        cli.tile_of("251_88_1")
    assert cli.main(["version"]) == 0


def test_ranks_of_large_ids(spark):
    d = spark.range(3000).select((F.col("id") * 3 + (1 << 33)).alias("id"), (F.col("id") % 7 % 3).cast("int").alias("c"))
    got = sampling.sample(d, "c", "id", n=300, least=10, drop=None)
    assert abs(got.count() - 300) <= 2 and got.distinct().count() == got.count()  # quotas are rounded
    far = d.select(F.lit((1 << 63) - 1).alias("a"), F.lit(1 << 62).alias("b")).limit(1)
    assert all(0 <= v < 1 << 32 for v in far.select(sampling.hash_rank(F.col("a")), sampling.hash_rank(F.col("b"))).first())
    split = sampling.stratified_split(d, "c", "id")
    n = {r["c"]: r["count"] for r in d.groupBy("c").count().collect()}
    assert {r["c"]: r["count"] for r in split.filter("train").groupBy("c").count().collect()} == {c: int(0.7 * k) for c, k in n.items()}


def test_worst_with_ties(spark):
    d = spark.range(1000).select("id", (F.col("id") % 2).cast("int").alias("c"), (F.col("id") % 13).cast("double").alias("d"))
    got = sorted(r["id"] for r in sampling.worst(d, "c", "d", "id").filter("outlier").collect())
    want = [sorted((i for i in range(1000) if i % 2 == c), key=lambda i: (-(i % 13), i))[:25] for c in (0, 1)]
    assert got == sorted(want[0] + want[1])


def test_silhouette_in_blocks():
    import numpy as np
    from atollgrid.operators.ml import silhouette

    rng = np.random.default_rng(3)
    x, label = rng.normal(size=(90, 3)), rng.integers(0, 3, 90)
    label[0] = 7  # alone in its cluster
    d = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    total = 0.0
    for i in range(90):
        own = [j for j in range(90) if label[j] == label[i] and j != i]
        if own:
            a = d[i, own].mean()
            b = min(d[i, label == k].mean() for k in set(label.tolist()) - {int(label[i])})
            total += (b - a) / max(a, b)
    assert abs(silhouette(x, label, block=32) - total / 90) < 1e-6


def test_deviations_of_scaled_values(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(0, 0, x, *map(int, rng.integers(7273, 43636, 6))) for x in range(3) for _ in range(5)]
    d = spark.createDataFrame(rows, "tile int, y int, x int, " + ", ".join(f"{b} int" for b in BANDS))
    for r in geomad.geomad(d, BANDS, ["tile"], scale=C.SCALE, offset=C.OFFSET).collect():
        p = np.array([v[3:] for v in rows if v[2] == r["x"]], float) * 2.75e-5 - 0.2
        m = np.array([r[b] for b in BANDS], float) * 2.75e-5 - 0.2  # rounded numbers: within 2e-5 of the estimate
        e = np.median(np.sqrt(((p - m) ** 2).sum(1)))
        s = np.median(1 - (p @ m) / np.sqrt((p * p).sum(1) * (m @ m)))
        b = np.median(np.abs(p - m).sum(1) / np.abs(p + m).sum(1))
        assert abs(r["emad"] - e) < 1e-4 and abs(r["smad"] - s) < 1e-4 and abs(r["bcmad"] - b) < 1e-4


def test_blocks_meet(spark):
    rows = [[int((x * 7 + y * 13) % 5 < 2 or (x // 9 + y // 8) % 3 == 0) for x in range(40)] for y in range(30)]
    d = cube(spark, rows).withColumn("other", F.lit("kept"))
    whole = focal.morphology(d, "v", "m", ["tile"], [(3, 1), (3, 0), (5, 0), (2, 1)])
    parts = focal.morphology(d, "v", "m", ["tile"], [(3, 1), (3, 0), (5, 0), (2, 1)], block=8)
    assert grid_of(whole, "m") == grid_of(parts, "m") and parts.filter("other <> 'kept'").count() == 0


def test_deviations_to_round_on(spark):
    """A distance just under a half of the last digit: as a float it would be rounded up."""
    rows = [(0, 0, 0, a, a, a, a, a, a) for a in (10_000, 20_000)]
    d = spark.createDataFrame(rows, ["tile", "y", "x", *BANDS])
    scale = 0.65244999 / (5_000 * math.sqrt(6))
    r = geomad.geomad(d, BANDS, ["tile"], iterations=0, scale=scale, kind="double").select(F.col("emad"), F.round("emad", 4).alias("e")).first()
    assert abs(r["emad"] - 0.65244999) < 1e-14 and r["e"] == 0.6524
    least = geomad.geomad(d, BANDS, ["tile"], iterations=0, scale=scale)
    assert dict(least.dtypes)["emad"] == "float"
