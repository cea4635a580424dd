"""The driver's tables seen as rasters, items and tasks: expressions that both engines evaluate alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BANDS = ["nir08", "red", "green", "blue", "swir16", "swir22"]

_QA = {0: 21824, 1: 22280, 2: 23824, 3: 23888, 4: 21952, 5: 30048, 6: 1, 7: 0}
_CODES = {  # product codes that mean classes 1 to 7 and no data
    "wc_code": (10, 20, 40, 90, 50, 80, 60, 0),
    "cci_code": (50, 110, 10, 160, 190, 210, 200, 0),
    "io_code": (2, 11, 5, 4, 7, 1, 8, 0),
}


def _case(of: str, values: dict) -> str:
    return f"CASE {of} " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + " END"


_CELL = "CAST(floor((p_partkey % 50) / 6) * 3 + floor(floor(p_partkey / 50) / 5) * 7 AS BIGINT)"
ADAPTERS: dict[str, tuple[str, dict[str, str]]] = {
    # a stack of observations: a pixel a part, an observation a line item
    "px_obs": ("lineitem", {
        "tile": "CAST(0 AS INT)", "y": "CAST(floor(l_partkey / 50) AS INT)", "x": "CAST(l_partkey % 50 AS INT)",
        "time": "l_shipdate", "scene": "l_orderkey * 8 + l_linenumber",
        **{b: f"CASE WHEN (l_orderkey + {k}) % 23 = 0 THEN 0 ELSE CAST(7273 + (CAST(floor(l_extendedprice * 100) AS BIGINT) + {k} * 7919 * l_linenumber) % 36363 AS INT) END" for k, b in enumerate(BANDS)},
        "qa_pixel": _case("l_orderkey % 8", _QA), "qa_radsat": "CASE WHEN l_orderkey % 17 = 0 THEN 4 ELSE 0 END",
    }),
    # a dense grid of layers: a pixel a part
    "px_grid": ("part", {
        "tile": "CAST(0 AS INT)", "pixel": "p_partkey", "y": "CAST(floor(p_partkey / 50) AS INT)", "x": "CAST(p_partkey % 50 AS INT)",
        **{b: f"CASE WHEN (p_partkey + {k}) % 23 = 0 THEN 0 ELSE CAST(7273 + (CAST(floor(p_retailprice * 100) AS BIGINT) * {k + 3} + p_partkey * {7919 * (k + 1)}) % 36363 AS INT) END" for k, b in enumerate(BANDS)},
        "wc_code": _case(f"{_CELL} % 8", dict(enumerate(_CODES["wc_code"]))),
        "cci_code": _case(f"({_CELL} + CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END) % 8", dict(enumerate(_CODES["cci_code"]))),
        "io_code": _case(f"({_CELL} + CASE WHEN p_partkey % 11 = 0 THEN 2 ELSE 0 END) % 8", dict(enumerate(_CODES["io_code"]))),
        **{f"q{i}": f"CAST((p_size + {i}) % 5 - 1 AS INT)" for i in (1, 2, 3)},
        "part_of": "CAST(floor(floor(p_partkey / 50) / 8) AS INT)", "processed": "CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END",
        "changes": "CASE WHEN p_size % 2 = 0 THEN 0 ELSE 1 END", "observations": "CAST(CASE WHEN floor(floor(p_partkey / 50) / 8) % 2 = 0 THEN p_partkey % 3 ELSE p_partkey % 6 END AS INT)",
        "elevation": "CAST(p_retailprice AS DOUBLE)",
    }),
    # catalogue items with boxes and intervals: an item an order
    "items": ("orders", {
        "id": "o_orderkey", "href": "concat('https://example.com/items/', CAST(o_orderkey AS VARCHAR(20)))",
        "west": "CAST((o_orderkey * 37) % 3400 AS DOUBLE) / 10 - 170", "east": "CAST((o_orderkey * 37) % 3400 AS DOUBLE) / 10 - 170 + 2",
        "south": "CAST((o_orderkey * 53) % 1600 AS DOUBLE) / 10 - 80", "north": "CAST((o_orderkey * 53) % 1600 AS DOUBLE) / 10 - 80 + 1.5",
        "start": "o_orderdate", "tier": "CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'T1' ELSE 'T2' END",
    }),
    # countries with projected boxes: a country a nation
    "countries": ("nation", {
        "nation": "n_nationkey", "name": "n_name", "region": "CASE WHEN n_regionkey % 2 = 0 THEN 'pacific' ELSE 'non-pacific' END",
        **{"x0": "CAST(n_nationkey AS DOUBLE) * 70000 - 900000", "y0": "CAST((n_nationkey * 7) % 11 AS DOUBLE) * 90000 - 400000"},
        "x1": "CAST(n_nationkey AS DOUBLE) * 70000 - 900000 + 200000", "y1": "CAST((n_nationkey * 7) % 11 AS DOUBLE) * 90000 - 400000 + 150000",
    }),
    "tasks": ("customer", {
        "id": "concat(CAST(c_custkey % 320 AS VARCHAR(9)), '_', CAST((c_custkey * 7) % 140 AS VARCHAR(9)))", "tx": "c_custkey % 320", "ty": "(c_custkey * 7) % 140",
        "year": "CAST(2005 + c_custkey % 20 AS VARCHAR(4))", "region": "CASE WHEN c_nationkey % 2 = 0 THEN 'pacific' ELSE 'non-pacific' END", "task": "c_custkey",
    }),
    "scenes": ("events", {"event": "event_id", "time": "ts", "platform": "event_type", "sensor": "user_id"}),
}
FEATURES = [f"f{i}" for i in range(6)]


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = ADAPTERS[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def cte(name: str) -> str:
    table, columns = ADAPTERS[name]
    return f"{name} AS (SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns.items()) + f" FROM {table})"


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return d.selectExpr("vec_id AS id", "CAST(label AS INT) AS lulc", *[f"CAST(embedding[{i}] AS DOUBLE) AS f{i}" for i in range(6)])


SAMPLES_CTE = "samples AS (SELECT vec_id AS id, CAST(label AS INT) AS lulc, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(6)) + " FROM embeddings)"
