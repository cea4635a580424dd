"""Seeded sampling by ranked hashes, splits, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of the hash that ranks are taken in: ranks then need no task to hold a whole class.
BUCKETS = 256


def hash_rank(id_: Column, seed: int = 42) -> Column:
    """A row's place in a fixed random order that any SQL engine can compute: (id's low and high 32 bits, and the seed, as
    one number of 32 bits) * an odd number of 31 bits, modulo 2 ** 32. No product leaves 63 bits, whatever the id."""
    word = F.lit(4294967296)
    mixed = F.pmod(id_, word) + F.pmod(F.shiftright(id_, 32), F.lit(2147483648)) * F.lit(40503) + F.lit(seed)
    return F.pmod(F.pmod(mixed, word) * F.lit(1540483477), word)


def quotas(df: DataFrame, cls: str, method: str, n: int, least: int = 5, manual: dict[str, int] | None = None) -> DataFrame:
    """(class, quota) of each class of df: T6a by share, at least `least`, all where there aren't so many, rounded half
    to even; T6b equal shares, at most what there is; T6d as given by text keys, at most what there is."""
    have = df.groupBy(F.col(cls).alias("class")).agg(F.count(F.lit(1)).alias("have"))
    total = Window.partitionBy(F.lit(0))  # over classes
    if method == "stratified_random":
        want = F.greatest(F.lit(float(least)), F.lit(n) * F.col("have") / F.sum("have").over(total))
        quota = F.when(F.col("have") >= want, F.bround(want)).otherwise(F.col("have"))
    elif method == "equal_stratified_random":
        quota = F.least(F.floor(F.lit(n) / F.count(F.lit(1)).over(total)), F.col("have"))
    elif method == "manual":
        known = {str(r["class"]) for r in have.select("class").collect()}
        if not set(manual or {}) <= known:
            raise ValueError(f"classes that aren't there: {sorted(set(manual) - known)}")
        pairs = [F.lit(x) for kv in (manual or {}).items() for x in kv]
        quota = F.least(F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("class").cast("string")), F.lit(0)), F.col("have")) if pairs else F.lit(0)
    else:
        raise ValueError(f"no such sampling: {method}")
    return have.select("class", quota.cast("long").alias("quota"))


def sample(df: DataFrame, cls: str, id_: str, method: str = "stratified_random", n: int = 2100, least: int = 5, manual: dict[str, int] | None = None, drop: int | None = 0, seed: int = 42) -> DataFrame:
    """Seeded sample of df's rows, the first of each class in hash order."""
    d = df if drop is None else df.filter(F.col(cls) != drop)
    if method == "random":
        if n > d.count():
            raise ValueError("more rows asked for than there are")
        return d.withColumn("_h", hash_rank(F.col(id_), seed)).orderBy("_h", id_).limit(n).drop("_h")
    q = quotas(d, cls, method, n, least, manual)
    return take(d, q, cls, id_, seed)


def _ranked(d: DataFrame, cls: str, bucket: str, order: list) -> DataFrame:
    """d with `_r`, a row's rank in its class, and `_n`, the class's rows: ranks are taken within buckets that follow each
    other in the order, after the counts of those before, so that no task holds a class."""
    per = d.groupBy(F.col(cls).alias("_c"), F.col(bucket).alias("_k")).agg(F.count(F.lit(1)).alias("k"))
    of = Window.partitionBy("_c")  # a class's buckets
    per = per.select("_c", "_k", (F.sum("k").over(of.orderBy("_k")) - F.col("k")).alias("_before"), F.sum("k").over(of).alias("_n"))
    j = d.join(F.broadcast(per), F.col(cls).eqNullSafe(F.col("_c")) & F.col(bucket).eqNullSafe(F.col("_k")))  # classes * BUCKETS rows at most
    rank = F.row_number().over(Window.partitionBy("_c", "_k").orderBy(*order))
    return j.withColumn("_r", F.col("_before") + rank).drop("_c", "_k", "_before")


def _hashed(d: DataFrame, cls: str, id_: str, seed: int) -> DataFrame:
    d = d.withColumn("_h", hash_rank(F.col(id_), seed)).withColumn("_b", F.floor(F.col("_h") / (4294967296 // BUCKETS)))
    return _ranked(d, cls, "_b", ["_h", id_]).drop("_h", "_b")


def take(d: DataFrame, quota: DataFrame, cls: str, id_: str, seed: int = 42) -> DataFrame:
    """The first `quota` rows of each class (class, quota) in hash order."""
    ranked = _hashed(d, cls, id_, seed).join(F.broadcast(quota), F.col(cls) == F.col("class"))  # a row a class
    return ranked.filter(F.col("_r") <= F.col("quota")).select(*d.columns)


def stratified_split(df: DataFrame, cls: str, id_: str, share: float = 0.7, seed: int = 42) -> DataFrame:
    """Df with `train`: true for the first floor(share * n) rows of each class in hash order."""
    d = _hashed(df, cls, id_, seed)
    return d.withColumn("train", F.col("_r") <= F.floor(F.lit(share) * F.col("_n"))).drop("_r", "_n")


#: Agreement over which a class's pixels are training pixels.
TRAINING_THRESHOLD = {1: 95, 2: 80, 3: 80, 4: 80, 5: 95, 6: 95, 7: 95}


def training_pixels(df: DataFrame, cls: str, first: str, second: str, thresholds: dict[int, int] | None = None) -> DataFrame:
    """Pixels whose both agreements are over their class's threshold. One filter for all classes."""
    t = F.create_map(*[F.lit(x) for kv in (thresholds or TRAINING_THRESHOLD).items() for x in kv])
    limit = F.try_element_at(t, F.col(cls).cast("int"))
    return df.filter((F.col(first) > limit) & (F.col(second) > limit))


def worst(df: DataFrame, cls: str, distance: str, id_: str, share: float = 0.05) -> DataFrame:
    """Df with `outlier`: true for the max(1, floor(share * n)) rows of each class farthest off, ties by id. Rows are
    ranked between quantiles of their class's distances, which need not be exact for the ranks to be."""
    cuts = df.groupBy(F.col(cls).alias("_q")).agg(F.percentile_approx(distance, F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])).alias("_cuts"))
    d = df.join(F.broadcast(cuts), F.col(cls).eqNullSafe(F.col("_q")))  # a row a class
    d = d.withColumn("_b", F.aggregate("_cuts", F.lit(0), lambda n, x: n + (x > F.col(distance)).cast("int"))).drop("_q", "_cuts")
    d = _ranked(d, cls, "_b", [F.desc(distance), id_]).drop("_b")
    return d.withColumn("outlier", F.col("_r") <= F.greatest(F.lit(1), F.floor(F.lit(share) * F.col("_n")))).drop("_r", "_n")


def keep_first(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key; an aggregation, so copies are merged before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    best = F.min(F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], F.struct(*rest).alias("_v"))).alias("_m")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_m._v.{c}").alias(c) for c in rest]).select(*df.columns)
