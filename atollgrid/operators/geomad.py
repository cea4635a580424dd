"""A1 to A3: geometric median composite with three median deviations, per pixel, over a time stack."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pixels a side of a block that one task composites at a time.
BLOCK = 64


def clear_count(df: DataFrame, bands: list[str], key: list[str]) -> DataFrame:
    """A3: observations of each pixel in which every band is valid."""
    valid = ~F.greatest(*[(F.col(b) == 0).cast("int") for b in bands]).cast("boolean") if len(bands) > 1 else F.col(bands[0]) != 0
    return df.groupBy(*key, "y", "x").agg(F.count_if(valid).cast("int").alias("count"))


def require_timesteps(df: DataFrame, key: list[str], least: int = 10, time: str = "time") -> DataFrame:
    """A2: rows of tiles with enough time steps, counted before masking; raises if none has."""
    enough = df.groupBy(*key).agg(F.count_distinct(time).alias("n")).filter(F.col("n") >= least).select(*key)
    if enough.isEmpty():
        raise ValueError(f"no tile has {least} time steps")
    return df.join(enough, key, "left_semi")


def median_composite(df: DataFrame, bands: list[str], key: list[str]) -> DataFrame:
    """Band-wise median of valid observations, 0 where there are none, and the clear count. One shuffle."""
    ok = sum(((F.col(b) == 0).cast("int") for b in bands), F.lit(0)) == 0
    # a pixel's valid observations, at most its time steps, are gathered once and sorted band by band in the row
    d = df.groupBy(*key, "y", "x").agg(F.collect_list(F.when(ok, F.struct(*bands))).alias("_o"))
    d = d.withColumns({"count": F.size("_o"), **{f"_{b}": F.sort_array(F.col("_o").getField(b)) for b in bands}})
    middle = lambda b: f"(_{b}[int((count - 1) div 2)] + _{b}[int(count div 2)]) / 2D"
    return d.select(*key, "y", "x", *[F.expr(f"if(count = 0, 0, int(floor({middle(b)} + 0.5D)))").alias(b) for b in bands], "count")


def geometric_medians(x: np.ndarray, valid: np.ndarray, iterations: int = 100, tolerance: float = 1e-4) -> np.ndarray:
    """Weiszfeld's iteration for all pixels together: x pixels * times * bands, valid pixels * times. A pixel whose
    estimate has stopped moving leaves the iteration; distances are kept off zero, so a coincident point is harmless."""
    w = valid[..., None].astype(float)
    n = valid.sum(axis=1)
    m = (x * w).sum(axis=1) / np.maximum(n, 1)[:, None]
    live = np.flatnonzero(n > 1)
    for _ in range(iterations):
        if not len(live):
            break
        d = np.sqrt(((x[live] - m[live][:, None]) ** 2).sum(axis=2))
        k = valid[live] / np.maximum(d, 1e-9)
        new = (x[live] * k[..., None]).sum(axis=1) / k.sum(axis=1)[:, None]
        moved = np.sqrt(((new - m[live]) ** 2).sum(axis=1))
        m[live] = new
        live = live[moved > tolerance]
    return m


def deviations(x: np.ndarray, valid: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Medians over valid observations of cosine, Euclidean and Bray-Curtis distance to m; NaN without one."""
    with np.errstate(all="ignore"):
        c = m[:, None]
        cosine = 1 - (x * c).sum(2) / np.sqrt((x * x).sum(2) * (c * c).sum(2))
        found = (np.maximum(cosine, 0), np.sqrt(((x - c) ** 2).sum(2)), np.abs(x - c).sum(2) / np.abs(x + c).sum(2))
        import warnings

        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return tuple(np.nanmedian(np.where(valid, d, np.nan), axis=1) for d in found)


def geomad(df: DataFrame, bands: list[str], key: list[str], block: int = BLOCK, iterations: int = 100, scale: float = 1.0, offset: float = 0.0, kind: str = "float") -> DataFrame:
    """A1: per pixel the geometric median of each band (rounded to whole numbers, 0 without observation), smad, emad and
    bcmad (NaN without one) and count. Bands are stored numbers; the deviations are those of scale * number + offset (the
    median is the same by either), as `kind`: float, or double for those that are rounded on. Without iterations the estimate is the mean. One shuffle on blocks of pixels; a block's rows are its pixels' observations, so
    its size is set by `block`, not by the data's spread. Only the bands and keys are shuffled."""
    need = df.select(*key, "y", "x", *bands).withColumns({"_by": F.floor(F.col("y") / block), "_bx": F.floor(F.col("x") / block)})
    out = [*[f"`{f.name}` {f.dataType.simpleString()}" for f in need.select(*key, "y", "x").schema], *[f"`{b}` int" for b in bands], *[f"{c} {kind}" for c in ("smad", "emad", "bcmad")], "count int"]
    real = {"float": "float32", "double": "float64"}[kind]

    def composite(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["y", "x"], kind="stable")
        values, place = pdf[bands].to_numpy(float), pdf[["y", "x"]].to_numpy()
        first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]).any(axis=1)))
        size = np.diff(np.append(first, len(pdf)))
        pixel = np.repeat(np.arange(len(first)), size)
        time = np.arange(len(pdf)) - np.repeat(first, size)
        x, valid = np.zeros((len(first), int(size.max()), len(bands))), np.zeros((len(first), int(size.max())), bool)
        x[pixel, time], valid[pixel, time] = values, (values != 0).all(axis=1)
        m = geometric_medians(x, valid, iterations)
        s, e, b = deviations(x * scale + offset, valid, m * scale + offset)
        n = valid.sum(axis=1)
        res = {k: pdf[k].to_numpy()[first] for k in [*key, "y", "x"]}
        res |= {band: np.where(n > 0, np.floor(m[:, i] + 0.5), 0).astype("int32") for i, band in enumerate(bands)}
        return pd.DataFrame(res | {"smad": s.astype(real), "emad": e.astype(real), "bcmad": b.astype(real), "count": n.astype("int32")})

    done = need.groupBy(*key, "_by", "_bx").applyInPandas(composite, ", ".join(out))
    return done.withColumns({c: F.coalesce(c, F.lit(float("nan")).cast(kind)) for c in ("smad", "emad", "bcmad")})  # pandas gives null
