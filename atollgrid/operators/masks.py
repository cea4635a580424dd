"""Quality-bit masks of observations (P4 to P7), by columns alone: no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the quality band.
FILL, CLOUD, SHADOW, SNOW, CLEAR, WATER = 1, 8, 16, 32, 64, 128


def _put(df: DataFrame, bands, masked: Column, nodata: int) -> DataFrame:
    return df.withColumns({b: F.when(masked, F.lit(nodata).cast(df.schema[b].dataType)).otherwise(F.col(b)) for b in bands})


def nodata(bands: list[str], qa: str = "qa_pixel") -> Column:
    return reduce(Column.__or__, [F.col(b) == 0 for b in bands]) | (F.col(qa).bitwiseAND(F.lit(FILL)) != 0)


def cloud(qa: str = "qa_pixel") -> Column:
    """Neither clear nor snow nor water, and no empty pixel."""
    q = F.col(qa)
    return (q.bitwiseAND(F.lit(CLEAR | SNOW | WATER)) == 0) & ~q.isin(0, 1)


def shadow(qa: str = "qa_pixel") -> Column:
    q = F.col(qa)
    return (q.bitwiseAND(F.lit(SHADOW)) != 0) & ~q.isin(0, 1) & (q.bitwiseAND(F.lit(CLEAR)) == 0)


def mask_nodata(df: DataFrame, bands: list[str], qa: str = "qa_pixel", value: int = 0) -> DataFrame:
    """All bands to nodata where one is 0 or the fill bit is set; quality bands stay."""
    return _put(df, bands, nodata(bands, qa), value)


def mask_cloud_and_shadow(df: DataFrame, bands: list[str], qa: str = "qa_pixel", include_shadow: bool = True, value: int = 0, mask: Column | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """P5: bands, quality and `also` to nodata under cloud and, if asked, shadow. `mask` stands in for them after
    morphological clean-up (focal.clean_mask)."""
    found = mask if mask is not None else cloud(qa) | (shadow(qa) if include_shadow else F.lit(False))
    return _put(df, [*bands, *also, qa], found, value)


def mask_saturated(df: DataFrame, bands: list[str], saturation: str = "qa_radsat", also: tuple[str, ...] = (), value: int = 0) -> DataFrame:
    """Bands and `also` to nodata where a band is saturated; nothing without the column."""
    return _put(df, [*bands, *[c for c in also if c in df.columns]], F.col(saturation) != 0, value) if saturation in df.columns else df


def mask_observations(df: DataFrame, bands: list[str], include_shadow: bool = True) -> DataFrame:
    """Nodata, then cloud and shadow, then saturation; the order counts, as the second zeroes quality bands."""
    df = mask_nodata(df, bands)
    df = mask_cloud_and_shadow(df, bands, include_shadow=include_shadow, also=("qa_radsat",))
    return mask_saturated(df, bands, also=("qa_pixel",))
