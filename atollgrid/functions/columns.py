"""Column expressions of the raster domain. Each takes and gives Columns (or names), all run inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How surface reflectance is stored, its two nodata codes, and the code of missing classes.
SCALE, OFFSET = 2.75e-5, -0.2
RAW_NODATA = (0, 65535)
CLASS_NODATA = 255
UNSCALED = ("count", "emad", "smad", "bcmad")
NAN, INF = float("nan"), float("inf")
#: Names of quality bits from bit 0.
QA_BITS = ("fill", "dilated", "cirrus", "cloud", "shadow", "snow", "clear", "water")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_divide(a, b) -> Column:
    """A / b as floating point hardware does it: 0/0 and NaN give NaN, x/0 an infinity of x's sign."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    zero = F.when((a == 0) | F.isnan(a), F.lit(NAN)).when(a > 0, F.lit(INF)).otherwise(F.lit(-INF))
    return F.when(b == 0, zero).otherwise(F.try_divide(a, b))


def scale_reflectance(raw) -> Column:
    """Raw numbers to reflectance in [0, 1]; nodata, told on the raw number, is NaN."""
    raw = _c(raw)
    v = F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw * F.lit(SCALE) + F.lit(OFFSET)))
    return F.when(raw.isin(*RAW_NODATA), F.lit(NAN)).otherwise(v).cast("float")


def spectral_indices(nir="nir08", red="red", green="green", blue="blue", swir1="swir16", swir2="swir22") -> dict[str, Column]:
    """Eight indices of reflectance; NaN where an input is, and where 0 is divided by 0."""
    n, r, g, b, s1, s2 = (_c(x).cast("double") for x in (nir, red, green, blue, swir1, swir2))
    norm = lambda x, y: ieee_divide(x - y, x + y)
    ndvi = norm(n, r)
    return {
        "ndvi": ndvi,
        "ndwi": norm(g, n),
        "mndwi": norm(g, s1),
        "ndti": norm(r, g),
        "bsi": norm(s1 + r, n + b),
        "mbi": ieee_divide(s1 - s2 - n, s1 + s2 + n) + F.lit(0.5),
        "baei": ieee_divide(r + F.lit(0.3), g + s1),
        "bui": norm(s1, n) - ndvi,
    }


def probability_binary(p, threshold, nodata: int = CLASS_NODATA) -> Column:
    """Nodata stays, else whether p reaches the threshold as 1 or 0."""
    p = _c(p)
    return F.when(p == nodata, F.lit(nodata)).when(p >= threshold, F.lit(1)).otherwise(F.lit(0))


def whole_percent(p) -> Column:
    """A chance as whole percent, cut off, not rounded: 0.2999 is 29."""
    return F.floor(_c(p) * 100).cast("int")


def confident_class(cls, percent, threshold, nodata: int = CLASS_NODATA) -> Column:
    """The class where its whole percent reaches the threshold, else nodata."""
    return F.when(probability_binary(percent, threshold, nodata) == 1, _c(cls)).otherwise(F.lit(nodata))


def stretch(v, low: float, high: float) -> Column:
    """V clipped to [low, high] as a share of that range; NaN stays."""
    v = _c(v).cast("double")
    return F.when(F.isnan(v), F.lit(NAN)).otherwise((F.greatest(F.lit(low), F.least(F.lit(high), v)) - F.lit(low)) / F.lit(high - low))


def rescale_byte(v, low: float, high: float) -> Column:
    """V clipped to [low, high] as 0 to 255, cut off."""
    return F.floor(stretch(v, low, high) * 255).cast("int")


def class_color(cls, colors: dict[int, str]) -> Column:
    """A class's colour, null for a class without one."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in colors.items() for x in kv]), _c(cls).cast("int"))


def qa_names(qa) -> Column:
    """Names of the bits that are set, comma-joined from bit 0."""
    return F.array_join(F.filter(F.array(*[F.when(_c(qa).bitwiseAND(F.lit(1 << i)) != 0, F.lit(n)) for i, n in enumerate(QA_BITS)]), lambda x: x.isNotNull()), ",")


def tooltip(values: list, labels: list[str]) -> Column:
    """`label=value` of each value, comma-joined; null where all are 0, 255 or null."""
    v = [_c(x) for x in values]
    idle = F.forall(F.array(*v), lambda x: x.isNull() | x.isin(0, 255))
    return F.when(~idle, F.concat_ws(", ", *[F.concat(F.lit(n + "="), x.cast("string")) for n, x in zip(labels, v, strict=True)]))


def degrees_label(v, positive: str, negative: str) -> Column:
    """Two decimals of the size, and the side."""
    return F.concat(F.format_string("%.2f", F.abs(_c(v).cast("double"))), F.when(_c(v) < 0, F.lit(negative)).otherwise(F.lit(positive)))


def search_window(year, buffer: int = 1) -> Column:
    """A year's search interval; early years (to 2012) are widened both ways."""
    y = _c(year).cast("int")
    return F.when(y <= 2012, F.concat_ws("/", y - buffer, y + buffer)).otherwise(y.cast("string"))


def tier_filter(year, region) -> Column:
    """Whether only first-tier scenes count: everywhere but for early Pacific years."""
    return ~((_c(year).cast("int") <= 2012) & (_c(region) == "pacific"))


def owner_prefix(region, explicit=None) -> Column:
    """P20: the given owner, else the region's."""
    of = F.when(_c(region) == "pacific", F.lit("dep")).otherwise(F.lit("ci"))
    return of if explicit is None else F.coalesce(F.nullif(_c(explicit), F.lit("")), of)


def bucket_url(bucket) -> Column:
    """Where a bucket is read: addresses as they are, dotted names as hosts, others as object-store hosts."""
    b = _c(bucket)
    return F.when(b.startswith("https://"), b).when(F.instr(b, ".") > 0, F.concat(F.lit("https://"), b)).otherwise(F.concat(F.lit("https://"), b, F.lit(".s3.us-west-2.amazonaws.com")))


def item_key(prefix, sensor: str, dataset: str, version: str, x, y, year) -> Column:
    """An item document's key, its tile padded to three digits, its version with dashes."""
    name, v = f"{sensor}_{dataset}", version.replace(".", "-")
    x, y, yr = F.lpad(_c(x).cast("string"), 3, "0"), F.lpad(_c(y).cast("string"), 3, "0"), _c(year).cast("string")
    stem = F.concat_ws("_", F.concat(_c(prefix), F.lit("_" + name)), x, y, yr)
    return F.concat_ws("/", F.concat(_c(prefix), F.lit("_" + name)), F.lit(v), x, y, yr, F.concat(stem, F.lit(".stac-item.json")))


def tile_id_parts(tile) -> Column:
    """(x, y) of a tile id with `,`, `-` or `_` between exactly two whole numbers, else null."""
    p = F.split(_c(tile), "[,_-]")
    ok = (F.size(p) == 2) & _c(tile).rlike(r"^\d+[,_-]\d+$")
    return F.when(ok, F.struct(F.try_element_at(p, F.lit(1)).cast("int").alias("x"), F.try_element_at(p, F.lit(2)).cast("int").alias("y")))


def s3_url(url, http_prefix: str, bucket: str) -> Column:
    """An address under http_prefix as an object-store one; only a literal `:1` is stripped from its end."""
    return F.regexp_replace(F.replace(_c(url), F.lit(http_prefix), F.lit(f"s3://{bucket}")), r":1$", "")


def self_link(links) -> Column:
    """P25: href of the last link whose rel is self; null without one."""
    return F.try_element_at(F.filter(_c(links), lambda x: x["rel"] == "self"), F.lit(-1))["href"]


def year_bounds(first, last) -> dict[str, Column]:
    """Start, middle and end of the years that first and last lie in, as UTC text with milliseconds."""
    a, b = F.year(_c(first)), F.year(_c(last))
    text = lambda y, rest: F.concat(y.cast("string"), F.lit(rest))
    return {
        "start_datetime": text(a, "-01-01T00:00:00.000Z"),
        "datetime": text(F.floor((a + b) / 2).cast("int"), "-06-30T00:00:00.000Z"),
        "end_datetime": text(b, "-12-31T23:59:59.000Z"),
    }


def web_mercator_pacific(lon, lat) -> tuple[Column, Column]:
    """Longitude and latitude to EPSG:3832 metres (Mercator about 150 degrees east, ellipsoidal)."""
    a, e = 6378137.0, 0.0818191908426215
    lam, phi = F.radians(F.pmod(_c(lon) - F.lit(150.0) + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)), F.radians(_c(lat))
    s = F.sin(phi)
    return lam * a, F.lit(a) * (F.log(F.tan(phi / 2 + math.pi / 4)) - F.lit(e / 2) * F.log((1 + F.lit(e) * s) / (1 - F.lit(e) * s)))


def equal_area(lon, lat) -> tuple[Column, Column]:
    """Longitude and latitude to EPSG:6933 metres (cylindrical equal-area, true at 30 degrees)."""
    a, e = 6378137.0, 0.0818191908426215
    s30, c30 = math.sin(math.pi / 6), math.cos(math.pi / 6)
    k0 = c30 / math.sqrt(1 - (e * s30) ** 2)
    s = F.sin(F.radians(_c(lat)))
    q = F.lit(1 - e * e) * (s / (1 - F.lit(e * e) * s * s) - F.lit(1 / (2 * e)) * F.log((1 - F.lit(e) * s) / (1 + F.lit(e) * s)))
    return F.radians(_c(lon)) * F.lit(a * k0), F.lit(a / (2 * k0)) * q


#: Region: origin of tile (0, 0) and tile width in metres. The Pacific origin is a working value, to be configured.
GRIDS = {"non-pacific": (-20_000_000.0, -10_000_000.0, 96_000.0), "pacific": (-3_000_000.0, -4_000_000.0, 96_000.0)}


def grid_tile(x, y, region: str = "non-pacific") -> tuple[Column, Column]:
    """Numbers of the tile that projected metres lie in, y growing northward."""
    ox, oy, w = GRIDS[region]
    return F.floor((_c(x) - F.lit(ox)) / F.lit(w)).cast("int"), F.floor((_c(y) - F.lit(oy)) / F.lit(w)).cast("int")


def antimeridian_boxes(west, east) -> Column:
    """The longitude ranges of a box, two where it crosses the antimeridian (west over east)."""
    w, e = _c(west).cast("double"), _c(east).cast("double")
    box = lambda a, b: F.struct(a.alias("west"), b.alias("east"))
    return F.when(w > e, F.array(box(w, F.lit(180.0)), box(F.lit(-180.0), e))).otherwise(F.array(box(w, e)))
