"""Countries of the two grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Names and three-letter codes.
PACIFIC = {
    "American Samoa": "ASM", "Cook Islands": "COK", "Fiji": "FJI", "French Polynesia": "PYF", "Guam": "GUM", "Kiribati": "KIR",
    "Marshall Islands": "MHL", "Micronesia": "FSM", "Nauru": "NRU", "New Caledonia": "NCL", "Niue": "NIU", "Northern Mariana Islands": "MNP",
    "Palau": "PLW", "Papua New Guinea": "PNG", "Pitcairn Islands": "PCN", "Samoa": "WSM", "Solomon Islands": "SLB", "Tokelau": "TKL",
    "Tonga": "TON", "Tuvalu": "TUV", "Vanuatu": "VUT", "Wallis and Futuna": "WLF",
}
OTHERS = {
    "Anguilla": "AIA", "Antigua and Barbuda": "ATG", "Aruba": "ABW", "Bahamas": "BHS", "Barbados": "BRB", "Belize": "BLZ", "Bermuda": "BMU",
    "British Virgin Islands": "VGB", "Cabo Verde": "CPV", "Cayman Islands": "CYM", "Comoros": "COM", "Cuba": "CUB", "Curaçao": "CUW",
    "Dominica": "DMA", "Dominican Republic": "DOM", "Grenada": "GRD", "Guadeloupe": "GLP", "Guinea-Bissau": "GNB", "Guyana": "GUY",
    "Haiti": "HTI", "Jamaica": "JAM", "Maldives": "MDV", "Martinique": "MTQ", "Mauritius": "MUS", "Montserrat": "MSR", "Puerto Rico": "PRI",
    "Saint Kitts and Nevis": "KNA", "Saint Lucia": "LCA", "Saint Vincent and the Grenadines": "VCT", "Seychelles": "SYC", "Singapore": "SGP",
    "Sint Maarten": "SXM", "Suriname": "SUR", "São Tomé and Príncipe": "STP", "Timor-Leste": "TLS", "Trinidad and Tobago": "TTO",
    "Turks and Caicos Islands": "TCA", "Virgin Islands, U.S.": "VIR",
}


def list_countries(grids: str = "all") -> dict[str, str]:
    """Names and codes of a grid's countries, by name; raises for a grid that isn't."""
    of = {"all": PACIFIC | OTHERS, "pacific": PACIFIC, "non-pacific": OTHERS}
    if grids not in of:
        raise ValueError(f"no such grid: {grids}; there are {', '.join(of)}")
    return dict(sorted(of[grids].items()))


def country_table(spark: SparkSession, grids: str = "all") -> DataFrame:
    """(name, code, region), by name."""
    rows = [(n, c, "pacific" if n in PACIFIC else "non-pacific") for n, c in list_countries(grids).items()]
    return spark.createDataFrame(rows, "name string, code string, region string")
