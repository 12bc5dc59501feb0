"""Name functions: file-name dates, directory names and sanitised names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Replacements of a country's name, applied in this order.
SANITISE = [("/", ""), ("  ", "_"), ("&", ""), (" ", "_"), (":", "_"), ("__", "_"), ("'", "")]
# Misspelt names.
CORRECTIONS = [("Paua", "Papua")]


def sanitise(name: Column) -> Column:
    for a, b in SANITISE:
        name = F.replace(name, F.lit(a), F.lit(b))
    return name


def region_directory(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit(": "), F.lit("_")), F.lit(" "), F.lit("_"))


def corrected(name: Column) -> Column:
    name = F.replace(name, F.lit("'"), F.lit(""))
    for a, b in CORRECTIONS:
        name = F.replace(name, F.lit(a), F.lit(b))
    return name


def date_from_dotted(path: Column) -> Column:
    """The date in a name such as product.2020.01.31.nc; null without one."""
    part = lambda i: F.regexp_extract(path, r"\.(\d{4})\.(\d{2})\.(\d{2})\.", i)
    return F.when(part(1) != "", F.to_date(F.concat_ws("-", part(1), part(2), part(3))))


def date_from_day_number(path: Column) -> Column:
    """The date in a name such as 2020031.nc: year and day of year; null without one."""
    digits = F.regexp_extract(path, r"(\d{7})\.[A-Za-z0-9]+$", 1)
    return F.when(digits != "", F.date_add(F.to_date(F.concat(F.substring(digits, 1, 4), F.lit("-01-01"))), F.substring(digits, 5, 3).cast("int") - 1))


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def place(station: Column, country: Column) -> Column:
    return F.concat_ws(", ", station, country)


def rgb_from_hex(colour: Column) -> Column:
    """(r, g, b) of "#rrggbb"."""
    part = lambda i: F.conv(F.substring(F.replace(colour, F.lit("#"), F.lit("")), i, 2), 16, 10).cast("int")
    return F.array(part(1), part(3), part(5))


def hex_from_rgb(r: Column, g: Column, b: Column) -> Column:
    return F.concat(F.lit("#"), *[F.lpad(F.lower(F.hex(x.cast("long"))), 2, "0") for x in (r, g, b)])
