"""Coordinates to `latitude` and `longitude`."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGNED_PAIR = r"\(\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*\)"
# Fixed value: the pattern of the original jobs. It loses the sign and keeps one
# whole digit of the longitude; use it only to reproduce their tables.
UNSIGNED_PAIR = r"(\d+\.\d+).+(\d+\.\d+)"


def split_coord_text(df: DataFrame, column: str = "coord", pattern: str = SIGNED_PAIR) -> DataFrame:
    """Replace a `(lat, lon)` text by two doubles, null where it does not match."""
    return df.withColumns(
        {
            "latitude": F.regexp_extract(column, pattern, 1).try_cast("double"),
            "longitude": F.regexp_extract(column, pattern, 2).try_cast("double"),
        }
    ).drop(column)


def split_coord_array(
    df: DataFrame, column: str = "coord", cast: str | None = "double"
) -> DataFrame:
    """Replace a `[lat, lon]` array by two columns; a missing item gives null.

    With `cast=None` the element type stays as it is.
    """
    items = {name: F.get(column, F.lit(i)) for i, name in enumerate(("latitude", "longitude"))}
    if cast:
        items = {name: item.cast(cast) for name, item in items.items()}
    return df.withColumns(items).drop(column)
