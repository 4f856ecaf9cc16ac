"""Cleaning of dirty text: upper case, products and addresses."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text formats that the data producers use.
PRODUCT_ID = r"([a-zA-Z]+_\d+)"
PRODUCT_SIGNS = ",-"
POSTAL_CODE = r"\b(\d{5})\b"


def uppercase(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.upper(c) for c in columns})


def product_parts(text: Column) -> tuple[Column, Column]:
    """Id and name held in one product text, both in upper case.

    Every comma and hyphen goes, also inside the name. A text without an id
    gives an empty id, not null.
    """
    plain = F.translate(text, PRODUCT_SIGNS, "")
    name = F.trim(F.regexp_replace(plain, PRODUCT_ID, ""))
    return F.upper(F.regexp_extract(plain, PRODUCT_ID, 1)), F.upper(name)


def split_product(df: DataFrame, column: str = "product") -> DataFrame:
    """Replace a product text by `product_id` and `product_name`."""
    product_id, product_name = product_parts(F.col(column))
    return df.withColumns({"product_id": product_id, "product_name": product_name}).drop(column)


def split_address(df: DataFrame, column: str = "address", output: str = "address") -> DataFrame:
    """Take the 5-digit postal code out of an address text.

    The first 5-digit word becomes `postal_code`; all of them leave the text.
    """
    plain = F.replace(F.col(column), F.lit(","), F.lit(""))
    return df.withColumns(
        {
            "postal_code": F.regexp_extract(plain, POSTAL_CODE, 1).try_cast("int"),
            output: F.trim(F.regexp_replace(plain, POSTAL_CODE, "")),
        }
    )
