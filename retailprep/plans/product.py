"""Product master data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import crc_code
from ..functions.retail import is_old_season, level5_name, season_year
from ..functions.text import is_blank, parse_decimal, sku, suffixed
from ..operators.attributes import consensus, join_attributes, pivot_attributes
from ..operators.enrich import exclude_value, keep_active, keep_known, new_rows
from ..operators.keys import dedupe
from ..operators.quality import Check, Report, blank_check, quality_counts, quality_report, require_keys
from ..operators.schema import Spec, attribute_columns, check_columns, clean_name, conform
from ..session import settle
from ..sources.read import find_column, with_columns_or_null

# Fixed values of the contract.
REQUIRED = (
    "product_code",
    "option_code",
    "size_code",
    "product_description",
    "brand",
    "product_group_1_code",
    "product_group_1_description",
)
# Fixed values of the contract.
TECHNICAL_GROUP = "-1"
# The names the dictionary's code has had.
DICTIONARY = {"product_code": (("product_code", "external_id", "code"), "string")}
NUMBERS = {"tax_rate": (7, 4), "price_with_tax": (10, 2), "cogs": (10, 2)}

# Target columns of the product feed.
PRODUCT = Spec(
    columns={
        "external_id": "string",
        "code": "string",
        "name": "string",
        "unit_of_measure_code": "string",
        "parent_product_code": "string",
        "parent_product_name": "string",
        "start_selling_date": "date",
        "product_brand_name": "string",
        "product_brand_code": "string",
        "tax_rate": "decimal(7,4)",
        "is_active": "int",
        "category_level1_name": "string",
        "category_level1_code": "string",
        "category_level2_name": "string",
        "category_level2_code": "string",
        "category_level3_name": "string",
        "category_level3_code": "string",
        "category_level4_name": "string",
        "category_level4_code": "string",
        "category_level5_name": "string",
        "category_level5_code": "string",
        "model_code": "string",
        "size_code": "string",
        "color_code": "string",
        "price_with_tax": "decimal(10,2)",
        "season": "string",
        "cogs": "decimal(10,2)",
        "currency": "string",
        "sku": "string",
        "store_department": "string",
        "salesfloor_segment": "int",
        "stockroom_segment": "int",
    },
    mapping={
        "external_id": "product_code",
        "code": "product_code",
        "name": "option_code",
        "parent_product_code": "option_code",
        "parent_product_name": "product_description",
        "product_brand_name": "brand",
        "product_brand_code": "brand",
        "category_level1_name": "product_group_1_description",
        "category_level1_code": "product_group_1_code",
        "category_level2_name": "product_group_2_description",
        "category_level2_code": "product_group_2_code",
        "category_level3_name": "product_group_3_description",
        "category_level3_code": "product_group_3_code",
        "category_level4_name": "product_group_4_description",
        "category_level4_code": "product_group_4_code",
        "store_department": "storedepartment",
        "salesfloor_segment": "salesfloorsegmentqty",
        "stockroom_segment": "stockroomsegmentqty",
    },
    constants={"unit_of_measure_code": "ST", "start_selling_date": "2023-01-01"},
)


def _group_columns(df: DataFrame) -> list[str]:
    names = [f"product_group_{i}_{part}" for i in range(1, 6) for part in ("description", "code")]
    return [n for n in names if find_column(df, n)]


def active_catalogue(raw: DataFrame, active: DataFrame) -> DataFrame:
    """Active products without technical groups, one row per code.

    Of several rows per code the smallest by all other columns is taken.
    Products without a group are dropped together with the technical ones.
    """
    df = require_keys(check_columns(raw, REQUIRED, "product"), ["product_code"])
    df = exclude_value(df, "product_group_1_code", TECHNICAL_GROUP)
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != "product_code"]
    # a code with very many rows shrinks before the join; Catalyst joins first if it can broadcast
    return keep_active(dedupe(df, ["product_code"], rest), active, "product_code")


def with_level5(df: DataFrame) -> DataFrame:
    """Add the fifth category: the sex/department attribute, if there is one, and level 4."""
    attribute = next((c for c in df.columns if clean_name(c) == "sex_department"), None)
    name = level5_name(None if attribute is None else f"`{attribute}`", "product_group_4_description")
    return df.withColumn("category_level5_name", name).withColumn(
        "category_level5_code", crc_code("category_level5_name", "_l5")
    )


def enriched_products(
    raw: DataFrame,
    attributes: DataFrame,
    definitions: DataFrame,
    active: DataFrame,
    attribute_names: Sequence[str] | None = None,
    settled: bool = False,
    as_tuple: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Active products with attributes, numbers, SKU and categories their siblings agree on.

    Also returns the names of the attributes that came with them.  The vote on
    categories reads the products twice; ``settled`` writes them to the shared
    folder first, so that they are computed once.  ``as_tuple`` lets siblings
    vote on all categories together.
    """
    products = active_catalogue(raw, active)
    optional = [*NUMBERS, "product_group_4_description"]
    products = with_columns_or_null(products, optional)
    pivoted = pivot_attributes(
        attributes, definitions, "product_code", "uda_code", "uda_description", "uda_value", attribute_names
    )
    # before the pivot if Catalyst can broadcast the active codes
    pivoted = keep_known(pivoted, active, ["product_code"])
    names = [c for c in pivoted.columns if c != "product_code" and find_column(products, c) is None]
    df = join_attributes(products, pivoted, "product_code", unique=True)
    changes = {c: parse_decimal(c, *NUMBERS[c]) for c in NUMBERS}
    for i in range(1, 6):
        code = find_column(df, f"product_group_{i}_code")
        if code:
            changes[code] = suffixed(code, f"_l{i}")
    changes["sku"] = sku("option_code", "size_code")
    df = with_level5(df.withColumns(changes))
    if settled:
        df = settle(df)
    voted = [*_group_columns(df), "category_level5_name", "category_level5_code"]
    return consensus(df, "option_code", voted, as_tuple), names


def product_feed(
    raw: DataFrame,
    attributes: DataFrame,
    definitions: DataFrame,
    active: DataFrame,
    attribute_names: Sequence[str] | None = None,
    known: DataFrame | None = None,
    settled: bool = False,
) -> DataFrame:
    """The product feed; with ``known`` (product_code) only products not delivered before (DELTA)."""
    df, names = enriched_products(raw, attributes, definitions, active, attribute_names, settled)
    return product_output(df, names, known)


def product_output(df: DataFrame, names: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """Enriched products in the feed's columns, followed by the attributes ``names``; only new ones with ``known``."""
    if known is not None:
        df = new_rows(df, known, ["product_code"])
    return conform(df, PRODUCT, attribute_columns(df, names, PRODUCT.columns))


def product_counts() -> Report:
    """Quality report on raw products: blanks in what a product must have."""
    return quality_counts([blank_check(c) for c in REQUIRED])


def product_report(raw: DataFrame) -> DataFrame:
    """See ``product_counts``."""
    return product_counts().of(check_columns(raw, REQUIRED, "product"))


def department_report(df: DataFrame) -> DataFrame:
    """Active products without a department (NULL, blank or 0)."""
    column = find_column(df, "storedepartment", "store_department")
    missing = is_blank(column) | (F.trim(F.col(column)) == "0")
    return quality_report(df, [Check("no_department", "store_department", "WARN", missing)])


def catalogue_stats(raw: DataFrame, active: DataFrame, known: DataFrame) -> DataFrame:
    """One row of counts: catalogue rows, rows and products per stage, new and skipped ones.

    ``skipped`` compares catalogue rows with active products after all filters.
    """
    df = require_keys(raw, ["product_code"])
    flags = {
        "active": active.select("product_code").distinct().withColumn("active", F.lit(1)),
        "known": known.select("product_code").distinct().withColumn("known", F.lit(1)),
    }
    # one row per product before the joins: a code with very many rows shrinks map-side
    technical = ~(F.col("product_group_1_code") != TECHNICAL_GROUP)
    per_code = df.groupBy("product_code").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(technical, F.lit(True))).alias("technical"),
    )
    for flag in flags.values():
        per_code = per_code.join(flag, "product_code", "left")
    is_active = F.col("active").isNotNull()
    kept = F.col("rows") - F.col("technical")
    counted = per_code.agg(
        F.sum("rows").alias("catalogue"),
        F.coalesce(F.sum(F.when(is_active, F.col("rows"))), F.lit(0)).alias("active_rows"),
        F.coalesce(F.sum(F.when(is_active, F.col("technical"))), F.lit(0)).alias("technical_rows"),
        F.coalesce(F.sum(F.when(is_active & (kept > 0), kept - 1)), F.lit(0)).alias("duplicate_rows"),
        F.count_if(is_active & (kept > 0)).alias("active_products"),
        F.count_if(is_active & (kept > 0) & F.col("known").isNull()).alias("new_products"),
    )
    return counted.withColumn("skipped", F.col("catalogue") - F.col("active_products"))


def season_stats(products: DataFrame, known: DataFrame, year: int, back: int = 1) -> DataFrame:
    """New products per season with its year and whether it is an old one, most frequent first."""
    counts = new_rows(products, known, ["product_code"]).groupBy("season").agg(
        F.count(F.lit(1)).alias("products")
    )
    return counts.select(
        "season",
        season_year("season").alias("season_year"),
        is_old_season("season", year, back).alias("is_old"),
        "products",
    ).orderBy(F.desc("products"), F.col("season").asc_nulls_last())
