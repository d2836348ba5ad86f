"""Column functions over whole tables."""

from pyspark.sql import functions as F

from retailprep.functions import (
    DATE_FORMATS,
    normalise_country,
    parse_date,
    parse_decimal,
    split_variant,
    stable_code,
    strip_last,
)
from retailprep.operators.quality import require_keys

from .fixtures import with_clause
from .registry import query


def robust(c: str, p: int, s: int) -> str:
    return f"TRY_CAST(replace(regexp_replace({c}, '[^0-9,.-]', '', 'g'), ',', '.') AS DECIMAL({p},{s}))"


def strict(c: str, p: int, s: int) -> str:
    return f"TRY_CAST(replace(replace({c}, '\"', ''), ',', '.') AS DECIMAL({p},{s}))"


def date3(c: str) -> str:
    """First of the three date shapes that fits."""
    shapes = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%d.%m.%Y")
    return "COALESCE(" + ", ".join(f"CAST(try_strptime({c}, '{s}') AS DATE)" for s in shapes) + ")"


def code10(c: str) -> str:
    """Ten digits from SHA-256."""
    return f"lpad(CAST(CAST('0x' || substr(sha256({c}), 1, 15) AS BIGINT) % 10000000000 AS VARCHAR), 10, '0')"


def country(c: str) -> str:
    code = f"substr(upper(trim({c})), 1, 2)"
    return (
        f"CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'Eshop' WHEN {code} = 'PO' THEN 'PL' "
        f"WHEN {code} = 'SV' THEN 'SK' ELSE {code} END"
    )


@query(
    "parse_decimal",
    with_clause("inventory_raw")
    + f"""SELECT store_code, product_code,
        {robust('inventory', 15, 3)} AS amount_robust, {strict('inventory', 15, 3)} AS amount_strict,
        {robust('stock_cost', 15, 2)} AS cost_robust, {strict('stock_cost', 15, 2)} AS cost_strict
    FROM inventory_raw""",
)
def _(t):
    return t.inventory_raw.select(
        "store_code",
        "product_code",
        parse_decimal("inventory", 15, 3).alias("amount_robust"),
        parse_decimal("inventory", 15, 3, strict=True).alias("amount_strict"),
        parse_decimal("stock_cost", 15, 2).alias("cost_robust"),
        parse_decimal("stock_cost", 15, 2, strict=True).alias("cost_strict"),
    )


@query(
    "parse_date",
    with_clause("price_all")
    + f"SELECT product_agg_level_code, price_date, {date3('price_date')} AS start_date FROM price_all",
)
def _(t):
    return t.price_all.select(
        "product_agg_level_code", "price_date", parse_date("price_date", DATE_FORMATS).alias("start_date")
    )


@query(
    "normalise_country",
    with_clause("store_raw") + f"SELECT store_description, country, {country('country')} AS code FROM store_raw",
)
def _(t):
    return t.store_raw.select("store_description", "country", normalise_country("country").alias("code"))


@query(
    "market_zone",
    with_clause("store_raw")
    + """SELECT store_description, substr(trim(first_price), 1, length(trim(first_price)) - 1) AS base_zone,
        substr(trim(actual_price), 1, length(trim(actual_price)) - 1) AS promo_zone FROM store_raw""",
)
def _(t):
    return t.store_raw.select(
        "store_description",
        strip_last("first_price").alias("base_zone"),
        strip_last("actual_price").alias("promo_zone"),
    )


@query("stable_code", f"SELECT doc_id, {code10('text')} AS code FROM documents")
def _(t):
    return t.documents.select("doc_id", stable_code("text").alias("code"))


@query(
    "variant_parent",
    with_clause("variants")
    + """SELECT variant, product_code, split_part(variant, '/', 1) AS parent_code,
        split_part(variant, '/', 2) AS size_code FROM variants""",
)
def _(t):
    parent, size = split_variant("variant")
    return t.variants.select("variant", "product_code", parent.alias("parent_code"), size.alias("size_code"))


@query(
    "require_keys",
    with_clause("product_raw")
    + """SELECT product_code, size_code, product_group_3_code FROM product_raw
        WHERE trim(product_code) <> '' AND trim(product_group_3_code) <> ''""",
)
def _(t):
    kept = require_keys(t.product_raw, ["product_code", "product_group_3_code"])
    return kept.select("product_code", "size_code", F.col("product_group_3_code"))
