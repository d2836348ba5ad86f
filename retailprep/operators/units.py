"""Unit conversion through a product's conversion group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .enrich import lookup_join, new_rows

FACTOR = "decimal(24,12)"


def conversion_table(conversions: DataFrame) -> DataFrame:
    """(group, from_unit, to_unit, multiply, divide, versions), one row per direction.

    Conversions come as (group, from_unit, to_unit, factor): one ``to_unit`` is
    ``factor`` ``from_unit``.  The reverse is implied.  ``versions`` above one
    marks a direction with contradicting factors, zero one whose factors are all
    unusable: missing, not positive, or below what the type holds.
    """
    factor = F.col("factor").try_cast(FACTOR)
    one = F.lit(1).cast(FACTOR)
    sides = (("from_unit", "to_unit", one, factor), ("to_unit", "from_unit", factor, one))
    there, back = (
        conversions.select(
            "group", F.col(a).alias("from_unit"), F.col(b).alias("to_unit"), multiply.alias("multiply"), divide.alias("divide")
        )
        for a, b, multiply, divide in sides
    )
    rule = F.when((F.col("multiply") > 0) & (F.col("divide") > 0), F.struct("multiply", "divide"))
    return (
        there.unionByName(back)
        .groupBy("group", "from_unit", "to_unit")
        .agg(F.min(rule).alias("low"), F.max(rule).alias("high"))
        .select(
            "group",
            "from_unit",
            "to_unit",
            "low.multiply",
            "low.divide",
            F.when(F.col("low").isNull(), 0).when(F.col("low") == F.col("high"), 1).otherwise(2).alias("versions"),
        )
    )


def product_units(products: DataFrame) -> DataFrame:
    """(product_code, sales_unit, group), one row per product: of repeated ones the smallest unit and group."""
    rank = F.struct("sales_unit", "group")
    best = products.filter(F.col("product_code").isNotNull()).groupBy("product_code").agg(F.min(rank).alias("__best"))
    return best.select("product_code", "__best.sales_unit", "__best.group")


def convert_units(
    stock: DataFrame,
    products: DataFrame,
    conversions: DataFrame,
    amount: str = "amount",
    amount_type: str = "decimal(18,6)",
) -> DataFrame:
    """Stock amounts in each product's sales unit.

    ``stock`` has product_code and unit, ``products`` has product_code,
    sales_unit and group.  Adds ``sales_unit``, ``converted``
    and ``status``: same, converted, ambiguous, unusable (a factor that is not
    positive, or too small), missing or unknown_product.  Without a usable
    conversion the amount is NULL.  Most products may
    share one group: the join is one that AQE may split.
    """
    master = product_units(products).withColumnRenamed("group", "__group")
    table = conversion_table(conversions).select(
        F.col("group").alias("__group"),
        F.col("from_unit").alias("unit"),
        F.col("to_unit").alias("sales_unit"),
        "multiply",
        "divide",
        "versions",
    )
    joined = lookup_join(lookup_join(stock, master, ["product_code"]), table, ["__group", "unit", "sales_unit"])
    status = (
        F.when(F.col("sales_unit").isNull(), "unknown_product")
        .when(F.col("unit") == F.col("sales_unit"), "same")
        .when(F.col("versions").isNull(), "missing")
        .when(F.col("versions") > 1, "ambiguous")
        .when(F.col("versions") < 1, "unusable")
        .otherwise("converted")
    )
    value = F.col(amount).cast(amount_type)
    scaled = F.try_divide(value * F.col("multiply"), F.col("divide")).try_cast(amount_type)
    return joined.withColumn("status", status).select(
        *stock.columns,
        "sales_unit",
        F.when(F.col("status") == "same", value).when(F.col("status") == "converted", scaled).alias("converted"),
        "status",
    )


def missing_conversions(
    stock: DataFrame, products: DataFrame, conversions: DataFrame, context: Sequence[str]
) -> DataFrame:
    """Stock rows and products without a way to their sales unit, per context (warehouse, store, in transit)."""
    needed = lookup_join(stock, product_units(products), ["product_code"], "inner")
    needed = needed.filter(F.col("unit") != F.col("sales_unit"))
    usable = conversion_table(conversions).filter(F.col("versions") > 0)
    table = usable.select("group", F.col("from_unit").alias("unit"), F.col("to_unit").alias("sales_unit"))
    gaps = new_rows(needed, table, ["group", "unit", "sales_unit"])
    # per product first, so that the distinct count needs no second pass over the rows
    per_product = gaps.groupBy(*context, "unit", "sales_unit", "product_code").agg(F.count(F.lit(1)).alias("n"))
    return per_product.groupBy(*context, "unit", "sales_unit").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("products")
    )


def ambiguous_conversions(conversions: DataFrame) -> DataFrame:
    """Groups and source units with several targets."""
    targets = conversions.select("group", "from_unit", "to_unit").distinct()
    return (
        targets.groupBy("group", "from_unit")
        .agg(F.count("to_unit").alias("targets"))
        .filter(F.col("targets") > 1)
    )
