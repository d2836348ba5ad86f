"""Stock, inbound goods and snapshot semantics."""

import uuid

from pyspark.sql import functions as F

from retailprep.operators.delta import bucketed_upsert, compare_deliveries, densify, upsert
from retailprep.plans import stock
from retailprep.session import scratch_path
from retailprep.sources import publish_version, read_feed, write_feed

from .fixtures import with_clause
from .product_queries import SHARE
from .registry import query
from .text_queries import robust, strict

STORE_STOCK = f"""SELECT TRY_CAST(inventory_date AS DATE) AS date_point_of_sale_level, store_code AS point_of_sale_code,
    product_code, {strict('inventory', 15, 3)} AS amount, 'ST' AS unit_of_measure_code,
    {strict('stock_cost', 15, 2)} AS stock_cost, currency FROM inventory_raw"""
INBOUND = f"""inbound AS (
    SELECT trim(destination_code) AS point_of_sale_code, trim(product_code) AS product_code,
           {strict('quantity_ordered', 15, 3)} AS amount, TRY_CAST(estimated_arrival_date AS DATE) AS delivery_date
    FROM open_orders_raw
    UNION ALL
    SELECT trim(destination_code), trim(product_code), {strict('quantity', 15, 3)},
           CAST(TRY_CAST(estimated_arrival_date AS TIMESTAMP) AS DATE) FROM in_transit_raw),
marked AS (
    SELECT *, CASE WHEN COALESCE(point_of_sale_code, '') = '' OR COALESCE(product_code, '') = '' THEN 'blank_key'
                   WHEN delivery_date IS NULL THEN 'no_date' ELSE 'kept' END AS outcome FROM inbound)"""


@query("conform_stock", with_clause("inventory_raw") + STORE_STOCK)
def _(t):
    return stock.store_stock_feed(t.inventory_raw)


@query(
    "stock_nonzero",
    with_clause("inventory_raw") + f"SELECT * FROM ({STORE_STOCK}) WHERE amount <> 0",
)
def _(t):
    return stock.store_stock_feed(t.inventory_raw, drop_zero=True)


@query(
    "warehouse_feed",
    with_clause("warehouse_raw")
    + f"""SELECT TRY_CAST(inventory_warehouse_date AS DATE) AS date_stock_level, warehouse_code, product_code,
            {strict('inventory', 15, 3)} AS amount, 'ST' AS warehouse_unit_of_measure_code FROM warehouse_raw""",
)
def _(t):
    return stock.warehouse_stock_feed(t.warehouse_raw)


@query(
    "null_profile",
    with_clause("warehouse_raw")
    + f""", clean AS (SELECT TRY_CAST(inventory_warehouse_date AS DATE) AS inventory_warehouse_date, warehouse_code,
            product_code, {strict('inventory', 15, 3)} AS inventory FROM warehouse_raw),
        lines AS (SELECT 'inventory_warehouse_date' AS "column", count(*) AS total,
                count(*) FILTER (WHERE inventory_warehouse_date IS NULL) AS rows FROM clean
            UNION ALL SELECT 'warehouse_code', count(*), count(*) FILTER (WHERE COALESCE(warehouse_code, '') = '') FROM clean
            UNION ALL SELECT 'product_code', count(*), count(*) FILTER (WHERE COALESCE(product_code, '') = '') FROM clean
            UNION ALL SELECT 'inventory', count(*), count(*) FILTER (WHERE inventory IS NULL) FROM clean)
        SELECT "column", total AS rows, rows AS blanks, {SHARE} FROM lines""",
)
def _(t):
    return stock.warehouse_profile(t.warehouse_raw)


@query(
    "observed_audit",
    with_clause("open_orders_raw", "in_transit_raw", more=INBOUND)
    + """SELECT r.reason AS outcome, count(m.outcome) AS rows FROM (VALUES ('blank_key'), ('no_date'), ('kept')) AS r(reason)
            LEFT JOIN marked m ON m.outcome = r.reason GROUP BY r.reason
        UNION ALL SELECT 'total', count(*) FROM marked UNION ALL SELECT 'written', count(*) FROM marked WHERE outcome = 'kept'""",
)
def _(t):
    # the feed is written once, and the audit is counted by that job
    path = scratch_path(t.spark, "inbound")
    feed, report = stock.inbound_feed_audited(t.open_orders_raw, t.in_transit_raw)
    write_feed(feed, path)
    written = read_feed(t.spark, path).agg(F.lit("written").alias("outcome"), F.count(F.lit(1)).alias("rows"))
    return report().unionByName(written)


@query(
    "inbound_feed",
    with_clause("open_orders_raw", "in_transit_raw", more=INBOUND)
    + """SELECT point_of_sale_code, product_code, amount, 'ST' AS unit_of_measure_code, delivery_date
        FROM marked WHERE outcome = 'kept'""",
)
def _(t):
    return stock.inbound_feed(t.open_orders_raw, t.in_transit_raw)


@query(
    "volume_audit",
    with_clause("open_orders_raw", "in_transit_raw", more=INBOUND)
    + """SELECT 'total' AS outcome, count(*) AS rows FROM marked
        UNION ALL SELECT outcome, count(*) FROM marked GROUP BY outcome""",
)
def _(t):
    return stock.inbound_audit(t.open_orders_raw, t.in_transit_raw)


@query(
    "stock_densify",
    with_clause("inventory_raw")
    + f""", clean AS (SELECT store_code AS point_of_sale_code, product_code, {robust('inventory', 15, 3)} AS amount FROM inventory_raw)
        SELECT point_of_sale_code, product_code, CASE WHEN amount <> 0 THEN amount ELSE 0 END AS amount FROM clean""",
)
def _(t):
    snapshot = stock.store_stock_feed(t.inventory_raw, drop_zero=True, strict=False)
    wanted = t.inventory_raw.select(F.col("store_code").alias("point_of_sale_code"), "product_code")
    return densify(snapshot, wanted, ["point_of_sale_code", "product_code"], ["amount"])


UPSERTED = (
    with_clause("customer_base", "customer_updates")
    + """SELECT * FROM customer_updates UNION ALL
        SELECT * FROM customer_base WHERE external_id NOT IN (SELECT external_id FROM customer_updates)"""
)


@query("upsert", UPSERTED)
def _(t):
    return upsert(t.customer_base, t.customer_updates, ["external_id"])


@query("upsert_bucketed", UPSERTED)
def _(t):
    # two versions of the stored table: the second is made of the first without shuffling it
    keys, view = ["external_id"], f"customers_{uuid.uuid4().hex}"
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    base = publish_version(t.customer_base, view, keys, buckets, scratch_path(t.spark, "v1"))
    return publish_version(bucketed_upsert(base, t.customer_updates, keys), view, keys, buckets, scratch_path(t.spark, "v2"))


@query(
    "delivery_compare",
    with_clause("delivery_a", "delivery_b")
    + """SELECT (SELECT count(*) FROM delivery_a) AS rows_a, (SELECT count(*) FROM delivery_b) AS rows_b,
        (SELECT count(DISTINCT variant) FROM delivery_a) AS variants_a,
        (SELECT count(DISTINCT variant) FROM delivery_b) AS variants_b,
        (SELECT count(DISTINCT variant) FROM delivery_a WHERE variant IN (SELECT variant FROM delivery_b)) AS variants_common,
        (SELECT count(DISTINCT parent) FROM delivery_a) AS parents_a,
        (SELECT count(DISTINCT parent) FROM delivery_b) AS parents_b,
        (SELECT count(DISTINCT parent) FROM delivery_a WHERE parent IN (SELECT parent FROM delivery_b)) AS parents_common""",
)
def _(t):
    return compare_deliveries(t.delivery_a, t.delivery_b, "variant", "parent")
