"""Price lists, their timeline and deltas, and prices as of a day."""

import uuid

from pyspark.sql import functions as F

from retailprep.operators.attributes import group_sizes
from retailprep.operators.delta import delta
from retailprep.operators.enrich import keep_known, maybe_known, since, stack
from retailprep.operators.keys import lowest_by
from retailprep.operators.temporal import accumulate, asof_instant, asof_join, price_fallback
from retailprep.plans import price, sales
from retailprep.session import scratch_path
from retailprep.sources import extend_history, read_feed, read_history, store_bucketed, write_feed

from .fixtures import with_clause
from .registry import query
from .text_queries import country, date3, strict


def clean_sql(source: str, base: str = "base_raw", retail: str = "retail_raw") -> str:
    """CTE ``<source>`` of readable positive prices of both files."""
    return f"""
    {source}_parsed AS (
        SELECT source, trim(product_agg_level_code) AS product_code, trim(store_agg_level_code) AS zone,
               {date3('price_date')} AS start_date, {strict('price_with_tax', 15, 2)} AS value,
               currency AS currency_code
        FROM (SELECT 'base' AS source, * FROM {base} UNION ALL SELECT 'retail', * FROM {retail})),
    {source} AS (SELECT * FROM {source}_parsed WHERE value > 0 AND start_date IS NOT NULL)"""


SERVED = """
    served_all AS (
        SELECT 'base' AS source, trim(first_price) AS zone, trim(store_code) AS store_code FROM store_raw
        WHERE class IS DISTINCT FROM 'ZAMKNIETE' AND first_price IS NOT NULL
        UNION ALL
        SELECT 'retail', trim(actual_price), trim(store_code) FROM store_raw
        WHERE class IS DISTINCT FROM 'ZAMKNIETE' AND actual_price IS NOT NULL),
    served AS (SELECT DISTINCT source, zone FROM served_all),
    known_sku AS (SELECT DISTINCT trim(code) AS product_code FROM sku_dictionary)"""


def current_sql(name: str, clean: str) -> str:
    """CTE ``<name>``: lowest price per source, market, product and day."""
    return f"""
    {name} AS (
        SELECT source, market_code, product_code, start_date, value, currency_code FROM (
            SELECT *, row_number() OVER (PARTITION BY source, market_code, product_code, start_date
                                         ORDER BY value, currency_code NULLS LAST) AS rn
            FROM (SELECT c.*, substr(zone, 1, length(zone) - 1) AS market_code
                  FROM {clean} c SEMI JOIN served s ON c.source = s.source AND c.zone = s.zone
                  SEMI JOIN known_sku k ON c.product_code = k.product_code))
        WHERE rn = 1)"""


def feed_sql(name: str, current: str) -> str:
    """CTE ``<name>``: the dated feed with priorities."""
    return f"""
    {name}_dated AS (
        SELECT CASE source WHEN 'base' THEN 'Cennik_bazowy_' ELSE 'Cennik_promocyjny_' END || market_code AS name,
               CASE source WHEN 'base' THEN '100' ELSE '200' END AS price_type_id, *,
               CAST(lead(start_date) OVER (PARTITION BY source, market_code, product_code ORDER BY start_date)
                    - INTERVAL 1 DAY AS DATE) AS end_date
        FROM {current}),
    {name} AS (
        SELECT d.*, d.name AS external_id, p.priority FROM {name}_dated d JOIN (
            SELECT name, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS priority
            FROM (SELECT DISTINCT name FROM {name}_dated)) p ON p.name = d.name)"""


OUT = """SELECT name, external_id, price_type_id, currency_code, market_code, product_code, value,
    strftime(start_date, '%Y-%m-%d 00:00:00') AS start_date, strftime(end_date, '%Y-%m-%d 00:00:00') AS end_date,
    priority FROM """

CLEAN = with_clause("base_raw", "retail_raw", "store_raw", "sku_dictionary", more=clean_sql("clean") + "," + SERVED)
CURRENT = CLEAN.rstrip() + "," + current_sql("lowest", "clean") + "\n"
FEED = CURRENT.rstrip() + "," + feed_sql("feed", "lowest") + "\n"
DELTA = (
    with_clause(
        "base_raw",
        "retail_raw",
        "store_raw",
        "base_old",
        "retail_old",
        "sku_dictionary",
        more=",".join(
            [
                clean_sql("clean"),
                clean_sql("clean_old", "base_old", "retail_old"),
                SERVED,
                current_sql("lowest", "clean"),
                current_sql("lowest_old", "clean_old"),
                feed_sql("feed", "lowest"),
                feed_sql("feed_old", "lowest_old"),
            ]
        ),
    )
)


def full_feed(t, **options):
    return price.price_feed(t.base_raw, t.retail_raw, t.store_raw, t.sku_dictionary, **options)


def buckets(t):
    return int(t.spark.conf.get("spark.sql.shuffle.partitions"))


def cleaned(t):
    return price.price_clean(stack({"base": t.base_raw, "retail": t.retail_raw}))


def current(t, base, retail):
    served = price.served_zones(t.store_raw)
    return price.current_prices(base, retail, served, t.sku_dictionary)


PRICE_COLUMNS = "source, product_code, zone, start_date, value, currency_code"


@query("price_clean", CLEAN + f"SELECT {PRICE_COLUMNS} FROM clean WHERE start_date >= DATE '1996-01-01'")
def _(t):
    return since(cleaned(t), "start_date", "1996-01-01").select(*PRICE_COLUMNS.split(", "))


@query(
    "open_stores",
    with_clause("store_raw")
    + "SELECT store_description, class FROM store_raw WHERE class IS DISTINCT FROM 'ZAMKNIETE'",
)
def _(t):
    return price.open_stores(t.store_raw).select("store_description", "class")


@query(
    "zone_stores",
    CLEAN + "SELECT source, zone, count(DISTINCT store_code) AS stores FROM served_all GROUP BY source, zone",
)
def _(t):
    return group_sizes(price.zone_stores(t.store_raw), ["source", "zone"], "store_code", "stores")


@query(
    "price_known_sku",
    CLEAN + f"SELECT {PRICE_COLUMNS} FROM clean WHERE product_code IN (SELECT product_code FROM known_sku)",
)
def _(t):
    known = t.sku_dictionary.select(F.trim("code").alias("product_code"))
    return keep_known(cleaned(t), known, ["product_code"]).select(*PRICE_COLUMNS.split(", "))


@query(
    "price_known_sku_bloom",
    CLEAN + f"SELECT {PRICE_COLUMNS} FROM clean WHERE product_code IN (SELECT product_code FROM known_sku)",
)
def _(t):
    known = t.sku_dictionary.select(F.trim("code").alias("product_code"))
    likely = maybe_known(cleaned(t), known, ["product_code"], expected=20_000)
    return keep_known(likely, known, ["product_code"]).select(*PRICE_COLUMNS.split(", "))


@query(
    "price_known_zone",
    CLEAN + f"SELECT {PRICE_COLUMNS} FROM clean c WHERE (source, zone) IN (SELECT (source, zone) FROM served)",
)
def _(t):
    served = price.served_zones(t.store_raw)
    return keep_known(cleaned(t), served, ["source", "zone"]).select(*PRICE_COLUMNS.split(", "))


@query(
    "price_lowest",
    CLEAN
    + f"""SELECT {PRICE_COLUMNS} FROM (
        SELECT *, row_number() OVER (PARTITION BY source, product_code, zone, start_date
                                     ORDER BY value, currency_code NULLS LAST) AS rn FROM clean) WHERE rn = 1""",
)
def _(t):
    keys = ["source", "product_code", "zone", "start_date"]
    lowest = lowest_by(cleaned(t), keys, "value", [F.col("currency_code").asc_nulls_last()])
    return lowest.select(*PRICE_COLUMNS.split(", "))


@query("price_timeline", FEED + OUT + "feed")
def price_timeline(t):
    return price.price_output(full_feed(t))


@query(
    "price_zones",
    CLEAN.replace("FROM served_all)", "FROM served_all WHERE zone IN ('AFRREGF', 'EURREGA', 'PASIF'))").rstrip()
    + ","
    + current_sql("lowest", "clean").replace("value, currency_code FROM", "value, 'PLN' AS currency_code FROM")
    + ","
    + feed_sql("feed", "lowest")
    + OUT
    + "feed",
)
def _(t):
    return price.price_output(full_feed(t, zones=["AFRREGF", "EURREGA", "PASIF"], currency="PLN"))


@query("list_priority", FEED + "SELECT DISTINCT name, priority FROM feed")
def _(t):
    return price.rank_names(price.with_name(current(t, t.base_raw, t.retail_raw)), "name")


@query("price_totals", FEED + "SELECT count(*) AS rows, count(DISTINCT name) AS lists FROM feed")
def _(t):
    return price.export_totals(full_feed(t))


PRICE_DELTA = (
    DELTA
    + OUT
    + """feed f WHERE NOT EXISTS (SELECT 1 FROM feed_old o WHERE o.name = f.name
            AND o.product_code = f.product_code AND o.start_date = f.start_date)
        OR EXISTS (SELECT 1 FROM feed_old o WHERE o.name = f.name AND o.product_code = f.product_code
            AND o.start_date = f.start_date AND o.end_date IS DISTINCT FROM f.end_date)"""
)


@query(
    "price_delta",
    PRICE_DELTA,
)
def price_delta(t):
    earlier = price.price_feed(t.base_old, t.retail_old, t.store_raw, t.sku_dictionary)
    # the dictionary's other schema, every key twice as after two snapshots
    known = price.price_output(earlier).selectExpr(
        "external_id", "product_code AS code", "start_date AS valid_from", "end_date AS valid_to", "value AS price", "explode(array(1, 2)) AS snapshot"
    )
    return price.price_output(full_feed(t, known=known))


@query("price_delta_bucketed", PRICE_DELTA)
def _(t):
    # the price dictionary as a table bucketed by the keys of a price: comparing does not shuffle it
    keys = ["product_code", "start_date", "name"]
    earlier = price.price_feed(t.base_old, t.retail_old, t.store_raw, t.sku_dictionary)
    name = f"prices_{uuid.uuid4().hex}"
    stored = store_bucketed(earlier.select(*keys, "end_date"), name, keys, buckets(t), scratch_path(t.spark, name))
    return price.price_output(delta(full_feed(t), stored, keys, ["end_date"]))


@query(
    "publish_partitions",
    DELTA
    + """SELECT name, count(*) AS rows, CAST(sum(value) AS DECIMAL(18,2)) AS total FROM (
            SELECT name, value FROM feed WHERE market_code LIKE '%REG'
            UNION ALL SELECT name, value FROM feed_old WHERE name NOT IN (SELECT name FROM feed WHERE market_code LIKE '%REG'))
        GROUP BY name""",
)
def _(t):
    # all lists as delivered earlier, then those of some markets anew
    path = scratch_path(t.spark, "lists")
    earlier = price.price_feed(t.base_old, t.retail_old, t.store_raw, t.sku_dictionary)
    write_feed(price.price_output(earlier), path, partition_by="name")
    write_feed(price.price_output(full_feed(t)).filter(F.col("market_code").endswith("REG")), path, partition_by="name", replace="LISTS")
    written = read_feed(t.spark, path).select("name", F.col("value").try_cast("decimal(15,2)").alias("value"))
    return written.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.sum("value").cast("decimal(18,2)").alias("total"))


@query(
    "price_delta_values",
    DELTA
    + OUT
    + """feed f WHERE NOT EXISTS (SELECT 1 FROM feed_old o WHERE o.name = f.name
            AND o.product_code = f.product_code AND o.start_date = f.start_date)
        OR EXISTS (SELECT 1 FROM feed_old o WHERE o.name = f.name AND o.product_code = f.product_code
            AND o.start_date = f.start_date
            AND (o.end_date IS DISTINCT FROM f.end_date OR o.value + f.priority % 2 IS DISTINCT FROM f.value))""",
)
def _(t):
    earlier = price.price_feed(t.base_old, t.retail_old, t.store_raw, t.sku_dictionary)
    full = full_feed(t).select("name", "product_code", "start_date", "priority")
    # the dictionary has another value wherever the list's priority is odd now
    shifted = earlier.drop("priority").join(full, ["name", "product_code", "start_date"])
    shifted = shifted.withColumn("value", (F.col("value") + F.col("priority") % 2).cast("decimal(15,2)"))
    return price.price_output(full_feed(t, known=shifted.select(*earlier.columns), compare=["end_date", "value"]))


PRICE_HISTORY = (
    DELTA
    + """SELECT source, market_code, product_code, start_date, value, currency_code,
            CAST(lead(start_date) OVER (PARTITION BY source, market_code, product_code ORDER BY start_date)
                 - INTERVAL 1 DAY AS DATE) AS end_date
        FROM (SELECT *, row_number() OVER (PARTITION BY source, market_code, product_code, start_date
                                           ORDER BY value, currency_code NULLS LAST) AS rn
              FROM (SELECT * FROM lowest_old UNION ALL SELECT * FROM lowest)) WHERE rn = 1"""
)


@query(
    "price_history",
    PRICE_HISTORY,
)
def _(t):
    history = current(t, t.base_old, t.retail_old)
    snapshot = current(t, t.base_raw, t.retail_raw)
    keys = ["product_code", "market_code", "source"]
    return accumulate(history, snapshot, keys, "start_date", "value", ["currency_code"])


@query("history_increment", PRICE_HISTORY)
def _(t):
    # the history so far lies in folders; the snapshot changes those of its keys
    keys = ["product_code", "market_code", "source"]
    path = scratch_path(t.spark, "price_history")
    for base, retail in ((t.base_old, t.retail_old), (t.base_raw, t.retail_raw)):
        extend_history(t.spark, path, current(t, base, retail), keys, "start_date", "value", ["currency_code"], buckets=16)
    return read_history(t.spark, path, 16).select(*keys, "start_date", "value", "currency_code", "end_date")


SALE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
DAILY = """daily AS (
    SELECT product_code, quote_date, price FROM (
        SELECT *, row_number() OVER (PARTITION BY product_code, quote_date ORDER BY price NULLS LAST) AS rn
        FROM quotes_raw) WHERE rn = 1)"""


@query(
    "asof_price",
    with_clause("sales_raw", "quotes_raw", more=DAILY)
    + f"""SELECT {', '.join('s.' + k for k in SALE_KEYS)}, s.sale_date, q.quote_date, q.price
        FROM sales_raw s ASOF LEFT JOIN daily q
        ON s.product_code = q.product_code AND s.sale_date >= q.quote_date""",
)
def asof_price(t):
    facts = t.sales_raw.select(*SALE_KEYS, "product_code", "sale_date")
    joined = asof_join(facts, t.quotes_raw, ["product_code"], "sale_date", "quote_date", ["price"])
    return joined.drop("product_code")


QUOTED = """quoted AS (
    SELECT user_id, ts, min(CAST(value AS DECIMAL(13,2))) AS price FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts)"""


@query(
    "asof_timestamp",
    f"""WITH {QUOTED}
    SELECT e.event_id, e.user_id, strftime(q.ts, '%Y-%m-%d %H:%M:%S.%f') AS quoted_at, q.price
    FROM events e ASOF LEFT JOIN quoted q ON e.user_id = q.user_id AND e.ts >= q.ts""",
)
def _(t):
    # the price a user last paid when each event happened
    quotes = t.events.filter("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("quoted_at"), F.col("value").cast("decimal(13,2)").alias("price")
    )
    joined = asof_instant(t.events.select("event_id", "user_id", "ts"), quotes, ["user_id"], "ts", "quoted_at", ["price"])
    return joined.select("event_id", "user_id", F.date_format("quoted_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("quoted_at"), "price")


@query(
    "asof_price_fallback",
    with_clause("sales_raw", "quotes_raw", more=DAILY)
    + f"""SELECT {', '.join('s.' + k for k in SALE_KEYS)},
            CAST(COALESCE(q.price, CAST(s.value AS DECIMAL(13,2))) AS DECIMAL(13,2)) AS price,
            q.price IS NULL AS is_fallback
        FROM sales_raw s ASOF LEFT JOIN daily q
        ON s.product_code = q.product_code AND s.sale_date >= q.quote_date""",
)
def _(t):
    facts = t.sales_raw.select(*SALE_KEYS, "product_code", "sale_date", "value")
    joined = asof_join(facts, t.quotes_raw, ["product_code"], "sale_date", "quote_date", ["price"])
    return joined.select(
        *SALE_KEYS,
        price_fallback("price", "value").cast("decimal(13,2)").alias("price"),
        F.col("price").isNull().alias("is_fallback"),
    )


ONLINE = ["Supplier#000000003", "Supplier#000000007"]


def _asof_sql(name: str, source: str, price_name: str, zone: str) -> str:
    return f"""{name}_quotes AS (
        SELECT product_code, zone, start_date, min(value) AS {price_name} FROM clean WHERE source = '{source}'
        GROUP BY ALL),
    {name}_priced AS (
        SELECT {', '.join('s.' + k for k in SALE_KEYS)}, q.{price_name} FROM sold s ASOF LEFT JOIN {name}_quotes q
        ON s.product_code = q.product_code AND s.{zone} = q.zone AND s.sale_date >= q.start_date)"""


@query(
    "sales_feed",
    with_clause(
        "base_raw",
        "retail_raw",
        "store_raw",
        "sales_raw",
        more=clean_sql("clean")
        + f""",
    sold AS (
        SELECT r.*, s.country, trim(s.first_price) AS first_price, trim(s.actual_price) AS actual_price
        FROM sales_raw r LEFT JOIN store_raw s ON r.store_code = s.store_code),
    {_asof_sql('base', 'base', 'price_base', 'first_price')},
    {_asof_sql('promo', 'retail', 'price_promo', 'actual_price')}""",
    )
    + f"""SELECT {', '.join('s.' + k for k in SALE_KEYS)}, s.sale_date, s.store_code,
            CASE WHEN s.store_code IN ({', '.join(repr(o) for o in ONLINE)}) THEN 'Eshop' ELSE {country('s.country')} END
                AS market_code,
            s.product_code,
            CAST(CASE WHEN l_returnflag = 'R' THEN -quantity ELSE quantity END AS DECIMAL(13,2)) AS quantity,
            CAST(CASE WHEN l_returnflag = 'R' THEN -value ELSE value END AS DECIMAL(13,2)) AS value,
            CAST(b.price_base AS DECIMAL(13,2)) AS price_base, CAST(p.price_promo AS DECIMAL(13,2)) AS price_promo,
            CAST(COALESCE(p.price_promo, b.price_base,
                -- half up to two digits: unit price of two-digit amounts
                CAST((CAST(value * 100 AS BIGINT) * 200 + CAST(quantity * 100 AS BIGINT))
                     // (2 * CAST(quantity * 100 AS BIGINT)) AS DECIMAL(15,0)) / 100) AS DECIMAL(13,2)) AS price
        FROM sold s JOIN base_priced b USING ({', '.join(SALE_KEYS)}) JOIN promo_priced p USING ({', '.join(SALE_KEYS)})""",
)
def sales_feed(t):
    return sales.sales_feed(
        t.sales_raw,
        t.store_raw,
        price.price_clean(t.base_raw),
        price.price_clean(t.retail_raw),
        F.col("l_returnflag") == "R",
        ONLINE,
        SALE_KEYS,
    )
