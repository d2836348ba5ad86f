"""Raw feeds played by projections of the given tables.

Each text is valid in Spark SQL and DuckDB.  Placeholders name given tables or
other fixtures.  Values are dirtied on purpose (blanks, commas, odd dates); no
row of a table is left out unless it makes two sources differ.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# a store's zones of the base and the promotional list
BASE_ZONE = """CASE WHEN s_acctbal < -500 THEN 'OUTREGF'
                    ELSE substr(r_name, 1, 3) || 'REG' || CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'A' END END"""
PROMO_ZONE = """CASE WHEN s_acctbal > 9500 THEN NULL
                    ELSE ' P' || substr(r_name, 1, 3) || CASE WHEN s_suppkey % 3 = 0 THEN 'F ' ELSE 'A' END END"""

FIXTURES = {
    # products: duplicated codes, blank keys, technical and missing groups, local numbers
    "product_raw": """
        SELECT CASE WHEN p_size = 47 THEN NULL WHEN p_size = 48 THEN '  '
                    ELSE CAST(p_partkey AS STRING) END AS product_code,
               p_name AS option_code,
               CAST(p_size + 100 * copy AS STRING) AS size_code,
               'Item ' || p_name AS product_description,
               p_brand AS brand,
               CASE WHEN p_size = 50 THEN '-1' WHEN p_size = 49 THEN NULL ELSE p_type END
                   AS product_group_1_code,
               'All ' || p_type AS product_group_1_description,
               p_brand AS product_group_2_code,
               'Line ' || p_brand AS product_group_2_description,
               CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'G' || CAST(p_size % 4 AS STRING) END
                   AS product_group_3_code,
               CASE WHEN p_size % 4 = 0 THEN NULL ELSE 'Group ' || CAST(p_size % 4 AS STRING) END
                   AS product_group_3_description,
               'K' || CAST(p_size % 5 AS STRING) AS product_group_4_code,
               CASE WHEN p_size % 5 = 0 THEN NULL ELSE ' Kind ' || CAST(p_size % 5 AS STRING) END
                   AS product_group_4_description,
               p_type || '-M' AS model_code,
               'C' || CAST(p_size % 7 AS STRING) AS color_code,
               replace(CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING), '.', ',') || ' zl'
                   AS price_with_tax,
               CASE WHEN p_size % 2 = 0 THEN '23,00' ELSE '8,5%' END AS tax_rate,
               CASE p_size % 3 WHEN 0 THEN '1 234,567' WHEN 1 THEN '1.234,56' ELSE '"99,90"' END AS cogs,
               'PLN' AS currency,
               CASE p_partkey % 5 WHEN 0 THEN 'SS22' WHEN 1 THEN ' aw25' WHEN 2 THEN 'MM'
                    WHEN 3 THEN '' ELSE NULL END AS season
        FROM (SELECT *, 0 AS copy FROM {part}
              UNION ALL SELECT *, 1 AS copy FROM {part} WHERE p_size > 40) AS p
    """,
    # attributes in long form: two values for some, an undefined code, a name the product already has
    "uda_raw": """
        SELECT CAST(p_partkey AS STRING) AS product_code, 'U1' AS uda_code,
               CASE p_size % 3 WHEN 0 THEN ' GIRL' WHEN 1 THEN 'WOMAN' ELSE NULL END AS uda_value FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING), 'U1', 'ZZZ' FROM {part} WHERE p_size < 10
        UNION ALL
        SELECT CAST(p_partkey AS STRING), 'U2',
               CASE p_size % 4 WHEN 0 THEN '0' WHEN 1 THEN '' ELSE 'D' || CAST(p_size % 4 AS STRING) END FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING), 'U3', CAST(p_size AS STRING) FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING), 'U4', 'none' FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING), 'U5', p_type FROM {part} WHERE p_size > 5
        UNION ALL
        SELECT CAST(p_partkey AS STRING), 'U9', p_brand FROM {part}
    """,
    "uda_def": """
        SELECT * FROM (VALUES ('U1', 'Sex Department'), ('U2', 'StoreDepartment'),
                              ('U3', 'SalesFloorSegmentQty'), ('U4', 'Season'),
                              ('U5', 'Fabric / Type')) AS t(uda_code, uda_description)
    """,
    # codes already delivered, once per snapshot
    "known_product": """
        SELECT CAST(p_partkey AS STRING) AS external_id FROM {part} WHERE p_type IN ('ECONOMY', 'SMALL')
        UNION ALL
        SELECT CAST(p_partkey AS STRING) FROM {part} WHERE p_type = 'SMALL'
    """,
    # warehouse stock by region and product
    "warehouse_raw": """
        SELECT 'WH' || CAST(n_regionkey AS STRING) AS warehouse_code,
               CASE WHEN l_partkey % 11 = 0 THEN '' ELSE CAST(l_partkey AS STRING) END AS product_code,
               replace(CAST(SUM(CAST(l_quantity AS DECIMAL(15,3))) AS STRING), '.', ',') AS inventory,
               CASE WHEN l_partkey % 7 = 0 THEN '2024-13-01'
                    ELSE CAST(CAST(MAX(l_shipdate) AS DATE) AS STRING) END AS inventory_warehouse_date
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
        GROUP BY n_regionkey, l_partkey
    """,
    # codes in the newest store stock
    "inventory_recent": """
        SELECT DISTINCT CAST(l_partkey AS STRING) AS product_code FROM {lineitem}
        WHERE l_shipdate >= TIMESTAMP '2001-10-01 00:00:00'
    """,
    # store stock: quoted and blank-separated numbers
    "inventory_raw": """
        SELECT 'S' || CAST(l_suppkey AS STRING) AS store_code,
               CAST(l_partkey AS STRING) AS product_code,
               CASE l_suppkey % 3 WHEN 0 THEN '"' || qty || '"' WHEN 1 THEN qty ELSE '1 ' || qty END AS inventory,
               CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE CAST(CAST(last_day AS DATE) AS STRING) END AS inventory_date,
               CASE l_partkey % 3 WHEN 0 THEN cost || ' zl' ELSE cost END AS stock_cost,
               'PLN' AS currency
        FROM (SELECT l_suppkey, l_partkey, MAX(l_shipdate) AS last_day,
                     replace(CAST(SUM(CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS DECIMAL(15,3))) AS STRING), '.', ',') AS qty,
                     replace(CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS STRING), '.', ',') AS cost
              FROM {lineitem} GROUP BY l_suppkey, l_partkey) AS i
    """,
    # stores: every country shape, closed ones, zones that differ in their last letter
    "store_raw": """
        SELECT CASE WHEN s_acctbal > 9800 THEN ' ' ELSE s_name END AS store_code,
               'Store ' || s_name AS store_description,
               CASE s_suppkey % 8 WHEN 0 THEN NULL WHEN 1 THEN ' po ' WHEN 2 THEN 'SVK' WHEN 3 THEN 'de'
                    WHEN 4 THEN '  ' WHEN 5 THEN 'czechia' ELSE n_name END AS country,
               CASE s_suppkey % 4 WHEN 0 THEN 'Regular' WHEN 1 THEN ' Outlet ' WHEN 2 THEN '' ELSE NULL END
                   AS building_type,
               CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS STRING) AS gross_area,
               n_name AS city,
               lpad(CAST(s_suppkey AS STRING), 5, '0') AS zip,
               CASE WHEN s_suppkey % 6 = 0 THEN 'east' ELSE CAST(CAST(n_nationkey + 0.123 AS DECIMAL(13,6)) AS STRING) END
                   AS longitude,
               CAST(CAST(n_regionkey + 0.5 AS DECIMAL(13,6)) AS STRING) AS latitude,
               CASE WHEN s_acctbal < 0 THEN 'ZAMKNIETE' WHEN s_acctbal > 9000 THEN NULL ELSE 'OTWARTE' END AS class,
               """
    + BASE_ZONE
    + """ AS first_price,
               """
    + PROMO_ZONE
    + """ AS actual_price,
               nullif(r_name, 'ASIA') AS segment,
               CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE '2001-0' || CAST(1 + s_suppkey % 9 AS STRING) || '-15' END
                   AS opening_date,
               'A' AS mos_attribute_1,
               CASE WHEN s_suppkey % 2 = 0 THEN 'B' END AS mos_attribute_2
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    """,
    "community_raw": """
        SELECT ' ' || s_name || ' ' AS store_code,
               CASE s_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'x' ELSE CAST(10 * s_nationkey AS STRING) END
                   AS community_id
        FROM {supplier}
        UNION ALL
        SELECT s_name, CAST(s_suppkey AS STRING) FROM {supplier} WHERE s_acctbal > 5000
    """,
    # one calendar row per delivery: many openings per store
    "calendar_raw": """
        SELECT s_name AS store_code,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS opening_date,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END AS closing_date
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
    """,
    # prices of both sources, one row per delivery, in three date shapes
    "price_all": """
        SELECT l_linestatus, l_shipdate,
               CASE WHEN l_linenumber = 7 AND l_discount = 0 THEN '2024-13-01'
                    WHEN l_linenumber % 3 = 0 THEN d
                    WHEN l_linenumber % 3 = 1 THEN d || ' 00:00:00'
                    ELSE substr(d, 9, 2) || '.' || substr(d, 6, 2) || '.' || substr(d, 1, 4) END AS price_date,
               ' ' || CAST(l_partkey AS STRING) || ' ' AS product_agg_level_code,
               CASE l_linestatus WHEN 'F' THEN """
    + BASE_ZONE
    + """ ELSE """
    + PROMO_ZONE
    + """ END AS store_agg_level_code,
               CASE WHEN l_quantity = 1 THEN '0,00'
                    ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(13,2)) AS STRING), '.', ',') END AS price_with_tax,
               CASE WHEN l_suppkey % 5 = 0 THEN 'EUR' ELSE 'PLN' END AS currency
        FROM (SELECT *, CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS STRING) AS d FROM {lineitem}) AS l
        JOIN {supplier} ON l_suppkey = s_suppkey
        JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    """,
    "base_raw": """
        SELECT price_date, product_agg_level_code, store_agg_level_code, price_with_tax, currency
        FROM {price_all} WHERE l_linestatus = 'F'
    """,
    "retail_raw": """
        SELECT price_date, product_agg_level_code, store_agg_level_code, price_with_tax, currency
        FROM {price_all} WHERE l_linestatus = 'O'
    """,
    # the same files as delivered earlier
    "base_old": """
        SELECT price_date, product_agg_level_code, store_agg_level_code, price_with_tax, currency
        FROM {price_all} WHERE l_linestatus = 'F' AND l_shipdate < TIMESTAMP '2000-01-01 00:00:00'
    """,
    "retail_old": """
        SELECT price_date, product_agg_level_code, store_agg_level_code, price_with_tax, currency
        FROM {price_all} WHERE l_linestatus = 'O' AND l_shipdate < TIMESTAMP '2000-01-01 00:00:00'
    """,
    "sku_dictionary": """
        SELECT ' ' || CAST(p_partkey AS STRING) AS code FROM {part} WHERE p_type <> 'PROMO'
        UNION ALL
        SELECT CAST(p_partkey AS STRING) FROM {part} WHERE p_type = 'SMALL'
    """,
    "sales_raw": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate,
               s_name AS store_code,
               CAST(l_partkey AS STRING) AS product_code,
               CAST(o_orderdate AS DATE) AS sale_date,
               CAST(l_quantity AS DECIMAL(13,2)) AS quantity,
               CAST(l_extendedprice AS DECIMAL(13,2)) AS value,
               l_returnflag
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {supplier} ON l_suppkey = s_suppkey
    """,
    # daily quotes of a product: several per day, some without a price
    "quotes_raw": """
        SELECT CAST(l_partkey AS STRING) AS product_code, CAST(l_shipdate AS DATE) AS quote_date,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(13,2)) END AS price
        FROM {lineitem}
    """,
    "open_orders_raw": """
        SELECT CASE WHEN l_linenumber = 1 AND l_discount = 0 THEN '  ' ELSE ' S' || CAST(l_suppkey AS STRING) END
                   AS destination_code,
               CASE WHEN l_linenumber = 2 AND l_tax = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END AS product_code,
               replace(CAST(CAST(l_quantity AS DECIMAL(15,3)) AS STRING), '.', ',') AS quantity_ordered,
               CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 THEN 'soon'
                    ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS estimated_arrival_date
        FROM {lineitem} WHERE l_linestatus = 'O'
    """,
    "in_transit_raw": """
        SELECT 'S' || CAST(l_suppkey AS STRING) AS destination_code,
               CAST(l_partkey AS STRING) AS product_code,
               CASE WHEN l_linenumber = 5 THEN 'many' ELSE CAST(CAST(l_quantity AS DECIMAL(15,3)) AS STRING) END
                   AS quantity,
               CASE WHEN l_linenumber = 6 THEN '' ELSE CAST(l_shipdate AS STRING) END AS estimated_arrival_date
        FROM {lineitem} WHERE l_linestatus = 'F'
    """,
    # units: sales unit by size, conversion group by name and type
    "unit_product": """
        SELECT CAST(p_partkey AS STRING) AS product_code,
               CASE p_size % 3 WHEN 0 THEN 'PAR' WHEN 1 THEN '6PAK' ELSE 'SZT' END AS sales_unit,
               p_name || '/' || p_type AS `group`
        FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING), 'SZT', p_name || '/' || p_type FROM {part} WHERE p_partkey % 10 = 0
    """,
    "unit_conversion": """
        SELECT DISTINCT p_name || '/' || p_type AS `group`, 'SZT' AS from_unit,
               CASE p_size % 4 WHEN 0 THEN 'PAR' WHEN 1 THEN '5PAK' WHEN 2 THEN '6PAK' ELSE '12PAK' END AS to_unit,
               CASE WHEN p_size = 10 THEN 7 WHEN p_size % 4 = 0 THEN 1 WHEN p_size % 4 = 1 THEN 5
                    WHEN p_size % 4 = 2 THEN 6 ELSE 12 END AS factor
        FROM {part} WHERE p_size BETWEEN 8 AND 20
    """,
    "unit_stock": """
        SELECT CASE l_linestatus WHEN 'F' THEN 'warehouse' ELSE 'store' END AS context,
               l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate,
               CAST(l_partkey AS STRING) AS product_code,
               CASE WHEN l_returnflag = 'R' THEN '6PAK' ELSE 'SZT' END AS unit,
               CAST(l_quantity AS DECIMAL(15,3)) AS amount
        FROM {lineitem}
    """,
    "variants": """
        SELECT p_name || '-' || p_brand || '/' || CAST(p_size AS STRING) AS variant,
               p_name || '-' || p_brand AS parent,
               CAST(p_partkey AS STRING) AS product_code,
               CASE WHEN p_size <= 10 THEN 1 WHEN p_size = 50 THEN NULL ELSE 0 END AS is_active,
               CASE p_size % 3 WHEN 0 THEN 'PAR' WHEN 1 THEN 'SZT' ELSE 'MB' END AS unit
        FROM {part}
    """,
    "errors_raw": """
        SELECT event_type AS code, user_id AS error_key, CAST(ts AS DATE) AS error_day FROM {events}
    """,
    "delivery_a": """
        SELECT CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS parent,
               CASE WHEN o_custkey % 11 = 0 THEN NULL
                    ELSE CAST(o_custkey AS STRING) || '/' || o_orderpriority END AS variant
        FROM {orders} WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00'
    """,
    "delivery_b": """
        SELECT CAST(o_custkey % 100 + 1 AS STRING) AS parent,
               CASE WHEN o_custkey % 17 = 0 THEN NULL
                    ELSE CAST(o_custkey AS STRING) || '/' || o_orderpriority END AS variant
        FROM {orders} WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
    """,
    "customer_base": """
        SELECT c_name AS external_id, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(13,2)) AS balance
        FROM {customer}
    """,
    "customer_updates": """
        SELECT c_name AS external_id, MAX(o_orderpriority) AS segment,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(13,2))) AS DECIMAL(13,2)) AS balance
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        WHERE o_orderdate >= TIMESTAMP '2001-06-01 00:00:00' GROUP BY c_name
        UNION ALL
        SELECT s_name, 'SUPPLIER', CAST(s_acctbal AS DECIMAL(13,2)) FROM {supplier}
    """,
}


def _needs(sql: str) -> list[str]:
    return list(dict.fromkeys(name for _, name, _, _ in string.Formatter().parse(sql) if name))


class Frames:
    """Given tables and fixtures of one data folder by name, each looked up once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        elif name in FIXTURES:
            sql = FIXTURES[name]
            df = self.spark.sql(sql, **{n: getattr(self, n) for n in _needs(sql)})
        else:
            raise AttributeError(name)
        setattr(self, name, df)
        return df


def with_clause(*names: str, more: str = "") -> str:
    """WITH clause for DuckDB that defines the fixtures and what they need, then ``more``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for need in _needs(FIXTURES[name]):
            visit(need)
        ordered.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in ordered:
        sql = FIXTURES[name]
        body = sql.format(**{n: n for n in _needs(sql)}).replace("`group`", '"group"')
        parts.append(f"{name} AS ({body})")
    if more:
        parts.append(more)
    return "WITH " + ",\n".join(parts) + "\n"
