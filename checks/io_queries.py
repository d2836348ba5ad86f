"""Files written to the session's shared folder and read back."""

from retailprep.operators.keys import sample_head, sample_per_group
from retailprep.plans.price import price_output, price_totals
from retailprep.session import scratch_path, settle
from retailprep.sources import file_manifest, optional, publish, read_feed, read_latest, write_feed
from retailprep.sources.manifest import ALGORITHM, checksum
from pyspark.sql import functions as F

from .fixtures import with_clause
from .price_queries import FEED, full_feed
from .registry import query

INVENTORY = "store_code, product_code, inventory, inventory_date, stock_cost, currency"


@query("feed_roundtrip", with_clause("inventory_raw") + f"SELECT {INVENTORY} FROM inventory_raw")
def _(t):
    df = t.inventory_raw
    path = scratch_path(t.spark, "inventory.csv")
    write_feed(df.toDF(*[f" {c.title()} " for c in df.columns]), path, quoteAll=True)
    return read_feed(t.spark, path, trim=True).select(*INVENTORY.split(", "))


@query("latest_snapshot", with_clause("inventory_raw") + f"SELECT {INVENTORY} FROM inventory_raw")
def _(t):
    # written three times, summed up once
    df = settle(t.inventory_raw)
    folder = scratch_path(t.spark, "inventory")
    write_feed(df.filter("inventory_date IS NULL"), f"{folder}/inventory_2001_10_31.csv")
    write_feed(df, f"{folder}/inventory_2001_11_30.csv")
    write_feed(df.filter("inventory_date IS NOT NULL"), f"{folder}/other_2002_01_01.csv")
    return read_latest(t.spark, folder, "inventory_").select(*INVENTORY.split(", "))


@query(
    "optional_source",
    with_clause("store_raw")
    + """SELECT store_description, CAST(opening_date AS DATE) AS opening_date, CAST(NULL AS DATE) AS closing_date
        FROM store_raw""",
)
def _(t):
    missing = scratch_path(t.spark, "store_activity_calendar.csv")
    ddl = "store_description string, opening_date date, closing_date date"
    calendar = optional(lambda: read_feed(t.spark, missing, schema=ddl), ddl, t.spark)
    stores = t.store_raw.select("store_description", F.col("opening_date").try_cast("date").alias("own"))
    return stores.join(calendar, "store_description", "left").select(
        "store_description", F.coalesce("own", "opening_date").alias("opening_date"), "closing_date"
    )


@query(
    "price_partition_counts",
    FEED + "SELECT name, count(*) AS rows, CAST(max(priority) AS INTEGER) AS priority FROM feed GROUP BY name",
)
def _(t):
    path = scratch_path(t.spark, "price")
    write_feed(price_output(full_feed(t)), path, partition_by="name")
    written = read_feed(t.spark, path)
    return price_totals(written.withColumn("priority", F.col("priority").try_cast("int")))


@query(
    "sample_head",
    with_clause("sales_raw")
    + """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, store_code, value FROM sales_raw
        ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate LIMIT 1000""",
)
def _(t):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    return sample_head(t.sales_raw.select(*keys, "store_code", "value"), 1000, keys)


@query(
    "sample_per_group",
    with_clause("sales_raw")
    + "SELECT store_code, least(count(*), 500) AS rows, least(count(*), 500) AS keys FROM sales_raw GROUP BY store_code",
)
def _(t):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
    sample = sample_per_group(t.sales_raw.select("store_code", *keys), ["store_code"], 500, keys)
    # the rows themselves depend on the hash, so the check is on how many there are
    return sample.groupBy("store_code").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(*keys).alias("keys")
    )


@query(
    "content_manifest",
    """SELECT CAST(doc_id AS VARCHAR) || '.csv' AS file, 'SHA1' AS algorithm, sha1(text) AS checksum
        FROM documents""",
)
def _(t):
    return t.documents.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".csv")).alias("file"),
        F.lit(ALGORITHM).alias("algorithm"),
        checksum("text").alias("checksum"),
    )


KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
SOLD = f"SELECT {', '.join(f'CAST({k} AS VARCHAR) AS {k}' for k in KEYS)}, store_code, CAST(value AS VARCHAR) AS value"
FIRST = f"ORDER BY {', '.join(f'sales_raw.{k}' for k in KEYS)} LIMIT 1000"


def published(t, mode):
    full, sample = scratch_path(t.spark, "full"), scratch_path(t.spark, "sample")
    text = [F.col(k).cast("string").alias(k) for k in (*KEYS, "value")]
    days = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("l_shipdate")
    publish(t.sales_raw.select(*KEYS[:-1], days, "store_code", "value"), full, sample, mode, sample_order=KEYS, order_by=KEYS)
    out = []
    for name, path, modes in (("full", full, "FULL BOTH"), ("sample", sample, "TEST BOTH")):
        if mode in modes.split():
            out.append(read_feed(t.spark, path).select(F.lit(name).alias("output"), *text, "store_code"))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def day(sql):
    return sql.replace("CAST(l_shipdate AS VARCHAR)", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')")


@query("publish_full", with_clause("sales_raw") + day(f"{SOLD}, 'full' AS output FROM sales_raw"))
def _(t):
    return published(t, "FULL")


@query("publish_test", with_clause("sales_raw") + day(f"{SOLD}, 'sample' AS output FROM sales_raw {FIRST}"))
def _(t):
    return published(t, "TEST")


@query(
    "publish_both",
    with_clause("sales_raw")
    + day(f"({SOLD}, 'full' AS output FROM sales_raw) UNION ALL ({SOLD}, 'sample' AS output FROM sales_raw {FIRST})"),
)
def _(t):
    return published(t, "BOTH")


@query(
    "trimmed_read",
    "SELECT CASE WHEN c_mktsegment = '' THEN NULL ELSE c_mktsegment END AS segment, count(*) AS rows FROM customer GROUP BY 1",
)
def _(t):
    path = scratch_path(t.spark, "padded")
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    write_feed(t.customer.select(padded.alias(" Segment "), "c_name"), path)
    return read_feed(t.spark, path, trim=True).groupBy("segment").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "nulls_written_as_text",
    """SELECT CAST(c_custkey AS VARCHAR) AS code, CASE WHEN c_custkey % 3 = 0 THEN '-' ELSE c_name END AS name FROM customer""",
)
def _(t):
    path = scratch_path(t.spark, "nulls")
    rows = t.customer.select(F.col("c_custkey").alias("code"), F.expr("CASE WHEN c_custkey % 3 > 0 THEN c_name END").alias("name"))
    write_feed(rows, path, null_as="-", order_by=["code"])
    # read as the text that was written, without taking the token for a NULL again
    return read_feed(t.spark, path).select("code", "name")


@query("written_manifest", "SELECT CAST(count(DISTINCT c_mktsegment) AS BIGINT) AS lists, true AS hashed, true AS whole FROM customer")
def _(t):
    path = scratch_path(t.spark, "lists")
    write_feed(t.customer.select(F.col("c_mktsegment").alias("name"), "c_name", "c_acctbal"), path, partition_by="name")
    listed = file_manifest(t.spark, path)
    lines = t.spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.csv")
    again = lines.select(F.sha1("value").alias("checksum"), F.octet_length("value").cast("long").alias("bytes"))
    same = listed.join(again.distinct(), ["checksum", "bytes"], "left_semi")
    counted = same.agg(F.count_distinct(F.substring_index("file", "/", 1)).alias("lists"), F.count(F.lit(1)).alias("n"))
    total = listed.agg(F.count(F.lit(1)).alias("all"), F.bool_and(F.col("checksum").isNotNull()).alias("hashed"))
    sides = counted.selectExpr("lists", "n", "null AS total", "null AS hashed").unionByName(
        total.selectExpr("null AS lists", "null AS n", "all AS total", "hashed")
    )
    return sides.agg(F.max("lists").alias("lists"), F.bool_and("hashed").alias("hashed"), (F.max("n") == F.max("total")).alias("whole"))
