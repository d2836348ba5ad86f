"""Plans and hot keys: what must hold when one key has a large part of all rows."""

import re
from contextlib import contextmanager
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks.fixtures import Frames
from retailprep.operators.attributes import consensus
from retailprep.operators.delta import delta
from retailprep.operators.enrich import exclude_value, keep_known, new_rows, since
from retailprep.operators.keys import latest_by, sample_per_group
from retailprep.operators.quality import blank_check, quality_report
from retailprep.operators.temporal import accumulate, asof_join, asof_windows, lowest_value
from retailprep.operators.units import convert_units
from retailprep.plans.price import price_feed
from retailprep.plans.sales import sales_feed
from retailprep.sources import read_feed, write_feed

SF_DIR = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def tiny_skew(spark):
    """Shuffle everything, and call a partition skewed from a few kilobytes on."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="40k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="80k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2.0",
    ):
        yield


@pytest.fixture
def hot(spark):
    """Half of 200,000 rows have one key."""
    # eight parts, so that AQE has map outputs to split the hot key by
    return spark.range(0, 200_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_query_joins_all_pairs(spark, name):
    plan = planned(queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "Python" not in plan


def test_hot_key_joins_are_split(spark, hot):
    known = hot.select("k")
    with tiny_skew(spark):
        for joined, rows in (
            (keep_known(hot, known.filter("k = 'hot'"), ["k"]), 100_000),
            (new_rows(hot, known.filter("k <> 'hot'"), ["k"]), 100_000),
        ):
            assert "skewed" in final_plan(joined)
            assert joined.count() == rows


def test_hot_key_asof_join(spark, hot):
    # nearly all sales of the hot key fall on one day
    hot = hot.withColumn("d", F.when(F.col("id") % 20 != 0, F.lit(date(2024, 2, 1))).otherwise(F.col("d")))
    quotes = spark.range(3).select(
        F.lit("hot").alias("k"), F.date_add(F.lit(date(2024, 1, 10)), (F.col("id") * 30).cast("int")).alias("qd"), (F.col("id") + 1).alias("p")
    )
    with tiny_skew(spark):
        joined = asof_join(hot, quotes, ["k"], "d", "qd", ["p"])
        plan = final_plan(joined)
        assert "skewed" in plan
        # facts are joined, not windowed: the window sees keys and days only
        window = plan[plan.index("Window [") :]
        assert "payload" not in window
        got = {(r["d"], r["p"]) for r in joined.filter("k = 'hot'").select("d", "p").distinct().collect()}
        assert joined.count() == 200_000
    day = date(2024, 1, 1)
    assert got == {
        (day + timedelta(i), None if i < 9 else 1 if i < 39 else 2 if i < 69 else 3) for i in {*range(0, 90, 10), 31}
    }


def test_hot_keys_shrink_before_the_shuffle(spark, hot):
    for picked in (latest_by(hot, ["k"], "d", ["id"]), sample_per_group(hot, ["k"], 1000, ["id"])):
        plan = planned(picked)
        assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    for lowest in (lowest_value(hot, ["k"], "id"), lowest_value(hot, ["k"], "id", ["payload"])):
        plan = planned(lowest)
        assert plan.index("Exchange hashpartitioning") < plan.index("partial_min")


def test_hot_parent_consensus(spark, hot):
    children = hot.withColumn("v", F.when(F.col("id") % 10 == 0, "odd").otherwise("even")).withColumn("w", F.lit(None).cast("string"))
    with tiny_skew(spark):
        out = consensus(children.select("k", "id", "v", "w", "payload"), "k", ["v", "w"])
        assert "skewed" in final_plan(out)
        assert out.groupBy("k").agg(F.count_distinct("v").alias("n")).filter("n > 1").isEmpty()
        assert out.count() == 200_000


def test_hot_list_is_written_in_several_parts(spark, tmp_path, hot):
    with tiny_skew(spark):
        write_feed(hot.withColumn("name", F.when(F.col("k") == "hot", "hot").otherwise("rest")), str(tmp_path / "out"), partition_by="name")
    assert len(list((tmp_path / "out" / "name_key=hot").glob("part-*"))) > 1
    assert read_feed(spark, str(tmp_path / "out")).count() == 200_000


def test_hot_key_delta(spark, hot):
    known = hot.filter("d < date'2024-03-01'")
    with tiny_skew(spark):
        out = delta(hot, known.unionByName(known), ["k", "id"], ["d"])
        assert out.count() == hot.filter("d >= date'2024-03-01'").count()


def test_prices_are_shuffled_once_for_list_and_rank(spark):
    t = Frames(spark, SF_DIR)
    plan = final_plan(price_feed(t.base_raw, t.retail_raw, t.store_raw, t.sku_dictionary))
    assert re.search(r"ReusedExchange \[source.*market_code", plan)
    # the only global window runs over the names of the lists
    singles = re.findall(r"\n(.*)\n.*\n.*Exchange SinglePartition", plan)
    assert len(singles) == 1
    assert "name#" in singles[0]


def test_reports_read_only_their_columns_in_one_pass(spark, tmp_path, hot):
    hot.write.parquet(str(tmp_path / "hot"))
    plan = planned(quality_report(spark.read.parquet(str(tmp_path / "hot")), [blank_check("k")]))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<k:string>" in plan


def test_filters_reach_the_scan(spark, tmp_path, hot):
    hot.write.parquet(str(tmp_path / "hot"))
    df = exclude_value(since(spark.read.parquet(str(tmp_path / "hot")), "d", "2024-02-01"), "k", "hot")
    plan = planned(df.select("id"))
    assert "GreaterThanOrEqual(d,2024-02-01)" in plan
    assert "Not(EqualTo(k,hot))" in plan
    assert "payload" not in plan


def test_broadcastable_checks_run_before_the_aggregation(spark, tmp_path, hot):
    hot.write.parquet(str(tmp_path / "hot"))
    spark.createDataFrame([("hot",)], "k string").write.parquet(str(tmp_path / "known"))
    rows, known = spark.read.parquet(str(tmp_path / "hot")), spark.read.parquet(str(tmp_path / "known"))
    plan = planned(keep_known(lowest_value(rows, ["k", "d"], "id"), known, ["k"]))
    assert plan.index("partial_min") < plan.index("BroadcastHashJoin")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = planned(keep_known(lowest_value(rows, ["k", "d"], "id"), known, ["k"]))
    assert plan.index("SortMergeJoin") < plan.index("partial_min")


def test_sales_are_read_twice_and_hot_stores_split(spark, tmp_path):
    days = F.date_format(F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 90).cast("int")), "yyyy-MM-dd")
    store = F.when(F.col("id") % 10 > 0, " hot").otherwise(F.concat(F.lit("S"), F.col("id") % 700))
    product = F.concat(F.lit("P"), F.col("id") % 50)
    sold = spark.range(200_000).select("id", store.alias("store_code"), product.alias("product_code"), days.alias("sale_date"), F.lit("1").alias("quantity"), F.lit("10,0").alias("value"), F.repeat(F.lit("x"), 50).alias("payload"))
    sold.write.parquet(str(tmp_path / "sales"))
    stores = spark.range(700).select(F.concat(F.lit("S"), "id").alias("store_code"), F.lit("PL").alias("country"), F.lit("Z").alias("first_price"), F.lit("Z").alias("actual_price"))
    stores = stores.unionByName(stores.limit(1).withColumn("store_code", F.lit("hot ")))
    quotes = spark.range(50).select(F.concat(F.lit("P"), "id").alias("product_code"), F.lit("Z").alias("zone"), F.lit(date(2024, 1, 1)).alias("start_date"), F.lit(5).cast("decimal(13,2)").alias("value"))
    with tiny_skew(spark):
        out = sales_feed(spark.read.parquet(str(tmp_path / "sales")), stores, quotes, quotes, F.lit(False), keys=["id"])
        plan = final_plan(out)
        assert "skewed" in plan
    # once here; the distinct products, zones and days were read and settled before
    assert len(re.findall(r"FileScan parquet .*store_code", plan)) == 1
    assert out.count() == 200_000
    assert out.filter("price_promo IS NULL").isEmpty()


def test_hot_conversion_group_is_split(spark):
    stock = spark.range(200_000).select("id", F.concat(F.lit("P"), F.col("id") % 5000).alias("product_code"), F.lit("SZT").alias("unit"), F.lit(6).cast("decimal(15,3)").alias("amount"))
    products = spark.range(5000).select(F.concat(F.lit("P"), "id").alias("product_code"), F.lit("6PAK").alias("sales_unit"), F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("g"), "id")).alias("group"))
    rules = products.select("group").distinct().select("group", F.lit("SZT").alias("from_unit"), F.lit("6PAK").alias("to_unit"), F.lit(6).alias("factor"))
    with tiny_skew(spark):
        out = convert_units(stock, products, rules)
        assert "skewed" in final_plan(out)
        assert out.groupBy("status").count().collect() == [("converted", 200_000)]


def test_history_and_snapshot_meet_in_one_shuffle(shuffled_prices):
    spark, prices = shuffled_prices
    plan = planned(accumulate(prices, prices, ["product", "name"], "day", "value", ["currency"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Aggregate" not in plan


def test_delta_of_days_and_numbers_does_not_sort_to_aggregate(shuffled_prices):
    spark, prices = shuffled_prices
    known = prices.unionByName(prices.withColumn("value", F.when(F.col("product") == "P3", F.lit(None)).otherwise(F.col("value"))))
    out = delta(prices, known, ["product", "day", "name"], ["end_date", "value"])
    assert "SortAggregate" not in planned(out)
    # a version without a value is another one, unless there is none now either
    assert {r["product"] for r in out.collect()} == {"P3"}
    none = prices.withColumn("value", F.lit(None).cast("decimal(15,2)"))
    assert delta(none, none.unionByName(none), ["product", "day", "name"], ["end_date", "value"]).isEmpty()
    assert delta(none, prices, ["product", "day", "name"], ["value"]).count() == prices.count()


def test_prices_are_not_shuffled_by_list(spark):
    t = Frames(spark, SF_DIR)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = planned(price_feed(t.base_raw, t.retail_raw, t.store_raw, t.sku_dictionary))
    assert not re.search(r"Exchange hashpartitioning\(name#\d+, \d+\), ENSURE_REQUIREMENTS.*\n.*Project .*product_code", plan)
    assert not re.search(r"SortMergeJoin \[name", plan)
    # known products are looked up and prices are dated in one shuffle by the product
    assert len(re.findall(r"Exchange hashpartitioning\(product_code#\d+, \d+\)", plan)) >= 1
    assert not re.search(r"Exchange hashpartitioning\(product_code#\d+, market_code#\d+, source#\d+, \d+\)", plan)


@pytest.fixture
def shuffled_prices(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        yield spark, spark.range(60).selectExpr(
            "concat('P', id % 20) AS product", "'L' AS name", "date_add(date'2024-01-01', cast(id div 20 AS int)) AS day",
            "cast(id AS decimal(15,2)) AS value", "'PLN' AS currency", "cast(NULL AS date) AS end_date",
        )


def test_asof_join_reads_and_shuffles_facts_once(shuffled_prices):
    spark, prices = shuffled_prices
    facts = prices.select("product", "day", "currency")
    plan = planned(asof_join(facts, prices.withColumnRenamed("day", "quoted"), ["product"], "day", "quoted", ["value"]))
    assert plan.count("Range (") == 2
    # facts for the join; quotes to find the lowest, to date them and for the join
    assert plan.count("Exchange hashpartitioning") == 4


def test_both_sales_prices_are_looked_up_in_one_shuffle(spark):
    sold = spark.createDataFrame(
        [("A", "X", "Y", d) for d in (date(2024, 1, 5), date(2024, 2, 5), None)] + [("A", None, "Y", date(2024, 2, 5)), (None, "X", "Y", date(2024, 2, 5))],
        "product string, first string, second string, day date",
    )
    rows = [("A", "X", date(2024, 1, 6), 3), ("A", "X", date(2024, 1, 6), 2), ("A", None, date(2024, 1, 1), 9), ("A", "Z", date(2024, 1, 1), 9)]
    base = spark.createDataFrame(rows, "product string, first string, start date, one int")
    other = spark.createDataFrame([("A", "Y", date(2024, 1, 5), 7), ("A", "Y", date(2024, 2, 5), None)], "product string, second string, start date, two int")
    lists = {"one": (base, "first", "start"), "two": (other, "second", "start")}
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        out = asof_windows(sold, "day", "product", lists)
        assert planned(out).count("Exchange hashpartitioning") == 3
    got = {(r["product"], r["first"], r["day"]): (r["one"], r["two"]) for r in out.collect()}
    february = date(2024, 2, 5)
    assert got == {
        ("A", "X", date(2024, 1, 5)): (None, 7), ("A", "X", february): (2, None), ("A", "X", None): (None, None),
        ("A", None, february): (None, None), (None, "X", february): (None, None),
    }


def test_written_snapshots_are_summed_up_once(spark, monkeypatch):
    plans = []

    def noted(df, *args, **options):
        plans.append(planned(df))
        write_feed(df, *args, **options)

    monkeypatch.setattr("checks.io_queries.write_feed", noted)
    assert not queries()["latest_snapshot"](spark, SF_DIR).isEmpty()
    assert len(plans) == 3
    assert not [p for p in plans if "Aggregate" in p]
