"""Layouts that daily work neither shuffles nor rewrites, and reports taken while writing."""

import hashlib
import os
import random
import shutil
import uuid
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailprep.operators.delta import bucketed_upsert, compare_deliveries, delta
from retailprep.operators.enrich import MOST_BLOCKS, keep_known, maybe_known
from retailprep.operators.keys import global_rank
from retailprep.operators.quality import audited, blank_check, quality_counts, quality_report
from retailprep.operators.temporal import accumulate, asof_instant, asof_join, asof_window
from retailprep.operators.units import convert_units, missing_conversions
from retailprep.plans import jobs, price
from retailprep.sources import (
    extend_history,
    file_manifest,
    publish_version,
    read_feed,
    read_history,
    store_bucketed,
    write_feed,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """Joins that shuffle whatever the size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# prices by list, product and day


def some_prices(spark, seed, products, days):
    rng = random.Random(seed)
    made = [
        (rng.choice("AB"), None if p == 0 else p, date(2024, 1, 1) + timedelta(rng.randrange(days)), Decimal(rng.randrange(1, 900)) / 100)
        for p in products
        for _ in range(6)
    ]
    return spark.createDataFrame(made, "name string, product long, start_date date, value decimal(15,2)")


KEYS = ["name", "product"]


def modified(folder):
    return {p: os.stat(p).st_mtime_ns for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet") for p in [f"{d}/{n}"]}


def test_history_grows_like_the_full_recompute(spark, tmp_path):
    path = str(tmp_path / "history")
    whole = None
    for seed, products in ((1, range(40)), (2, range(30, 50)), (3, [0, 7])):
        snapshot = some_prices(spark, seed, products, 30)
        before = modified(path)
        touched = extend_history(spark, path, snapshot, KEYS, "start_date", "value", buckets=16)
        empty = spark.createDataFrame([], snapshot.schema)
        # kept as rows, so that the next round does not recompute it
        whole = accumulate(empty if whole is None else whole, snapshot, KEYS, "start_date", "value")
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        stored = read_history(spark, path, 16)
        assert rows(stored.select(whole.columns)) == rows(whole)
        # folders without a key of the snapshot keep their files
        kept = {p for p in before if int(p.split("part_of_16=")[1].split("/")[0]) not in touched}
        after = modified(path)
        assert {p: after.get(p) for p in kept} == {p: before[p] for p in kept}
    assert len(touched) <= 4 and kept
    # the same snapshot again changes nothing
    extend_history(spark, path, snapshot, KEYS, "start_date", "value", buckets=16)
    assert rows(read_history(spark, path, 16).select(whole.columns)) == rows(whole)
    with pytest.raises(ValueError, match="not kept in 8"):
        read_history(spark, path, 8)


def test_a_failed_increment_leaves_the_history(spark, tmp_path):
    path = str(tmp_path / "history")
    extend_history(spark, path, some_prices(spark, 1, range(20), 30), KEYS, "start_date", "value", buckets=4)
    before = modified(path)
    broken = some_prices(spark, 2, range(20), 30).withColumn(
        "value", F.when(F.col("product") == 7, F.raise_error(F.lit("broken")).cast("decimal(15,2)")).otherwise(F.col("value"))
    )
    with pytest.raises(Exception, match="broken"):
        extend_history(spark, path, broken, KEYS, "start_date", "value", buckets=4)
    assert modified(path) == before


def test_bucketed_dictionary_is_not_shuffled(shuffled, tmp_path):
    spark = shuffled
    known = spark.range(0, 5000).selectExpr("id AS k", "id % 3 AS v")
    name = f"known_{uuid.uuid4().hex}"
    stored = store_bucketed(known, name, ["k"], 8, str(tmp_path / name))
    full = spark.range(4000, 5500).selectExpr("id AS k", "CASE WHEN id % 100 = 0 THEN 9 ELSE id % 3 END AS v")
    changed = delta(full, stored, ["k"], ["v"])
    assert rows(changed) == rows(delta(full, known, ["k"], ["v"])) and changed.count() == 510
    # one exchange, of the full side; the stored side is read bucket by bucket
    plan = plan_of(changed).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange" not in plan[plan.rindex("SortMergeJoin") :].split("FileScan")[0].split("Exchange hashpartitioning", 1)[1]
    assert "Bucketed: true" in plan


def test_versions_of_a_bucketed_table(shuffled, tmp_path):
    spark = shuffled
    view = f"customers_{uuid.uuid4().hex}"
    base = publish_version(spark.range(100).selectExpr("id", "'old' AS state"), view, ["id"], 8, str(tmp_path / "1"))
    updates = spark.range(90, 110).selectExpr("id", "'new' AS state")
    merged = bucketed_upsert(base, updates, ["id"])
    assert plan_of(merged).count("Exchange hashpartitioning") == 1
    after = publish_version(merged, view, ["id"], 8, str(tmp_path / "2"))
    assert rows(after.groupBy("state").count()) == [("new", 20), ("old", 90)]
    assert spark.table(view).count() == 110


def test_lists_that_come_replace_theirs(spark, tmp_path):
    path = str(tmp_path / "lists")
    first = spark.range(300).select(F.concat(F.lit("L"), (F.col("id") % 3).cast("string")).alias("name"), "id")
    write_feed(first, path, partition_by="name")
    write_feed(first.filter("name = 'L1' AND id < 30"), path, partition_by="name", replace="LISTS")
    assert rows(read_feed(spark, path).groupBy("name").count()) == [("L0", 100), ("L1", 10), ("L2", 100)]
    broken = first.filter("name <> 'L1'").withColumn("id", F.when(F.col("id") == 299, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        write_feed(broken, path, partition_by="name", replace="LISTS")
    assert rows(read_feed(spark, path).groupBy("name").count()) == [("L0", 100), ("L1", 10), ("L2", 100)]
    write_feed(first.filter("name = 'L2'"), path, partition_by="name")
    assert rows(read_feed(spark, path).groupBy("name").count()) == [("L2", 100)]
    for wrong in ({"replace": "SOME", "partition_by": "name"}, {"replace": "LISTS"}):
        with pytest.raises(ValueError, match="cannot replace"):
            write_feed(first, path, **wrong)


# as-of by instant


def moment(seconds):
    return datetime(2024, 1, 1) + timedelta(seconds=seconds)


def plain_asof(facts, quotes):
    out = []
    for i, key, at in facts:
        best = None
        if key is not None and at is not None:
            usable = [(t, p is None, p) for k, t, p in quotes if k == key and t is not None and t <= at]
            newest = max((t for t, _, _ in usable), default=None)
            best = min((x for x in usable if x[0] == newest), default=None)
        out.append((i, best and best[0], best and best[2]))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_seconds", [1, 7, 3600])
def test_asof_by_instant(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    when = lambda: rng.choice([None, *map(moment, range(-40, 40)), moment(0.000001), moment(5.5)])
    facts = [(i, rng.choice(["a", "b", None]), when()) for i in range(300)]
    quotes = [(rng.choice(["a", "b", "c", None]), when(), rng.choice([None, 1, 2, 3])) for _ in range(40)]
    found = asof_instant(
        spark.createDataFrame(facts, "id long, k string, at timestamp"),
        spark.createDataFrame(quotes, "k string, qt timestamp, p int"),
        ["k"],
        "at",
        "qt",
        ["p"],
        slice_seconds,
    )
    assert rows(found.select("id", "qt", "p")) == plain_asof(facts, quotes)


def test_asof_at_nine_and_at_fifteen(spark):
    facts = spark.createDataFrame([(datetime(2024, 1, 1, 9), "x"), (datetime(2024, 1, 1, 16), "x")], "at timestamp, k string")
    quotes = spark.createDataFrame([("x", datetime(2024, 1, 1, 15), 5)], "k string, qt timestamp, p int")
    assert [r.p for r in asof_instant(facts, quotes, ["k"], "at", "qt", ["p"]).orderBy("at").collect()] == [None, 5]
    assert [r.p for r in asof_join(facts, quotes, ["k"], "at", "qt", ["p"]).collect()] == [5, 5]


def test_asof_spreads_a_hot_key(spark):
    # a third of a million rows of one key, a second apart: each window has an hour of them
    facts = spark.range(0, 300_000, 1, 8).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("at"), "id")
    quotes = spark.range(0, 300_000, 9000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("qt"), F.col("id").alias("p"))
    found = asof_instant(facts, quotes, ["k"], "at", "qt", ["p"])
    wrong = found.filter(~F.col("p").eqNullSafe(F.floor(F.col("id") / 9000) * 9000))
    assert found.count() == 300_000 and wrong.isEmpty()
    plan = plan_of(asof_instant(facts, quotes, ["k"], "at", "qt", ["p"]))
    windows = [line for line in plan.splitlines() if "+- Window [" in line or ":- Window [" in line]
    assert len(windows) == 2 and sum("__slice" in w.split("], [")[-2] for w in windows) >= 1


def test_asof_window_like_the_join(spark):
    rng = random.Random(5)
    day = lambda: rng.choice([None, *(date(2024, 1, d) for d in range(1, 20))])
    facts = spark.createDataFrame([(i, rng.choice(["a", "b", None]), day()) for i in range(200)], "id long, k string, d date")
    quotes = spark.createDataFrame([(rng.choice(["a", "b", None]), day(), rng.choice([None, 1, 2])) for _ in range(30)], "k string, qd date, p int")
    arguments = (facts, quotes, ["k"], "d", "qd", ["p"])
    assert rows(asof_window(*arguments)) == rows(asof_join(*arguments))


# reports


def test_audit_is_counted_while_writing(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(0, 1000, 1, 4).selectExpr("id", "CASE WHEN id % 10 = 0 THEN '' ELSE 'x' END AS k").write.parquet(source)
    kept, report = audited(spark.read.parquet(source), {"blank": F.col("k") == "", "small": F.col("id") < 100})
    write_feed(kept, str(tmp_path / "out"))
    shutil.rmtree(source)
    assert dict(rows(report())) == {"total": 1000, "blank": 100, "small": 90, "kept": 810}
    assert read_feed(spark, str(tmp_path / "out")).count() == 810


def test_observed_report_like_the_aggregation(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), ("x", None)], "a string, b int")
    checks = [blank_check("a"), blank_check("b", "CRITICAL")]
    seen, report = quality_counts(checks).observed(df)
    seen.collect()
    assert rows(report()) == rows(quality_report(df, checks))
    seen, report = quality_counts(checks).observed(df.filter("false"))
    seen.collect()
    assert rows(report()) == rows(quality_report(df.filter("false"), checks))


def test_jobs_read_their_input_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    orders, transit, stock = (str(folder / n) for n in ("orders.csv", "transit.csv", "stock.csv"))
    (folder / "orders.csv").write_text("destination_code|product_code|quantity_ordered|estimated_arrival_date\nS1|1|2|2026-04-01\n|1|1|2026-04-01\n")
    (folder / "transit.csv").write_text("destination_code|product_code|quantity|estimated_arrival_date\nS2|3|x|\n")
    (folder / "stock.csv").write_text("inventory_warehouse_date|warehouse_code|product_code|inventory\n2026-04-01|W||2,5\n")
    inbound = jobs.import_inbound(spark, orders, transit, str(tmp_path / "inbound"), str(tmp_path / "sample"), mode="BOTH")
    warehouse = jobs.import_warehouse_stock(spark, stock, str(tmp_path / "warehouse"))
    shutil.rmtree(folder)
    assert dict(rows(inbound["volume"])) == {"total": 3, "blank_key": 1, "no_date": 1, "kept": 1}
    assert ("product_code", 1, 1, Decimal("100.000")) in rows(warehouse["blanks"])


def test_sales_report_is_counted_while_writing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    price_header = "store_agg_level_code|product_agg_level_code|price_date|price_with_tax"
    for name, text in (
        ("sales.csv", "store_code;product_code;sale_date;quantity;value\nS1;1;2024-01-05;2;20\nS9;1;2024-01-05;1;9\nS1;7;2024-01-05;1;9\n"),
        ("stores.csv", "store_code;country;first_price;actual_price\nS1;po;PLREGF;PLREGF\n"),
        ("base.csv", f"{price_header}\nPLREGF|1|2024-01-01|5,00\n"),
        ("retail.csv", f"{price_header}\nPLREGF|2|2024-01-01|5,00\n"),
    ):
        (folder / name).write_text(text)
    paths = [str(folder / n) for n in ("sales.csv", "stores.csv", "base.csv", "retail.csv")]
    reports = jobs.import_sales(spark, *paths, F.lit(False), str(tmp_path / "out"))
    shutil.rmtree(folder)
    assert rows(reports["unmatched"]) == [(3, 1, 1)] and rows(reports["rows"]) == [(3,)]


# checksums of long files


CONTENTS = {
    "plain.csv": b"a;b\n1;2\n",
    "open.csv": b"a;b\n1;2",
    "windows.csv": b"a;b\r\n1;2\r\n\r\n",
    "mark.csv": b"\xef\xbb\xbfa;b\n1;2\n",
    "mark open.csv": b"\xef\xbb\xbfa;b",
    "bytes+%.csv": bytes(range(256)) * 3,
    "blank.csv": b"\n\n\n",
    "sub/long.csv": b"x" * 100_000 + b"\n" + b"y;z\n" * 300_000,
}


def test_long_files_are_streamed(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    want = {**CONTENTS, "one.csv": b"x"}
    for name, content in want.items():
        (tmp_path / name).write_bytes(content)
    manifest = file_manifest(spark, str(tmp_path), longest=2)
    assert rows(manifest) == sorted((n, "SHA1", hashlib.sha1(c).hexdigest(), len(c)) for n, c in want.items())
    assert rows(manifest) == rows(file_manifest(spark, str(tmp_path)))


# ranks and membership


@pytest.mark.parametrize("ranges", [1, 5, 256])
def test_rank_over_ranges(spark, ranges):
    rng = random.Random(ranges)
    values = [None, "", *("Cennik_bazowy_" + "".join(rng.choice("abÄz") for _ in range(3)) for _ in range(300))]
    df = spark.createDataFrame([(rng.choice(values),) for _ in range(3000)], "name string").repartition(7)
    found = global_rank(df, "name", ranges=ranges)
    distinct = sorted({r.name for r in df.collect()}, key=lambda v: (v is not None, (v or "").encode()))
    assert rows(found) == sorted(((v, i + 1) for i, v in enumerate(distinct)), key=str)


def test_rank_has_no_window_over_all(spark):
    plan = plan_of(global_rank(spark.range(1000).selectExpr("CAST(id AS STRING) AS name"), "name"))
    assert "Window [row_number() windowspecdefinition(name" not in plan
    assert plan.count("Exchange SinglePartition") == 1  # the counts of the ranges


def test_lists_ranked_in_one_task_are_bounded(spark, monkeypatch):
    df = spark.range(20).selectExpr("CAST(id AS STRING) AS name")
    assert rows(price.rank_names(df, "name", few=True)) == rows(price.rank_names(df, "name"))
    monkeypatch.setattr(price, "MOST_LISTS", 10)
    with pytest.raises(Exception, match="many_lists"):
        price.rank_names(df, "name", few=True).collect()


def test_bloom_filter_drops_unknown_keys_before_the_shuffle(shuffled):
    spark = shuffled
    feed = spark.range(0, 200_000).selectExpr("CAST(id AS STRING) AS k", "id % 5 AS z")
    known = spark.range(0, 200_000, 40).selectExpr("CAST(id AS STRING) AS k")
    likely = maybe_known(feed, known, ["k"], 5000)
    assert likely.columns == feed.columns
    exact = keep_known(feed, known, ["k"])
    assert rows(keep_known(likely, known, ["k"])) == rows(exact)
    # 5,000 known rows and about a hundredth of the others reach the shuffle
    assert 5000 <= likely.count() < 5000 + 195_000 // 25
    plan = plan_of(likely)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # a filter for many more keys than it was sized for is only weaker
    assert rows(keep_known(maybe_known(feed, known, ["k"], 1), known, ["k"])) == rows(exact)
    # where it could not be broadcast it is left out
    assert "Join" not in plan_of(maybe_known(feed, known, ["k"], 200 * MOST_BLOCKS))
    pairs = feed.withColumn("n", F.lit(None).cast("int"))
    assert maybe_known(pairs, pairs, ["k", "n"], 5000).isEmpty()


# odd rows


def test_tiny_factors(spark):
    stock = spark.createDataFrame([("p", "G", Decimal("2")), ("q", "G", Decimal("2")), ("r", "G", Decimal("2"))], "product_code string, unit string, amount decimal(15,3)")
    products = spark.createDataFrame([("p", "T", "g"), ("q", "U", "g"), ("r", "V", "g")], "product_code string, sales_unit string, `group` string")
    conversions = spark.createDataFrame([("g", "G", "T", "0.0000001"), ("g", "G", "U", "0"), ("g", "G", "V", None)], "`group` string, from_unit string, to_unit string, factor string")
    found = {r.product_code: (r.converted, r.status) for r in convert_units(stock, products, conversions).collect()}
    assert found == {"p": (Decimal("20000000.000000"), "converted"), "q": (None, "unusable"), "r": (None, "unusable")}
    gaps = missing_conversions(stock, products, conversions, [])
    assert rows(gaps) == [("G", "U", 1, 1), ("G", "V", 1, 1)]


def test_empty_deliveries(spark):
    empty = spark.createDataFrame([], "variant string, parent string")
    assert tuple(compare_deliveries(empty, empty, "variant", "parent").first()) == (0,) * 8
