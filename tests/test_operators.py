"""Operators against brute force and by their properties."""

import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailprep.operators import delta as D
from retailprep.operators import diagnostics, quality, units
from retailprep.operators.attributes import (
    consensus,
    find_conflicts,
    group_sizes,
    hierarchy,
    join_attributes,
    pivot_attributes,
)
from retailprep.operators.enrich import (
    active_keys,
    exclude_value,
    fill_from,
    keep_active,
    keep_known,
    lookup_fill,
    new_rows,
    only,
    override,
    since,
    stack,
)
from retailprep.operators.keys import dedupe, latest_by, lowest_by, sample_head, sample_per_group
from retailprep.operators.schema import MissingColumns, Spec, attribute_columns, check_columns, clean_name, conform
from retailprep.operators.temporal import accumulate, asof_join, lowest_value, price_fallback, validity


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# schema


def test_missing_columns_are_named(spark):
    df = frame(spark, "Store_Code string", ("S1",))
    assert check_columns(df, ["store_code"]) is df
    with pytest.raises(MissingColumns, match="name"):
        check_columns(df, ["store_code", "name"])


def test_conform(spark):
    spec = Spec(
        columns={"code": "string", "unit": "string", "price": "decimal(10,2)", "day": "date", "shelf": "string"},
        mapping={"code": "product_code", "price": "Price"},
        constants={"unit": "ST"},
        exclude=frozenset({"shelf"}),
        optional={"x": "int", "y": "int"},
    )
    df = frame(spark, "product_code string, PRICE string, x string", ("A", "1.005", "7"), ("B", "bad", "bad"))
    out = conform(df, spec)
    assert out.dtypes == [
        ("code", "string"),
        ("unit", "string"),
        ("price", "decimal(10,2)"),
        ("day", "date"),
        ("x", "int"),
    ]
    assert rows(out) == [("A", "ST", Decimal("1.01"), None, 7), ("B", "ST", None, None, None)]


def test_clean_names_and_collisions(spark):
    assert clean_name("  Sex / Department!") == "sex_department"
    df = frame(spark, "`Sex Dept` string, `sex-dept` string, Code string", ("a", "b", "c"))
    out = df.select(*attribute_columns(df, ["Sex Dept", "sex-dept", "Code", "absent"], ["code"]))
    assert out.columns == ["sex_dept"]
    assert rows(out) == [("a",)]


# filters and joins


def test_filters_and_nulls(spark):
    df = frame(spark, "g string, d date", ("-1", date(2024, 1, 1)), (None, None), ("a", date(2024, 1, 2)))
    assert rows(exclude_value(df, "g", "-1").select("g")) == [("a",)]
    assert rows(exclude_value(df, "g", "-1", null_safe=True).select("g")) == [("a",), (None,)]
    assert since(df, "d").count() == 3
    assert rows(since(df, "d", "2024-01-02").select("g")) == [("a",)]
    assert only(df, "g").count() == only(df, "g", []).count() == 3
    assert rows(only(df, "g", ["a"]).select("g")) == [("a",)]
    assert rows(only(df, "g", frame(spark, "g string", ("a",), ("a",))).select("g")) == [("a",)]


def test_membership(spark):
    df = frame(spark, "k string, v int", ("a", 1), ("a", 2), ("b", 3), (None, 4))
    known = frame(spark, "k string", ("a",), ("a",), (None,))
    assert rows(keep_known(df, known, ["k"])) == [("a", 1), ("a", 2)]
    assert rows(new_rows(df, known, ["k"])) == [("b", 3), (None, 4)]
    active = active_keys("k", known, frame(spark, "k string, z int", ("b", 1)))
    assert rows(active) == [("a",), ("b",)]
    assert rows(keep_active(df, active, "k")) == [("a", 1, 1), ("a", 2, 1), ("b", 3, 1)]


def test_lookup_fill(spark):
    df = frame(spark, "store_code string", (" S1",), ("S2",), ("S3",), (None,))
    ref = frame(spark, "store_code string, c string", ("S1 ", "9"), ("S1", "7"), ("S2", None), ("S3", "x"), (None, "1"))
    assert rows(lookup_fill(df, ref, "store_code", "c", "int")) == [(" S1", 7), ("S2", None), ("S3", None), (None, None)]
    has = df.withColumn("C", F.lit("own"))
    assert lookup_fill(has, ref, "store_code", "c") is has


def test_fill_from_keeps_own_values(spark):
    df = frame(spark, "k string, a string", ("x", "own"), ("y", None), ("z", None))
    ref = frame(spark, "k string, a string, b string", ("x", "1", "2"), ("y", "3", None))
    assert rows(fill_from(df, ref, "k", ["a", "b"])) == [("x", "own", "2"), ("y", "3", None), ("z", None, None)]


def test_override(spark):
    df = frame(spark, "k string, a int", ("x", 0), ("y", 0))
    assert rows(override(df, "k", ["x"], {"a": 1})) == [("x", 1), ("y", 0)]
    assert rows(override(df, "k", [], {"a": 1})) == [("x", 0), ("y", 0)]
    listed = frame(spark, "code string", ("y",), ("y",))
    assert rows(override(df, "k", listed, {"a": 1})) == [("x", 0), ("y", 1)]


def test_stack_by_name(spark):
    a, b = frame(spark, "x int, y int", (1, 2)), frame(spark, "y int, x int", (4, 3))
    assert rows(stack({"a": a, "b": b})) == [(1, 2, "a"), (3, 4, "b")]


# picks


def test_picks_do_not_depend_on_partitioning(spark):
    data = [(i % 7, random.Random(i).choice([None, 1, 2, 3]), i) for i in range(500)]
    df = frame(spark, "k int, v int, id int", *data)
    for pick in (
        lambda d: latest_by(d, ["k"], "v", ["id"]),
        lambda d: lowest_by(d, ["k"], "v", ["id"]),
        lambda d: dedupe(d, ["k"], ["id"]),
        lambda d: sample_head(d, 10, ["v", "id"]),
        lambda d: sample_per_group(d, ["k"], 3, ["id"], seed=5),
    ):
        assert rows(pick(df.repartition(1))) == rows(pick(df.repartition(13, "id")))
    newest = {k: max(((v, -i) for kk, v, i in data if kk == k and v), default=None) for k in range(7)}
    assert rows(latest_by(df, ["k"], "v", ["id"])) == sorted(((k, v, -i) for k, (v, i) in newest.items()), key=str)


def test_sample_depends_on_seed(spark):
    df = spark.range(1000).withColumn("g", F.lit(1))
    first, second = (rows(sample_per_group(df, ["g"], 50, ["id"], seed=s)) for s in (1, 2))
    assert len(first) == len(second) == 50
    assert first != second


# attributes


def test_pivot_and_join(spark):
    long = frame(
        spark, "p string, u string, v string", ("1", "U1", "b"), ("1", "U1", "a"), ("1", "U9", "x"), ("2", "U2", "c")
    )
    defs = frame(spark, "u string, d string", ("U1", "Sex Dept"), ("U2", "Season"), ("U2", "Season"))
    pivoted = pivot_attributes(long, defs, "p", "u", "d", "v")
    assert pivoted.columns == ["p", "Season", "Sex Dept"]
    products = frame(spark, "p string, season string", ("1", "SS22"), ("3", None))
    joined = join_attributes(products, pivoted, "p")
    assert joined.columns == ["p", "season", "Sex Dept"]
    assert rows(joined) == [("1", "SS22", "a"), ("3", None, None)]


def test_hierarchy_codes_cover_the_path(spark):
    df = frame(spark, "a string, b string", ("PL", "X"), ("DE", "X"))
    out = hierarchy(df, [F.col("a"), F.col("b")], "l").collect()
    assert out[0]["l2_name"] == out[1]["l2_name"]
    assert out[0]["l2_code"] != out[1]["l2_code"]


def test_group_sizes(spark):
    df = frame(spark, "z string, s string", ("A", "1"), ("A", "1"), ("A", "2"), (None, "3"))
    assert rows(group_sizes(df, ["z"], "s")) == [("A", 2)]


CHILDREN = [
    ("p1", "a", "1", 1),
    ("p1", "a", None, 2),
    ("p1", "b", "2", 3),
    ("p1", None, "2", 4),
    ("p2", "x", "1", 5),
    ("p2", "y", "1", 6),
    ("p3", "z", "3", 7),
    (None, "q", "1", 8),
    (None, "r", "2", 9),
]


def test_conflicts(spark):
    df = frame(spark, "p string, n string, c string, id int", *CHILDREN)
    assert rows(find_conflicts(df, "p", ["n", "c"])) == [("p1", 2, 2), ("p2", 2, 1)]


def test_consensus_per_column(spark):
    df = frame(spark, "p string, n string, c string, id int", *CHILDREN)
    out = consensus(df, "p", ["n", "c"])
    assert sorted(tuple(r) for r in out.select("id", "n", "c").collect()) == [
        (1, "a", "2"),
        (2, "a", "2"),
        (3, "a", "2"),
        (4, "a", "2"),
        (5, "x", "1"),
        (6, "x", "1"),
        (7, "z", "3"),
        (8, "q", "1"),
        (9, "r", "2"),
    ]
    assert find_conflicts(out, "p", ["n", "c"]).isEmpty()
    assert rows(consensus(out, "p", ["n", "c"])) == rows(out)


def test_consensus_as_tuple_takes_one_row(spark):
    df = frame(spark, "p string, n string, c int, id int", ("p", "a", 1, 1), ("p", "a", 2, 2), ("p", "b", 2, 3))
    out = consensus(df, "p", ["n", "c"], as_tuple=True)
    assert {tuple(r) for r in out.select("n", "c").collect()} == {("a", 1)}
    assert out.dtypes == df.dtypes


def test_consensus_as_tuple_prefers_values(spark):
    gaps = [("p", None, None, i) for i in range(5)]
    df = frame(spark, "p string, n string, c int, id int", *gaps, ("p", "a", None, 5), ("p", "a", 1, 6), ("q", None, None, 7), ("q", None, None, 8))
    out = consensus(df, "p", ["n", "c"], as_tuple=True)
    assert rows(out) == rows(df)  # no parent disagrees
    both = df.unionByName(frame(spark, "p string, n string, c int, id int", ("r", "x", 1, 9), ("r", "y", 1, 10)))
    got = {r["p"]: (r["n"], r["c"]) for r in consensus(both, "p", ["n", "c"], as_tuple=True).collect()}
    assert got == {"p": ("a", 1), "q": (None, None), "r": ("x", 1)}


@pytest.mark.parametrize("as_tuple", [False, True])
def test_consensus_without_conflict_changes_nothing(spark, as_tuple):
    df = frame(spark, "p string, n string, id int", ("p", "a", 1), ("p", None, 2), ("q", "b", 3))
    assert rows(consensus(df, "p", ["n"], as_tuple)) == rows(df)


def test_deliveries_count_moved_and_missing_variants(spark):
    a = frame(spark, "v string, p string", ("v1", "p1"), ("v2", "p1"), ("v2", "p2"), (None, "p3"), ("v3", None))
    b = frame(spark, "v string, p string", ("v1", "p2"), (None, None), ("v4", "p4"))
    got = D.compare_deliveries(a, b, "v", "p").first().asDict()
    assert got == {
        "rows_a": 5, "rows_b": 3, "variants_a": 3, "variants_b": 2, "variants_common": 1,
        "parents_a": 3, "parents_b": 2, "parents_common": 1,
    }


def test_repeated_products_do_not_multiply_stock(spark):
    stock = frame(spark, "product_code string, unit string, amount decimal(15,3)", ("x", "SZT", Decimal(6)), ("y", "SZT", Decimal(1)))
    products = frame(spark, "product_code string, sales_unit string, `group` string", ("x", "6PAK", "g"), ("x", "PAR", "g"), ("x", "6PAK", "g"))
    rules = frame(spark, "`group` string, from_unit string, to_unit string, factor int", ("g", "SZT", "6PAK", 6))
    got = rows(units.convert_units(stock, products, rules).select("product_code", "sales_unit", "status"))
    assert got == [("x", "6PAK", "converted"), ("y", None, "unknown_product")]


def test_consensus_equals_counting(spark):
    rng = random.Random(3)
    data = [(f"p{rng.randrange(9)}", rng.choice(["a", "b", "c", None]), i) for i in range(300)]
    out = consensus(frame(spark, "p string, n string, id int", *data), "p", ["n"])
    votes = {}
    for p, n, _ in data:
        if n is not None:
            votes.setdefault(p, Counter())[n] += 1
    best = {p: min(c, key=lambda n: (-c[n], n)) for p, c in votes.items()}
    assert {(r["p"], r["n"]) for r in out.collect()} == set(best.items())


# time


def test_lowest_value(spark):
    df = frame(
        spark, "k string, v int, c string", ("a", 2, "x"), ("a", 1, None), ("a", 1, "z"), ("b", None, "y"), ("a", None, "a")
    )
    assert rows(lowest_value(df, ["k"], "v")) == [("a", 1), ("b", None)]
    assert rows(lowest_value(df, ["k"], "v", ["c"])) == [("a", 1, "z"), ("b", None, "y")]


def test_validity_covers_every_day_once(spark):
    rng = random.Random(1)
    starts = {("k%d" % rng.randrange(5), date(2024, 1, 1) + timedelta(rng.randrange(400))) for _ in range(100)}
    out = validity(frame(spark, "k string, s date", *starts), ["k"], "s").collect()
    for key in {k for k, _ in starts}:
        mine = sorted((r["s"], r["end_date"]) for r in out if r["k"] == key)
        for (_, end), (start, _) in zip(mine, mine[1:], strict=False):
            assert end == start - timedelta(1)
        assert mine[-1][1] is None


def test_asof_join_equals_brute_force(spark):
    rng = random.Random(7)
    day = date(2024, 1, 1)
    facts = [(i, rng.choice(["a", "b", "c", None]), day + timedelta(rng.randrange(40))) for i in range(200)]
    facts.append((200, "a", None))
    quotes = [
        (rng.choice(["a", "b", None]), day + timedelta(rng.randrange(5, 35)), rng.choice([None, 1, 2, 3]), i)
        for i in range(40)
    ]
    out = asof_join(
        frame(spark, "id int, k string, d date", *facts),
        frame(spark, "k string, qd date, p int, n int", *quotes),
        ["k"],
        "d",
        "qd",
        ["p", "n"],
    )
    none_last = lambda q: (q[2] is None, q[2] or 0, q[3])
    want = []
    for i, k, d in facts:
        valid = [q for q in quotes if d and k and q[0] == k and q[1] <= d]
        newest = max((q[1] for q in valid), default=None)
        best = min((q for q in valid if q[1] == newest), key=none_last, default=(None,) * 4)
        want.append((i, k, d, *best[1:]))
    assert rows(out) == sorted(want, key=str)


def test_fallback_order(spark):
    df = frame(spark, "a int, b int", (None, 2), (1, 2), (None, None))
    assert rows(df.select(price_fallback("a", "b"))) == [(1,), (2,), (None,)]


def test_accumulate_snapshots(spark):
    d = [date(2024, 1, i) for i in (1, 5, 9)]
    first = frame(spark, "k string, s date, v int", ("a", d[0], 3), ("a", d[1], 5))
    second = frame(spark, "k string, s date, v int", ("a", d[1], 4), ("a", d[2], 6))
    out = accumulate(first, second, ["k"], "s", "v")
    assert rows(out) == [("a", d[0], 3, d[1] - timedelta(1)), ("a", d[1], 4, d[2] - timedelta(1)), ("a", d[2], 6, None)]


# snapshots


PRICES = [("L", "1", 10, None), ("L", "2", 10, 5), ("M", "1", 10, 7)]


def test_delta(spark):
    schema = "n string, p string, v int, e int"
    full = frame(spark, schema, *PRICES)
    nothing = spark.createDataFrame([], schema)
    keys = ["n", "p"]
    assert D.delta(full, full, keys, ["e"]).isEmpty()
    assert D.delta(full, full.unionByName(full), keys, ["e"]).isEmpty()
    assert rows(D.delta(full, nothing, keys, ["e"])) == sorted(PRICES, key=str)
    changed = frame(spark, schema, ("L", "1", 10, 1), ("L", "2", 99, 5), ("M", "1", 10, 7), ("M", "1", 10, 8))
    assert rows(D.delta(full, changed, keys, ["e"])) == [PRICES[0], PRICES[2]]
    assert rows(D.delta(full, changed, keys, ["e", "v"])) == PRICES


def test_upsert(spark):
    base = frame(spark, "k string, v int", ("a", 1), ("b", 2))
    updates = frame(spark, "v int, k string", (9, "b"), (8, "c"))
    assert rows(D.upsert(base, updates, ["k"])) == [("a", 1), ("b", 9), ("c", 8)]


def test_densify(spark):
    stock = frame(spark, "s string, p string, amount decimal(15,3)", ("S", "1", Decimal(2)), ("S", "1", Decimal(3)))
    wanted = frame(spark, "s string, p string", ("S", "1"), ("S", "2"), ("S", "2"))
    out = D.densify(stock, wanted, ["s", "p"], ["amount"])
    assert rows(out) == [("S", "1", Decimal("5.000")), ("S", "2", Decimal("0.000"))]


def test_compare_deliveries(spark):
    a = frame(spark, "v string, p string", ("1/a", "1"), ("1/b", "1"), ("1/b", "1"), ("2/a", "2"))
    b = frame(spark, "v string, p string", ("1/b", "1"), ("3/a", "3"))
    got = D.compare_deliveries(a, b, "v", "p").first().asDict()
    assert got == {
        "rows_a": 4,
        "rows_b": 2,
        "variants_a": 3,
        "variants_b": 2,
        "variants_common": 1,
        "parents_a": 2,
        "parents_b": 2,
        "parents_common": 1,
    }


# quality


def test_quality_report(spark):
    df = frame(spark, "k string, c string", ("a", "PL"), (" ", None), (None, "PL"))
    check = quality.Check("no_country", "c", quality.WARN, F.col("c").isNull())
    report = quality.quality_report(df, [quality.blank_check("k"), check])
    assert [tuple(r) for r in report.collect()] == [
        ("rows", "*", "INFO", 3, Decimal("100.000")),
        ("blank", "k", "WARN", 2, Decimal("66.667")),
        ("no_country", "c", "WARN", 1, Decimal("33.333")),
    ]
    empty = quality.quality_report(df.limit(0), [quality.blank_check("k")]).collect()
    assert [tuple(r) for r in empty] == [("rows", "*", "CRITICAL", 0, None), ("blank", "k", "INFO", 0, None)]


def test_empty_feeds_fail(spark):
    df = frame(spark, "k string", ("a",))
    assert quality.check_not_empty(df) is df
    with pytest.raises(quality.EmptyFeed, match="stores"):
        quality.check_not_empty(df.limit(0), "stores")


def test_volume_audit_adds_up(spark):
    df = frame(spark, "k string, d date", ("a", date(2024, 1, 1)), (" ", None), ("b", None), (None, date(2024, 1, 1)))
    reasons = {"key": quality.is_blank("k"), "date": F.col("d").isNull()}
    got = dict(tuple(r) for r in quality.volume_audit(df, reasons).collect())
    assert got == {"total": 4, "key": 2, "date": 1, "kept": 1}


def test_counts_and_duplicates(spark):
    df = frame(spark, "k string", ("b",), ("a",), ("a",), ("c",), (None,))
    assert [tuple(r) for r in quality.value_counts(df, "k").collect()] == [("a", 2), ("b", 1), ("c", 1), (None, 1)]
    assert rows(quality.duplicate_keys(df, ["k"])) == [("a", 2)]
    assert tuple(quality.match_rate(df, "k").first()) == (5, 4, Decimal("80.000"))


# units and diagnostics


def test_unit_conversion(spark):
    conversions = frame(
        spark,
        "`group` string, from_unit string, to_unit string, factor int",
        ("G", "SZT", "PAR", 1),
        ("G", "SZT", "6PAK", 6),
        ("H", "SZT", "PAR", 1),
        ("H", "SZT", "PAR", 2),
    )
    products = frame(
        spark, "product_code string, sales_unit string, `group` string", ("a", "6PAK", "G"), ("b", "SZT", "G"), ("c", "PAR", "H"), ("d", "MB", "G")
    )
    stock = frame(
        spark,
        "product_code string, unit string, amount decimal(15,3)",
        ("a", "SZT", Decimal(12)),
        ("b", "6PAK", Decimal(2)),
        ("b", "SZT", Decimal(5)),
        ("c", "SZT", Decimal(1)),
        ("d", "SZT", Decimal(1)),
        ("x", "SZT", Decimal(1)),
    )
    out = units.convert_units(stock, products, conversions)
    got = {(r["product_code"], r["unit"]): (r["converted"], r["status"]) for r in out.collect()}
    assert got == {
        ("a", "SZT"): (Decimal(2), "converted"),
        ("b", "6PAK"): (Decimal(12), "converted"),
        ("b", "SZT"): (Decimal(5), "same"),
        ("c", "SZT"): (None, "ambiguous"),
        ("d", "SZT"): (None, "missing"),
        ("x", "SZT"): (None, "unknown_product"),
    }
    missing = units.missing_conversions(stock.withColumn("context", F.lit("store")), products, conversions, ["context"])
    assert rows(missing) == [("store", "SZT", "MB", 1, 1)]
    assert rows(units.ambiguous_conversions(conversions)) == [("G", "SZT", 2)]


def test_error_trend(spark):
    d = [date(2026, 3, 12), date(2026, 3, 18), date(2026, 3, 19)]
    log = frame(
        spark, "c string, k string, d date", ("E", "a", d[0]), ("E", "a", d[0]), ("E", "b", d[1]), ("E", "a", d[2]), ("F", "a", d[0])
    )
    assert rows(diagnostics.error_trend(log, "c", "k", "d")) == [
        ("E", d[0], 2, 1, 1, 0, 1),
        ("E", d[1], 1, 1, 1, 1, 2),
        ("E", d[2], 1, 1, 0, 1, 2),
        ("F", d[0], 1, 1, 1, 1, 1),
    ]
    assert rows(diagnostics.unresolved_keys(log, "c", "k", "d")) == [("E", "a", d[0], d[2]), ("F", "a", d[0], d[0])]


def test_inactive_parents_and_variants(spark):
    variants = frame(
        spark, "v string, p string, active int", ("1/a", "1", 0), ("1/b", "1", None), ("2/a", "2", 1), ("2/b", "2", 0), ("2/c", "2", 0)
    )
    assert rows(diagnostics.inactive_parents(variants, "p", "active")) == [("1", 2)]
    parents = frame(spark, "p string, active int", ("1", 0), ("2", 1))
    found = diagnostics.inactive_variants(variants, parents, "p", "v", "active")
    assert rows(found.select("v")) == [("2/b",), ("2/c",)]
    moving = frame(spark, "v string", ("2/c",), ("2/c",))
    assert rows(diagnostics.inactive_variants(variants, parents, "p", "v", "active", moving).select("v")) == [("2/c",)]
    assert rows(diagnostics.profile_counts(variants, ["active"])) == [(0, 3), (1, 1), (None, 1)]
