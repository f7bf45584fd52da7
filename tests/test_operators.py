import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, values
from tidemark.operators import analytics, audit, catalog, compare, contracts, filters, joins, mapping, ordered, rows, star
from tidemark.session import durable


def test_dense_sequence_equals_row_number(spark):
    data = [(random.Random(i).randint(0, 5), i) for i in range(5000)]
    # many partitions, so that offsets between slices matter
    df = spark.createDataFrame(data, "a INT, b INT").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordered.dense_sequence(df, ["a", F.col("b").desc()])
        assert got.select(F.max("seq")).first()[0] == 5000
        want = {(a, b): i + 1 for i, (a, b) in enumerate(sorted(data, key=lambda r: (r[0], -r[1])))}
        assert {(r.a, r.b): r.seq for r in got.collect()} == want
        assert "SinglePartition" not in plan(got)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("n", [0, 1, 3, 4, 10, 11, 401])
def test_tile_of_equals_ntile(spark, n):
    df = spark.range(1, n + 1).select("id", ordered.tile_of(F.col("id"), n, 4).alias("t"))
    q, r = divmod(n, 4)
    want = [tile for tile in range(1, 5) for _ in range(q + (tile <= r))]
    assert [x.t for x in df.orderBy("id").collect()] == want


def test_grouped_median_with_a_hot_group_and_value(spark):
    rng = random.Random(3)
    data = [("hot", 7.0)] * 3000 + [("hot", float(rng.randint(0, 50))) for _ in range(500)]
    data += [("odd", 1.0), ("odd", 9.0), ("odd", 3.0), ("even", 1.0), ("even", 4.0), ("none", None)]
    df = spark.createDataFrame(data, "g STRING, v DOUBLE").repartition(5)
    got = dict(values(ordered.grouped_median(df, ["g"], "v", "m")))
    want = {}
    for g in ("hot", "odd", "even"):
        want[g] = statistics.median(v for k, v in data if k == g)
    assert got == want


def test_first_and_last(spark):
    df = spark.createDataFrame(
        [("a", 2, None, "x"), ("a", 1, None, "y"), ("a", 3, "p", None), (None, 1, "q", "z")],
        "k STRING, o INT, u STRING, v STRING",
    )
    assert values(rows.first_per_key(df, ["k"], ["o"])) == [("a", 1, None, "y"), (None, 1, "q", "z")]
    assert values(rows.last_per_key(df, ["k"], ["o"]), "k", "o") == [("a", 3), (None, 1)]
    assert values(rows.first_non_null(df, ["k"], ["u", "v"], ["o"])) == [("a", "p", "y"), (None, "q", "z")]
    assert values(rows.last_non_null(df, ["k"], ["u", "v"], ["o"])) == [("a", "p", "x"), (None, "q", "z")]


def test_top_per_group_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    got = rows.top_per_group(df, ["g"], [F.desc("id")], 2)
    assert values(got) == sorted([(g, i, r) for g in range(3) for r, i in enumerate(
        sorted((x for x in range(100) if x % 3 == g), reverse=True)[:2], 1)], key=repr)
    assert "Partial" in plan(got)


def test_bounded(spark):
    df = spark.range(500)
    assert [rows.bounded(df, n).count() for n in (None, 10, 400)] == [50, 10, 100]


def test_mapping(spark):
    df = spark.createDataFrame([("AWS",), ("x",), (None,), (" AWS",)], "c STRING")
    want = [("Amazon",), ("x",), (None,), (" AWS",)]
    assert [tuple(r) for r in mapping.map_values(df, "c", {"AWS": "Amazon"}).collect()] == want
    table = spark.createDataFrame([("AWS", "Amazon")], "raw STRING, name STRING")
    assert values(mapping.map_values(df, "c", table)) == sorted(want, key=repr)
    many = {f"k{i}": "v" for i in range(mapping.LITERAL_LIMIT)} | {"AWS": "Amazon"}
    assert values(mapping.map_values(df, "c", many)) == sorted(want, key=repr)
    flagged = mapping.flag_members(df, "c", ["AWS"], "f")
    assert [r.f for r in flagged.collect()] == [True, False, False, False]
    assert values(mapping.flag_members(df, "c", table, "f")) == values(flagged)


def test_compare(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i INT, s STRING")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "i INT, s STRING")
    assert values(compare.table_diff(a, b)) == [(1, "x", -1), (3, "z", 1)]
    assert compare.tables_equal(a, a.orderBy(F.desc("i"))) and not compare.tables_equal(a, b)
    united = compare.union_all([a, b.drop("s").withColumn("t", F.lit(1))])
    assert united.columns == ["i", "s", "t"] and united.count() == 6


def test_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), (None, 9)], "c STRING, n INT")
    assert filters.filter_given(df, {"c": None}, {"n": 5}, {"n": None}).count() == 2
    kept = filters.cohort(df, [("c", "a"), ("c", "b")], ("n", 1, 5), ("n", 1))
    assert values(kept) == [("b", 5)]


def test_surrogate_keys_leave_out_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "n STRING")
    assert values(star.surrogate_keys(df, "n", "id")) == [("a", "COMP001"), ("b", "COMP002")]


def test_latest_view_keeps_members_and_ranks_null_period_lowest(spark):
    obs = spark.createDataFrame(
        [("c1", 2021, 1, 10), ("c1", None, None, 99), ("c2", 2020, 4, 7)], "k STRING, y INT, q INT, v INT"
    )
    dim = spark.createDataFrame([("c1", "A"), ("c2", "B"), ("c3", "C")], "k STRING, name STRING")
    got = star.latest_view(obs, dim, "k", ["y", "q"], {"v": "latest"}, ["name"], "n", 0)
    assert values(got) == [("c1", "A", 10, 2), ("c2", "B", 7, 1), ("c3", "C", None, 0)]


def test_rfm_segments(spark):
    df = spark.createDataFrame(
        [(4, 4, 4), (3, 2, 2), (3, 1, 1), (1, 3, 3), (1, 2, 1), (2, 2, 2)], "r_score INT, f_score INT, m_score INT"
    )
    got = [r.customer_segment for r in analytics.rfm_segments(df).collect()]
    assert got == ["Champions", "Loyal Customers", "Recent Customers", "At Risk - High Spenders",
                   "Lost Customers", "Promising / Needs Attention"]


def one_rule(spark, rule, tables):
    return contracts.evaluate(tables, [rule]).first()


def test_contract_rules(spark):
    people = spark.createDataFrame([("x", 100.0), (None, -50.0), ("y", 300.0)], "n STRING, v DOUBLE")
    r = one_rule(spark, contracts.not_null("t", "n"), {"t": people})
    assert (r.status, r.violations, r.pass_rate_pct, r.details) == ("FAIL", 1, 66.67, "1 nulls found out of 3 rows")
    r = one_rule(spark, contracts.in_range("t", "v", 0.0), {"t": people})
    assert (r.status, r.violations) == ("FAIL", 1)
    child = spark.createDataFrame([("C1",), ("C999",)], "k STRING")
    parent = spark.createDataFrame([("C1",), ("C2",)], "k STRING")
    r = one_rule(spark, contracts.references("c", "k", "p", "k"), {"c": child, "p": parent})
    assert (r.status, r.violations, r.pass_rate_pct) == ("FAIL", 1, 50.0)
    r = one_rule(spark, contracts.unique("t", "n"), {"t": people.union(people)})
    assert (r.violations, r.details) == (3, "3 duplicate keys found")
    r = one_rule(spark, contracts.one_of("t", "n", ["x", "y"], allow_null=False), {"t": people})
    assert r.violations == 1
    r = one_rule(spark, contracts.one_of("t", "n", ["x", "y"]), {"t": people})
    assert (r.status, r.pass_rate_pct, r.details) == ("PASS", 100.0, "All 2 values match allowed categories")
    r = one_rule(spark, contracts.in_range("t", "zz", 0), {"t": people})
    assert (r.status, r.violations, r.pass_rate_pct) == ("FAIL", 3, 0.0)


def test_contract_nan_is_missing_and_nothing_to_check_passes(spark):
    df = spark.createDataFrame([(float("nan"),), (None,)], "v DOUBLE")
    r = one_rule(spark, contracts.in_range("t", "v", 0.0), {"t": df})
    assert (r.status, r.pass_rate_pct, r.details) == ("PASS", 100.0, "0 non-null values to check")
    assert one_rule(spark, contracts.in_range("t", "v", 0.0, allow_null=False), {"t": df}).violations == 2
    assert one_rule(spark, contracts.not_null("t", "v"), {"t": df}).violations == 2


def test_scorecard_and_enforcement(spark):
    df = spark.createDataFrame([(1,), (None,)], "v INT")
    rules = [contracts.not_null("t", "v"), contracts.unique("t", "v"), contracts.not_null("empty", "v")]
    results = contracts.evaluate({"t": df, "empty": df.limit(0)}, rules)
    assert results.count() == 2
    assert tuple(contracts.scorecard(results).first()) == ("FAILED", 50.0, 2, 1, 1)
    with pytest.raises(contracts.ContractViolation, match="t.v"):
        contracts.enforce(results)
    contracts.enforce(results.filter("status = 'PASS'"))


def test_profiles(spark):
    df = spark.createDataFrame([(1, "b", [1]), (2, None, [1]), (2, "a", None)], "i INT, s STRING, a ARRAY<INT>")
    want = [("a", 1, 1, ["[1]"]), ("i", 0, 2, ["1", "2"]), ("s", 1, 2, ["a", "b"])]
    got = catalog.profile_columns(df, "t")
    assert values(got, "column_name", "null_count", "distinct_count", "sample_values") == sorted(want, key=repr)
    assert {(r.row_count, r.column_count) for r in got.collect()} == {(3, 3)}
    quick = catalog.profile_quick(df, "t")
    assert quick.columns == got.columns
    assert values(quick, "column_name", "null_count", "distinct_count") == [w[:3] for w in sorted(want, key=repr)]
    assert catalog.profile_columns(df.limit(0), "t").count() == 0


def test_profile_of_many_parts_keeps_whole_texts(spark):
    rng = random.Random(5)
    data = [(rng.choice(["x" * 5000 + c for c in "dacb"] + [None, ""]), rng.randint(0, 400)) for _ in range(4000)]
    df = spark.createDataFrame(data, "s STRING, n INT").repartition(9)
    got = {r.column_name: r for r in catalog.profile_columns(df, "t").collect()}
    for i, name in enumerate("sn"):
        known = {str(row[i]) for row in data if row[i] is not None}
        assert got[name].distinct_count == len(known)
        assert got[name].null_count == sum(row[i] is None for row in data)
        assert got[name].sample_values == sorted(known)[:3]
    counted = plan(catalog.profile_columns(df, "t"))
    exchanges = [line for line in counted.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("s#" in line.split("hashpartitioning", 1)[1].split(",")[0] for line in exchanges)


@pytest.mark.parametrize("few", [200, 4096])
def test_tile_ends_by_selection(spark, few):
    rng = random.Random(few)
    data = [(rng.choice([0, 0, 0, 7, None, rng.randint(-9, 999)]), rng.random(), f"k{i}") for i in range(2500)]
    df = durable(spark.createDataFrame(data, "a INT, b DOUBLE, k STRING").repartition(6))
    orders = {"x": ["a", "k"], "y": ["b", "k"]}
    ends = ordered.tile_ends(df, orders, 4, few)
    smallest = float("-inf")
    for name, place in (("x", 0), ("y", 1)):
        want = sorted(data, key=lambda r: (smallest if r[place] is None else r[place], r[2]))
        assert [e.k for e in ends[name]] == [want[i][2] for i in (624, 1249, 1874)]
        tiled = df.select("k", ordered.tile_in(df, orders[name], ends[name]).alias("t"))
        assert dict(values(tiled)) == {r[2]: 1 + i // 625 for i, r in enumerate(want)}


def test_tile_ends_of_equal_and_of_few_rows(spark):
    same = spark.createDataFrame([(1, "a")] * 900 + [(2, "b")] * 3, "v INT, k STRING")
    assert ordered.tile_ends(same, {"o": ["v", "k"]}, 3, few=10) == {"o": [(1, "a"), (1, "a")]}
    assert ordered.tile_ends(same.limit(0), {"o": ["v", "k"]}, 4) == {"o": []}
    one = spark.createDataFrame([(5, "z")], "v INT, k STRING")
    ends = ordered.tile_ends(one, {"o": ["v", "k"]}, 4)["o"]
    assert values(one.select(ordered.tile_in(one, ["v", "k"], ends))) == [(1,)]


def test_rfm_scores_equal_ntile_and_sort_nothing(spark):
    rng = random.Random(2)
    data = [(f"c{i}", rng.randint(0, 30), rng.randint(1, 4), rng.random()) for i in range(997)]
    names = "customer STRING, recency_days LONG, frequency_orders_count LONG, monetary_total_spend DOUBLE"
    metrics = durable(spark.createDataFrame(data, names).repartition(5))
    metrics.createOrReplaceTempView("metrics")
    want = spark.sql(
        """SELECT customer, 5 - ntile(4) OVER (ORDER BY recency_days, customer),
                  ntile(4) OVER (ORDER BY frequency_orders_count, customer),
                  ntile(4) OVER (ORDER BY monetary_total_spend, customer) FROM metrics"""
    )
    got = analytics.rfm_scores(metrics, "customer")
    assert values(got, "customer", "r_score", "f_score", "m_score") == values(want)
    assert "Exchange" not in plan(got) and "Sort" not in plan(got)


def test_skewed_join_spreads_hot_keys_only(spark):
    rng = random.Random(4)
    data = [(1, i) for i in range(4000)] + [(None, i) for i in range(3000)]
    data += [(rng.randint(2, 3000), i) for i in range(6000)]
    big = spark.createDataFrame(data, "k INT, i INT").repartition(4)
    # another type of key than the big side has
    small = spark.range(0, 2500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = [(k, i, None if k is None or k >= 2500 else 2 * k) for k, i in data]
    assert values(joins.skewed_join(big, small, ["k"]), "k", "i", "v") == sorted(want, key=repr)
    inner = joins.skewed_join(big, small, ["k"], "inner")
    assert values(inner, "k", "i", "v") == sorted((w for w in want if w[2] is not None), key=repr)
    assert joins.hot_keys(big, F.col("k").cast("long")) == [1]
    even = big.filter("k > 1")
    assert joins.hot_keys(even, F.col("k").cast("long")) == []
    assert "sequence" not in plan(joins.skewed_join(even, small, ["k"]))
    assert joins.skewed_join(big.limit(0), small, ["k"]).count() == 0
    assert joins.skewed_join(big, small.limit(0), ["k"]).filter("v IS NULL").count() == len(data)


def test_reachable_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "c")], "source STRING, target STRING")
    assert values(catalog.reachable(edges, ["a"])) == [("b", 1), ("c", 2)]
    assert values(catalog.reachable(edges, ["b"], upstream=True)) == [("a", 1), ("c", 2), ("x", 3)]


@pytest.mark.parametrize("statement, safe, reason, limit", [
    ("SELECT * FROM dim_company WHERE industry = 'AI/ML'", True, None, 50),
    ("```sql\nSELECT a FROM v ORDER BY a DESC\n```", True, None, 50),
    ("WITH r AS (SELECT 1) SELECT * FROM r limit 500", True, None, 100),
    ("SELECT 'x; drop' FROM t LIMIT 7;", True, None, 7),
    ("DROP TABLE dim_company;", False, "statement type", None),
    ("SELECT * FROM a; DROP TABLE b;", False, "several statements", None),
    ("DELETE FROM a", False, "statement type", None),
    ("UPDATE a SET b = 0;", False, "statement type", None),
    ("SELECT replace(a, 'b', '') FROM t", False, "forbidden keyword", None),
    (" ;; ", False, "empty", None),
    (None, False, "empty", None),
    ("42", False, "unknown statement", None),
])
def test_audit(spark, statement, safe, reason, limit):
    df = spark.createDataFrame([(statement,)], "s STRING")
    r = audit.audit_statements(df, "s").first()
    assert (r.is_safe, r.reason, r.row_limit) == (safe, reason, limit)


def test_durable_reads_the_same_rows(spark):
    df = spark.range(10).withColumn("r", F.rand())
    kept = durable(df)
    assert values(kept) == values(kept)


@pytest.mark.parametrize(
    "statement, safe, detail",
    [
        ("SELECT 1 -- DROP TABLE x; really", True, None),
        ("/* update; */ SELECT 'a;b', \"delete\" FROM t /* drop */ LIMIT 7", True, None),
        ("SELECT \"it's\" FROM t; DROP TABLE t", False, None),
        ("SELECT a FROM t WHERE x = 'it' OR drop", False, "DROP"),
        ("SELECT dropped, update_at FROM t", True, None),
    ],
)
def test_audit_scans_strings_and_comments(spark, statement, safe, detail):
    r = audit.audit_statements(spark.createDataFrame([(statement,)], "s STRING"), "s").first()
    assert (r.is_safe, r.detail) == (safe, detail)
    assert not safe or r.row_limit == (7 if "LIMIT" in statement else 50)
