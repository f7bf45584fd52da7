import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, values
from tidemark.operators import scd
from tidemark.plans import fixed_values as fixed
from tidemark.plans import retail


def customers(spark):
    rows = [("BERGS", "Berglunds", "Christina", "Lulea", "Sweden", "N/A", "1"),
            ("ALFKI", "Alfreds", "Maria", "Berlin", "Germany", "N/A", "2"),
            ("PARIS", "Paris", "Marie", "Paris", "France", "N/A", "3")]
    return spark.createDataFrame(
        rows, "customer_id STRING, company_name STRING, contact_name STRING, city STRING, country STRING, "
              "region STRING, phone STRING")


def dim1(spark):
    spend = spark.createDataFrame([("BERGS", 24000.0), ("ALFKI", 5000.0)], "customer_id STRING, lifetime_spend DOUBLE")
    return retail.scd1(customers(spark), spend)


def test_types_1_2_3_from_spend(spark):
    one = dim1(spark)
    assert values(one, "customer_id", "loyalty_tier", "credit_limit_usd", "last_updated_at") == [
        ("ALFKI", "Gold", 20000, "1998-01-01"), ("BERGS", "Platinum", 50000, "1998-04-01"),
        ("PARIS", "Bronze", 5000, "1996-01-01")]
    two = retail.scd2(one)
    assert two.count() == 6
    assert values(two, "customer_sk", "customer_id")[2] == ("CUST_SK_0003", "BERGS")
    assert two.filter("is_current_flag").count() == 3
    assert two.filter("NOT is_current_flag AND effective_start_date >= effective_end_date").isEmpty()
    for day, tier, limit, current in (("1996-08-15", "Silver", 10000, False), ("1997-10-01", "Gold", 25000, False),
                                      ("1998-05-01", "Platinum", 50000, True)):
        r = scd.point_in_time(two, "customer_id", "BERGS", day).first()
        assert (r.loyalty_tier, r.credit_limit_usd, r.is_current_flag) == (tier, limit, current)
    assert scd.point_in_time(two, "customer_id", "NOBODY", "1998-05-01").isEmpty()
    three = retail.scd3(one).filter("customer_id = 'BERGS'").first()
    assert (three.current_loyalty_tier, three.previous_loyalty_tier) == ("Platinum", "Gold")
    assert (three.current_credit_limit_usd, three.previous_credit_limit_usd) == (50000, 25000)
    assert three.tier_change_date == dt.date(1998, 4, 1)
    zero = retail.scd0(customers(spark)).first()
    assert (zero.original_signup_date, zero.initial_credit_limit_usd) == (dt.date(1996, 1, 1), 5000)
    assert fixed.LOYALTY_TIERS[0].previous.tier == "Gold"


def test_type_0_and_1_increments(spark):
    old = spark.createDataFrame([(1, "se", 1)], "k INT, c STRING, t INT")
    new = spark.createDataFrame([(1, "no", 5), (2, "dk", 3), (2, "fi", 2), (1, "us", 4)], "k INT, c STRING, t INT")
    assert values(scd.retain_original(old, new, ["k"], ["t"])) == [(1, "se", 1), (2, "fi", 2)]
    assert values(scd.overwrite_current(old, new, ["k"], ["t"])) == [(1, "no", 5), (2, "dk", 3)]


def test_type_3_shift(spark):
    dim = spark.createDataFrame([(1, "a", None, None), (2, "b", "z", None), (3, None, None, None)],
                                "k INT, cur STRING, prev STRING, at STRING")
    new = spark.createDataFrame([(1, "b", "d1"), (2, "b", "d2"), (3, "x", "d3")], "k INT, cur STRING, at2 STRING")
    got = scd.shift_previous(dim, new, ["k"], {"cur": "prev"}, "at", "at2")
    assert values(got) == [(1, "b", "a", "d1"), (2, "b", "z", None), (3, "x", None, "d3")]
    every = scd.shift_previous(dim, new, ["k"], {"cur": "prev"}, "at", "at2", only_changed=False)
    assert values(every)[1] == (2, "b", "b", "d2")


def model(events):
    """Versions by replaying the days of one key in order."""
    days = {}
    for day, seq, state in sorted(events):
        days[day] = state
    out = []
    for day in sorted(days):
        if not out or out[-1][1] != days[day]:
            out.append([day, days[day]])
    ends = [nxt[0] - dt.timedelta(days=1) for nxt in out[1:]] + [dt.date(9999, 12, 31)]
    return [(s, st, e) for (s, st), e in zip(out, ends)]


def test_type_2_increments_equal_replay(spark):
    rng = random.Random(11)
    day0 = dt.date(2024, 1, 1)
    events = [(rng.choice("abcd"), day0 + dt.timedelta(days=rng.randint(0, 40)), i, rng.choice(["x", "y", None]))
              for i in range(160)]
    schema = "k STRING, at DATE, seq INT, state STRING"
    # batches in arrival order, so that many changes arrive late
    dim = scd.history_of(spark.createDataFrame(events[:60], schema), ["k"], ["state"], "at", ["seq"], "sk")
    keys = {(r.k, r.effective_start_date): r.sk for r in dim.collect()}
    for lo in (60, 110):
        batch = spark.createDataFrame(events[lo:lo + 50], schema)
        dim = scd.apply_changes(dim, batch, ["k"], ["state"], "at", ["seq"], "sk")
        now = {(r.k, r.effective_start_date): r.sk for r in dim.collect()}
        assert len(set(now.values())) == len(now)
        assert all(now[key] == sk for key, sk in keys.items() if key in now)
        keys = now
    got = [tuple(r) for r in dim.select("k", "effective_start_date", "state", "effective_end_date").collect()]
    for k in "abcd":
        mine = sorted((s, st, e) for key, s, st, e in got if key == k)
        assert [e for _, _, e in mine][-1] == dt.date(9999, 12, 31)
        for (s1, st1, e1), (s2, st2, _) in zip(mine, mine[1:]):
            assert e1 == s2 - dt.timedelta(days=1) and st1 != st2


def test_type_2_in_order_increments_equal_one_replay(spark):
    rng = random.Random(5)
    day0 = dt.date(2024, 1, 1)
    events = sorted(
        ((rng.choice("abc"), day0 + dt.timedelta(days=rng.randint(0, 60)), rng.choice("xyz")) for _ in range(120)),
        key=lambda e: e[1])
    events = [(k, at, i, st) for i, (k, at, st) in enumerate(events)]
    schema = "k STRING, at DATE, seq INT, state STRING"
    dim = scd.history_of(spark.createDataFrame(events[:40], schema), ["k"], ["state"], "at", ["seq"])
    for lo in (40, 80):
        dim = scd.apply_changes(dim, spark.createDataFrame(events[lo:lo + 40], schema), ["k"], ["state"], "at", ["seq"])
    for k in "abc":
        got = sorted((r.effective_start_date, r.state, r.effective_end_date) for r in dim.filter(F.col("k") == k).collect())
        assert got == model([(at, i, st) for key, at, i, st in events if key == k])


def test_type_2_keeps_columns_that_are_not_tracked(spark):
    day = dt.date
    dim = spark.createDataFrame(
        [("S1", 1, "a", "Oslo", "n1", day(2024, 1, 1), day(2024, 1, 31), False),
         ("S2", 1, "b", "Rome", None, day(2024, 2, 1), day(9999, 12, 31), True),
         ("S3", 2, "a", "Bern", "n3", day(2024, 1, 1), day(9999, 12, 31), True)],
        "sk STRING, k INT, state STRING, city STRING, note STRING, effective_start_date DATE, effective_end_date DATE, "
        "is_current_flag BOOLEAN")
    changes = spark.createDataFrame(
        [(1, "c", "Paris", day(2024, 3, 1), 1), (1, "d", None, day(2024, 4, 1), 2)],
        "k INT, state STRING, city STRING, at DATE, seq INT")
    got = scd.apply_changes(dim, changes, ["k"], ["state"], "at", ["seq"], "sk")
    assert sorted(got.columns) == sorted(dim.columns)
    assert values(got, "k", "state", "city", "note", "effective_end_date") == [
        (1, "a", "Oslo", "n1", day(2024, 1, 31)), (1, "b", "Rome", None, day(2024, 2, 29)),
        (1, "c", "Paris", None, day(2024, 3, 31)), (1, "d", "Paris", None, day(9999, 12, 31)),
        (2, "a", "Bern", "n3", day(9999, 12, 31))]
    with pytest.raises(ValueError, match="order"):
        scd.apply_changes(dim, changes, ["k"], ["state"], "at", [])


def test_temporal_join_has_an_equi_key(spark):
    dim = spark.createDataFrame(
        [(1, "old", dt.date(2020, 1, 1), dt.date(2020, 6, 30)), (1, "new", dt.date(2020, 7, 1), dt.date(9999, 12, 31))],
        "k INT, tier STRING, effective_start_date DATE, effective_end_date DATE")
    facts = spark.createDataFrame([(10, 1, dt.date(2020, 6, 30)), (11, 1, dt.date(2020, 7, 1)), (12, 2, dt.date(2020, 7, 1))],
                                  "id INT, k INT, at DATE")
    assert values(scd.temporal_join(facts, dim, "k", "at", ["tier"]), "id", "tier") == [(10, "old"), (11, "new")]
    left = scd.temporal_join(facts, dim, "k", "at", ["tier"], how="left")
    assert left.count() == 3
    assert "NestedLoop" not in plan(left)
