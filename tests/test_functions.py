import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, events, money, numbers, text, vectors


def evaluate(spark, fn, inputs):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i INT, v STRING").select("i", fn(F.col("v")).alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


def check(spark, fn, pairs):
    assert evaluate(spark, fn, [p[0] for p in pairs]) == [p[1] for p in pairs]


def test_currency(spark):
    check(spark, money.currency_of, [
        ("£244,094,488", "GBP"), ("€1,254,545,455", "EUR"), ("¥360,000,000,000", "JPY"),
        ("$980.0M", "USD"), ("500M USD", "USD"), ("12 eur", "EUR"), ("5.2B", "USD"),
        ("Not disclosed", None), ("N/A", None), (None, None), (" - ", None),
    ])


def test_amount(spark):
    check(spark, money.amount_of, [
        ("$5,200,000,000", 5.2e9), ("5.2B", 5.2e9), ("5.2 billion", 5.2e9), ("500M USD", 5e8),
        ("$170.0M", 1.7e8), ("$3k", 3000.0), ("Not disclosed", None), (",", None), (None, None),
        ("$10M - $20M", 1.5e7), ("$100M to $200M", 1.5e8), ("$1M TO n/a", 1e6), ("n/a - unknown", None),
    ])


def test_rates(spark):
    df = spark.createDataFrame([("EUR",), ("GBP",), ("JPY",), ("CHF",), (None,)], "c STRING")
    rates = {"USD": 1.0, "GBP": 1.27, "EUR": 1.1, "JPY": 1 / 150}
    got = [r[0] for r in df.select(money.convert(F.lit(300.0), F.col("c"), rates)).collect()]
    assert got == [300.0 * 1.1, 300.0 * 1.27, 300.0 * (1 / 150), 300.0, 300.0]


def test_size_bucket(spark):
    check(spark, lambda c: numbers.size_bucket(c.cast("long")), [
        ("5000", "Small"), ("9999", "Small"), ("10000", "Medium"), ("30000", "Medium"),
        ("30001", "Large"), (None, "Unknown"),
    ])


def test_clean_text(spark):
    check(spark, text.clean_text, [
        (" a\t\n", "a"), ("nan", None), (" None ", None), ("", None), (None, None), ("é b", "é b"),
    ])


def test_numbers(spark):
    check(spark, numbers.to_double, [
        ("12d", None), ("NaN", None), ("inf", None), (" 7 ", 7.0), ("-1.5e2", -150.0), (".5", 0.5), ("1_0", None),
    ])
    check(spark, lambda c: numbers.round_even(c.cast("double"), 0), [("0.5", 0.0), ("1.5", 2.0), ("2.5", 2.0)])
    check(spark, lambda c: numbers.round_away(c.cast("double"), 0), [("0.5", 1.0), ("2.5", 3.0)])


def test_word_count_and_label(spark):
    check(spark, text.word_count, [("a  b\nc", 3), ("", 0), ("  ", 0), (None, 0)])
    check(spark, lambda c: text.label("K_", c.cast("int"), 4), [("7", "K_0007"), ("12345", "K_12345")])


def test_dates(spark):
    d = dt.date
    check(spark, dates.parse_date, [
        ("2023-02-03", d(2023, 2, 3)), ("02/03/2023", d(2023, 2, 3)), ("25/12/2023", d(2023, 12, 25)),
        ("21-Feb-20", d(2020, 2, 21)), ("October 19, 2022", d(2022, 10, 19)), ("May 5, 2021", d(2021, 5, 5)),
        ("2023-01-05T23:30:00-02:00", d(2023, 1, 6)), ("5 Mar 2020", d(2020, 3, 5)),
        ("13/13/2023", None), ("soon", None), (None, None), ("2023", None),
    ])
    got = evaluate(spark, lambda c: dates.expand_two_digit_year(dates.parse_date(c), 68), ["21-Feb-99", "21-Feb-20"])
    assert got == [d(1999, 2, 21), d(2020, 2, 21)]


def test_iso_timestamp(spark):
    got = evaluate(spark, lambda c: F.date_format(dates.iso_timestamp(c), "yyyy-MM-dd HH:mm:ss"), [
        "2026-10-25T06:28:06.279149+00:00", "2026-10-25T10:00:00", "2026-10-25", "2026", "x", "2026-13-01",
        "2026-10-25T10:00:00Z",
    ])
    assert got == ["2026-10-25 06:28:06", "2026-10-25 10:00:00", "2026-10-25 00:00:00", None, None, None,
                   "2026-10-25 10:00:00"]


def test_date_fallback(spark):
    df = spark.createDataFrame([("2023-12-13",), ("soon",), ("",)], "v STRING")
    parts = dates.date_parts_or(dates.parse_date(F.col("v")), F.col("v"), "p", dt.date(2026, 9, 1))
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in parts.items()]).collect()]
    assert got == [("2023-12-13", 2023, 4, 12, "2023-12"), ("soon", 2026, 3, 9, "2026-09"), ("", 2026, 3, 9, "2026-09")]


@pytest.mark.parametrize("change, reason", [
    ({}, None),
    ({"article_id": " "}, "Missing or empty required field: `article_id`"),
    ({"event_id": None, "op_code": "X"}, "Missing or empty required field: `event_id`"),
    ({"op_code": "x"}, "Invalid op_code `X` (Allowed: 'I', 'U', 'D')"),
    ({"op_code": "d"}, None),
    ({"arr_usd_M": "INVALID"}, "Non-numeric `arr_usd_M` value: INVALID"),
    ({"arr_usd_M": "nan"}, "Non-numeric `arr_usd_M` value: nan"),
    ({"arr_usd_M": ""}, None),
    ({"event_timestamp": "yesterday"}, "Malformed event_timestamp format: yesterday"),
])
def test_event_rules(spark, change, reason):
    event = {"event_id": "E1", "event_timestamp": "2026-10-25T10:00:00", "op_code": "I",
             "article_id": "A1", "company_name": "C", "arr_usd_M": "1.5"} | change
    schema = ", ".join(f"{k} STRING" for k in event)
    df = spark.createDataFrame([tuple(event.values())], schema)
    assert df.select(events.failure_reason(df.columns)).first()[0] == reason


def test_event_rules_missing_column(spark):
    df = spark.createDataFrame([("E1",)], "event_id STRING")
    assert "event_timestamp" in df.select(events.failure_reason(df.columns)).first()[0]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v ARRAY<DOUBLE>")
    got = df.select(vectors.cosine_to(F.col("v"), [1.0, 0.0]), vectors.cosine(F.col("v"), F.col("v")),
                    vectors.prefix(F.col("v"), 1)).collect()
    assert [tuple(r) for r in got] == [(0.6, 1.0, [3.0]), (0.0, 0.0, [0.0])]
