import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, values
from tidemark.operators import cdc

FALLBACK = dt.date(2026, 9, 1)
SCHEMA = ("seq INT, event_id STRING, event_timestamp STRING, op_code STRING, article_id STRING, company_name STRING, "
          "title STRING, category STRING, author STRING, published_date STRING, arr_usd_M STRING, summary STRING, url STRING")


def event(seq, op, key, company="C", arr="1.9", ts="2026-10-25T10:00:00", **more):
    row = {"title": f"t{seq}", "category": "cat", "author": "a", "published_date": "2023-12-13", "summary": "one two",
           "url": ""} | more
    return (seq, f"E{seq}", ts, op, key, company, row["title"], row["category"], row["author"],
            row["published_date"], arr, row["summary"], row["url"])


def one_by_one(existing, events, mode):
    """Apply events in order: the model the set form has to equal."""
    table = list(existing)
    for e in events:
        seq, op, key = e[0], e[3].upper(), e[4]
        if op in ("D", "U") or mode == "upsert":
            table = [r for r in table if r[0] != key]
        if op != "D":
            table.append((key, seq))
    return sorted(table)


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_set_form_equals_one_by_one(spark, mode):
    rng = random.Random(mode)
    for _ in range(4):
        existing = [(f"K{rng.randint(0, 8)}", -i) for i in range(1, 6)]
        events = [event(i, rng.choice("IUDiud"), f"K{rng.randint(0, 8)}") for i in range(30)]
        stored = spark.createDataFrame(existing, "article_id STRING, seq INT")
        feed = cdc.valid_events(cdc.classify(spark.createDataFrame(events, SCHEMA).repartition(3)))
        survivors, kept = cdc.apply_events(stored, feed, "article_id", ["seq"], mode)
        got = values(survivors.unionByName(kept.select("article_id", "seq")))
        assert got == sorted(one_by_one(existing, events, mode), key=repr)


def test_sync_equals_one_by_one(spark):
    rng = random.Random(9)
    events = [event(i, rng.choice("IUD"), f" K{rng.randint(0, 6)} ", arr=rng.choice(["", "2.5"])) for i in range(60)]
    live = {}
    for e in events:
        if e[3] == "D":
            live.pop(e[4].strip(), None)
        else:
            live[e[4].strip()] = (float(e[10] or 0), e[1])
    got = cdc.sync(spark.createDataFrame(events, SCHEMA), ["seq"])
    assert values(got, "article_id", "arr_usd_M", "last_event_id") == sorted((k, *v) for k, v in live.items())


def test_outcomes_and_metrics(spark):
    events = [event(1, "I", "A"), event(2, "X", "A"), event(3, "D", "nothing"), event(4, "u", "A", arr="x"),
              event(5, "U", "A", ts="2026-10-20T00:00:00"), event(6, "U", "A", ts="2026-10-23T10:00:00Z")]
    df = spark.createDataFrame(events, SCHEMA)
    # 48 hours before the latest event is event 6 itself, which is in time
    judged = cdc.classify(df, cdc.event_time_cutoff(df, 48))
    assert values(judged, "seq", "outcome") == [(1, "valid"), (2, "dead"), (3, "valid"), (4, "dead"), (5, "late"), (6, "valid")]
    assert tuple(cdc.batch_metrics(judged).first()) == (6, 3, 2, 1, 1, 1, 1)
    now = cdc.classify(df, cdc.wall_clock_cutoff(24 * 365 * 300.0))
    assert now.filter("outcome = 'late'").isEmpty()


def test_dead_letter_keeps_the_payload(spark):
    df = spark.createDataFrame([event(1, "I", "", arr="INVALID", url="q\"x")], SCHEMA)
    letter = cdc.dead_letters(cdc.classify(df), ["event_id", "article_id", "arr_usd_M", "url"]).first()
    assert letter.failure_reason == "Missing or empty required field: `article_id`"
    assert letter.raw_payload == '{"event_id":"E1","article_id":"","arr_usd_M":"INVALID","url":"q\\"x"}'


def test_inferred_members_by_first_sight(spark):
    dim = spark.createDataFrame([("COMP001", "A"), ("COMP002", "B")], "company_id STRING, company_name STRING")
    events = [event(1, "D", "k", "Z", category="zz"), event(2, "I", "k", "A"), event(3, "I", "k", "Y", category=None),
              event(4, "I", "k", "Z", category="other")]
    got = cdc.infer_members(dim, spark.createDataFrame(events, SCHEMA), ["seq"])
    assert values(got) == [("COMP003", "Z", "zz"), ("COMP004", "Y", None)]


def test_fact_rows(spark):
    events = [event(1, "I", "A", arr="1050.9"), event(2, "I", "B", arr="", published_date="bad"),
              event(3, "I", "C", arr="-1.5", summary=None)]
    kept = cdc.classify(spark.createDataFrame(events, SCHEMA)).withColumn("company_id", F.lit("COMP001"))
    articles = cdc.article_rows(kept, FALLBACK)
    assert values(articles, "article_id", "published_date_clean", "published_year", "published_quarter", "word_count") == [
        ("A", "2023-12-13", 2023, 4, 2), ("B", "bad", 2026, 3, 2), ("C", "2023-12-13", 2023, 4, 0)]
    observations = cdc.observation_rows(kept, FALLBACK)
    assert values(observations, "observation_id", "arr_usd_M", "arr_usd") == [
        ("OBS_A", 1050, 1_050_000_000), ("OBS_C", -1, -1_000_000)]


def test_narrow_events_have_defaults(spark):
    kept = spark.createDataFrame([("A", "COMP001", "2", "t")], "article_id STRING, company_id STRING, arr_usd_M STRING, title STRING")
    row = cdc.article_rows(kept, FALLBACK).first()
    assert (row.category, row.author, row.summary, row.word_count) == ("General", "Unknown", "", 0)
    assert row.published_date_clean == spark.sql("SELECT date_format(current_date(), 'yyyy-MM-dd')").first()[0]


def test_kept_events_plan_has_no_window(spark):
    df = cdc.classify(spark.createDataFrame([event(1, "I", "A")], SCHEMA))
    _, kept = cdc.apply_events(df.select("article_id"), df, "article_id", ["seq"], "append")
    text = plan(kept)
    assert "Window" not in text and "SinglePartition" not in text


def test_inferred_ids_go_on_from_the_highest(spark):
    dim = spark.createDataFrame([("COMP001", "a"), ("COMP003", "c")], "company_id string, company_name string")
    events = spark.createDataFrame([("x", 1), ("y", 2), ("a", 3)], "company_name string, at int")
    made = cdc.infer_members(dim, events, ["at"]).collect()
    assert sorted((r.company_id, r.company_name) for r in made) == [("COMP004", "x"), ("COMP005", "y")]
