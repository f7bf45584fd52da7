import csv
import datetime as dt
import itertools
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tests.test_cdc import event
from tidemark.functions.events import EVENT_FIELDS
from tidemark.streaming import cdc_stream

FALLBACK = dt.date(2026, 9, 1)
# files of one millisecond would arrive in any order
ARRIVALS = itertools.count(int(time.time()) - 1000)


def drop_csv(folder, name, events):
    with open(folder / name, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(EVENT_FIELDS)
        w.writerows([("" if v is None else v for v in e[1:]) for e in by_field(events)])
    os.utime(folder / name, (arrival := next(ARRIVALS), arrival))


def by_field(events):
    """Events in the order of the event fields: amount before title."""
    names = ["seq", "event_id", "event_timestamp", "op_code", "article_id", "company_name", "title", "category",
             "author", "published_date", "arr_usd_M", "summary", "url"]
    return [[e[0], *[dict(zip(names, e))[f] for f in EVENT_FIELDS]] for e in events]


def base(spark):
    dim = spark.createDataFrame(
        [("COMP001", "MongoDB", "Data", "NY", 2007, 5000, "Small", True, "MDB", True)],
        "company_id STRING, company_name STRING, industry STRING, headquarters STRING, founded_year BIGINT, "
        "employee_count BIGINT, company_size_category STRING, is_public BOOLEAN, stock_ticker STRING, has_company_metadata BOOLEAN")
    articles = spark.createDataFrame(
        [("ART1", 0, "COMP001", "t", "c", "c", "a", "2021-01-01", 2021, 1, 1, "2021-01", 1, "s", "u")],
        "article_id STRING, original_index BIGINT, company_id STRING, title STRING, category STRING, category_clean STRING, "
        "author STRING, published_date_clean STRING, published_year BIGINT, published_quarter BIGINT, published_month BIGINT, "
        "published_year_month STRING, word_count BIGINT, summary STRING, url STRING")
    observations = spark.createDataFrame(
        [("ARR1", "ART1", "COMP001", "2021-01-01", 2021, 1, "2021-01", 7, 7_000_000)],
        "observation_id STRING, article_id STRING, company_id STRING, observation_date STRING, observation_year BIGINT, "
        "observation_quarter BIGINT, observation_year_month STRING, arr_usd_M BIGINT, arr_usd BIGINT")
    return {"dim_company": dim, "fct_article": articles, "fct_arr_observation": observations}


def run(spark, landing, root, **options):
    stream = cdc_stream.event_stream(spark, str(landing), files_per_batch=1)
    cdc_stream.start(stream, root, **options).awaitTermination()


def test_batches_end_to_end(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    cdc_stream.load_base(spark, root, base(spark))
    drop_csv(landing, "b1.csv", [event(1, "I", "ART4", "Confluent", "980.0", summary="line one\nline two"),
                                 event(2, "I", "ART6", "NVIDIA", "1000"), event(3, "I", "ART9", "MongoDB", "")])
    run(spark, landing, root)
    tables = cdc_stream.snapshot(spark, root, FALLBACK)
    assert values(tables["fct_article"], "article_id") == [("ART1",), ("ART4",), ("ART6",), ("ART9",)]
    assert values(tables["view_company_latest_arr"], "company_id", "company_name", "latest_arr_usd_M", "total_observations_recorded") == [
        ("COMP001", "MongoDB", 7, 1), ("COMP002", "Confluent", 980, 1), ("COMP003", "NVIDIA", 1000, 1)]

    drop_csv(landing, "b2.csv", [event(4, "U", "ART4", "Confluent", "1050.0"), event(5, "D", "ART6", "NVIDIA")])
    drop_csv(landing, "b3.csv", [event(6, "I", "LATE", "MongoDB", ts="2026-10-20T00:00:00"), event(7, "I", "", "X", "BAD")])
    run(spark, landing, root, cutoff=lambda batch: F.lit("2026-10-24").cast("timestamp"))
    assert values(cdc_stream.metrics(spark, root)) == [
        (0, 3, 3, 0, 0, 3, 0, 0), (1, 2, 2, 0, 0, 0, 1, 1), (2, 2, 0, 1, 1, 0, 0, 0)]
    tables = cdc_stream.snapshot(spark, root, FALLBACK)
    assert values(tables["fct_arr_observation"], "observation_id", "arr_usd_M") == [("ARR1", 7), ("OBS_ART4", 1050)]
    assert cdc_stream.dead_letters(spark, root).count() == 1
    assert values(cdc_stream.live_state(spark, root), "article_id", "arr_usd_M") == [("ART4", 1050.0), ("ART9", 0.0)]

    # folding the log changes nothing, twice
    before = {n: values(t) for n, t in tables.items()}
    assert cdc_stream.compact(spark, root, FALLBACK) == 2
    assert cdc_stream.compact(spark, root, FALLBACK) == 2
    after = cdc_stream.snapshot(spark, root, FALLBACK)
    assert {n: values(t) for n, t in after.items()} == before
    drop_csv(landing, "b4.csv", [event(8, "D", "ART4", "Confluent")])
    run(spark, landing, root)
    last = cdc_stream.snapshot(spark, root, FALLBACK)
    assert values(last["fct_arr_observation"], "observation_id") == [("ARR1",)]


def test_line_order_within_a_file_decides(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    drop_csv(landing, "b.csv", [event(i, "U", "A", "C", str(i)) for i in range(1, 400)])
    run(spark, landing, root)
    assert values(cdc_stream.live_state(spark, root), "last_event_id") == [("E399",)]


def test_replayed_batch_counts_once(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    cdc_stream.load_base(spark, root, base(spark))
    drop_csv(landing, "b.csv", [event(1, "I", "A", "C", "5"), event(2, "I", "A", "C", "6")])
    run(spark, landing, root)
    first = values(cdc_stream.snapshot(spark, root, FALLBACK, insert="append")["fct_article"], "article_id", "title")
    assert first == [("A", "t1"), ("A", "t2"), ("ART1", "t")]
    # the batch again, as after a crash between the log and the commit
    stream = cdc_stream.event_stream(spark, str(landing), files_per_batch=1)
    query = (
        stream.writeStream.foreachBatch(lambda b, i: None).option("checkpointLocation", str(tmp_path / "other"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    cdc_stream.start(stream, root).awaitTermination()
    again = values(cdc_stream.snapshot(spark, root, FALLBACK, insert="append")["fct_article"], "article_id", "title")
    assert again == first


def test_emit_only_on_change_and_json_lines(spark, tmp_path):
    landing, root, target = tmp_path / "landing", str(tmp_path / "state"), str(tmp_path / "live")
    landing.mkdir()

    def drop(name, events):
        lines = [json.dumps(dict(zip(EVENT_FIELDS, e[1:]))) for e in by_field(events)]
        (landing / name).write_text("\n\n".join(lines) + "\n\n")

    def tick():
        stream = cdc_stream.event_stream(spark, str(landing), "json")
        cdc_stream.start(stream, root).awaitTermination()
        return cdc_stream.emit_if_changed(spark, root, target)

    drop("a.jsonl", [event(1, "I", "A", "C", "5"), event(2, "I", "B", "C", "6")])
    assert tick() == (True, 2)
    assert tick() == (False, 2)
    drop("b.jsonl", [event(3, "D", "A", "C")])
    assert tick() == (True, 1)
    drop("c.jsonl", [event(4, "D", "A", "C")])
    assert tick() == (False, 1)
    assert values(spark.read.parquet(target), "article_id") == [("B",)]


@pytest.mark.parametrize("line_breaks", [True, False])
def test_csv_is_bound_by_the_header_of_each_file(spark, tmp_path, line_breaks):
    landing, root = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    (landing / "narrow.csv").write_text(
        "event_id,event_timestamp,op_code,article_id,company_name,arr_usd_M,title\n"
        "E1,2026-10-25T10:00:00,I,A1,Acme,5,hello\n"
        "E2,2026-10-25T10:00:00,I,A2,Acme,,\n")
    (landing / "other.csv").write_text(
        "\ufefftitle,published_date,company_name,article_id,op_code,event_timestamp,event_id,unknown\n"
        "world,,Acme,A3,I,2026-10-25T10:00:00,E3,x\n"
        "short\n")
    stream = cdc_stream.event_stream(spark, str(landing), line_breaks=line_breaks)
    cdc_stream.start(stream, root).awaitTermination()
    # no base was ever stored
    tables = cdc_stream.snapshot(spark, root, FALLBACK)
    day = cdc_stream.read_log(spark, root).select(F.date_format("logged_at", "yyyy-MM-dd")).first()[0]
    assert values(tables["fct_article"], "article_id", "title", "category", "author", "summary", "published_date_clean") == [
        ("A1", "hello", "General", "Unknown", "", day), ("A2", "", "General", "Unknown", "", day),
        ("A3", "world", "General", "Unknown", "", "")]
    assert values(tables["fct_arr_observation"], "article_id", "arr_usd_M") == [("A1", 5)]
    assert values(tables["dim_company"], "company_id", "company_name", "industry") == [("COMP001", "Acme", "Technology")]
    first = values(cdc_stream.dead_letters(spark, root))
    assert [r[1] for r in first] == ["Missing or empty required field: `event_id`"]
    assert values(cdc_stream.dead_letters(spark, root)) == first


def test_unmarked_batches_are_not_read(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    drop_csv(landing, "a.csv", [event(1, "I", "A", "C", "5")])
    run(spark, landing, root)
    torn = cdc_stream.read_log(spark, root).drop("batch")
    torn.write.partitionBy("outcome").parquet(f"{root}/log/batch=7")
    assert cdc_stream.read_log(spark, root).count() == 1
    assert cdc_stream.compact(spark, root, FALLBACK) == 0
    assert values(cdc_stream.snapshot(spark, root, FALLBACK)["fct_article"], "article_id") == [("A",)]
