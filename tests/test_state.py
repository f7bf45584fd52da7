"""The tables that each micro-batch keeps up to date, against the log read as a whole."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tests.test_cdc import event
from tests.test_stream import ARRIVALS, FALLBACK, base, by_field, drop_csv
from tidemark.functions.events import EVENT_FIELDS
from tidemark.session import remove_folder
from tidemark.sources import readers
from tidemark.streaming import cdc_stream
from tidemark.streaming.buckets import BucketedTables
from tidemark.streaming.cdc_state import CdcState

TABLES = ("dim_company", "fct_article", "fct_arr_observation", "view_company_latest_arr")
BATCHES = [
    [event(1, "I", "ART4", "Confluent", "980.0"), event(2, "I", "ART6", "NVIDIA", "1000"), event(3, "I", "ART9", "MongoDB", "")],
    [event(4, "U", "ART4", "NVIDIA", "1050.0"), event(5, "D", "ART1", "MongoDB"), event(6, "I", "", "X", "BAD")],
    [event(7, "D", "ART6", "NVIDIA"), event(8, "I", "ART1", "Fresh", "3"), event(9, "I", "ART1", "Fresh", "4")],
    [event(10, "U", "ART9", "Confluent", "12"), event(11, "D", "NONE", "Confluent")],
]


def drop_json(folder, name, events):
    lines = [json.dumps(dict(zip(EVENT_FIELDS, e[1:]))) for e in by_field(events)]
    (folder / name).write_text("\n".join(lines) + "\n")
    os.utime(folder / name, (arrival := next(ARRIVALS), arrival))


def size(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(folder) for f in names if f.endswith("parquet"))


@pytest.mark.parametrize("insert", ["upsert", "append"])
def test_tables_after_each_batch_are_those_of_the_whole_log(spark, tmp_path, insert):
    landing, root = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    cdc_stream.load_base(spark, root, base(spark))
    state = CdcState(spark, root, FALLBACK, insert, buckets=4)
    state.load(base(spark))
    for i, events in enumerate(BATCHES):
        drop_csv(landing, f"b{i}.csv", events)
        stream = cdc_stream.event_stream(spark, str(landing), files_per_batch=1)
        cdc_stream.start(stream, root, after_batch=state.after_batch).awaitTermination()
        whole = cdc_stream.snapshot(spark, root, FALLBACK, insert)
        for name in TABLES:
            columns = sorted(whole[name].columns)
            assert values(state.table(name), *columns) == values(whole[name], *columns), (name, i)
        assert values(state.table("live"), *cdc_stream.LIVE_COLUMNS) == values(cdc_stream.live_state(spark, root), *cdc_stream.LIVE_COLUMNS)
    # an applied batch does nothing when it is replayed
    before = state.store.current()
    assert state.advance(3) == before
    assert state.trim_log() == 3 and cdc_stream.committed(spark, root) == [3]
    assert cdc_stream.metrics(spark, root).count() == 4 and cdc_stream.dead_letters(spark, root).count() == 1
    drop_csv(landing, "b9.csv", [event(12, "D", "ART9", "MongoDB")])
    cdc_stream.start(cdc_stream.event_stream(spark, str(landing)), root, after_batch=state.after_batch).awaitTermination()
    assert values(state.table("live"), "article_id") == [("ART1",), ("ART4",)]


def test_a_batch_writes_the_buckets_it_touches(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    articles = base(spark)["fct_article"].drop("article_id").crossJoin(
        spark.range(5000).select(F.concat(F.lit("ART"), "id").alias("article_id")))
    state = CdcState(spark, root, FALLBACK, buckets=32)
    state.load({**base(spark), "fct_article": articles})
    drop_csv(landing, "a.csv", [event(1, "U", "ART7", "MongoDB", "9")])
    cdc_stream.start(cdc_stream.event_stream(spark, str(landing)), root, after_batch=state.after_batch).awaitTermination()
    written = os.listdir(f"{root}/state/fct_article/version=0")
    assert len([w for w in written if w.startswith("_bucket")]) == 1
    assert size(f"{root}/state/fct_article/version=0") < size(f"{root}/state/fct_article/version=-1") / 16
    assert not os.path.exists(f"{root}/state/dim_company/version=0")
    assert state.table("fct_article").count() == 5000


def test_replay_after_a_crash_and_files_sent_twice(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    order = ["batch", "event_timestamp", "event_id"]
    state = CdcState(spark, root, FALLBACK, "append", order, 4)
    state.load(base(spark))

    def run():
        stream = cdc_stream.deduplicated(cdc_stream.event_stream(spark, str(landing), "json"))
        cdc_stream.start(stream, root, after_batch=state.after_batch).awaitTermination()
        return values(state.table("fct_article"), "article_id", "title")

    drop_json(landing, "a.jsonl", [event(1, "I", "A", "C", "5"), event(2, "I", "A", "C", "6"), event(3, "I", "", "C")])
    first = run()
    assert first == [("A", "t1"), ("A", "t2"), ("ART1", "t")]
    # the same file again, and with a corrected event that had been dead
    drop_json(landing, "b.jsonl", [event(1, "I", "A", "C", "5"), event(2, "I", "A", "C", "6"), event(3, "I", "B", "C")])
    assert run() == [*first[:2], ("ART1", "t"), ("B", "t3")]
    # the last batch with events again, as after a crash before its end was noted
    counters = values(cdc_stream.metrics(spark, root), "batch", "total_records_ingested", "dlq_quarantined")
    assert [c[1:] for c in counters] == [(3, 1), (1, 0)]
    forget_end(spark, root, counters[-1][0])
    assert run() == [*first[:2], ("ART1", "t"), ("B", "t3")]
    assert values(cdc_stream.metrics(spark, root), "batch", "total_records_ingested", "dlq_quarantined") == counters


def forget_end(spark, root, batch):
    """Let the stream run a batch again: its end and all later batches were never noted."""
    for part, first in (("commits", batch), ("offsets", batch + 1)):
        for name in os.listdir(f"{root}/checkpoint/{part}"):
            if int(name.strip(".").split(".")[0]) >= first:
                remove_folder(spark, f"{root}/checkpoint/{part}/{name}")


def test_unfinished_version_is_not_seen(spark, tmp_path):
    store = BucketedTables(spark, str(tmp_path), {"t": "k"}, 4)
    rows = spark.createDataFrame([(str(i), i) for i in range(20)], "k STRING, v INT")
    first = store.write(0, {"t": (rows, range(4))})
    # a crash before the manifest
    rows.withColumn("_bucket", store.bucket("t")).write.partitionBy("_bucket").parquet(f"{tmp_path}/t/version=1")
    assert store.current() == first and store.read(first, "t").count() == 20
    again = store.write(1, {"t": (rows.filter("k < '5'"), range(4))}, first)
    assert store.read(store.current(), "t").count() == rows.filter("k < '5'").count()
    assert store.fingerprint(again, "t") != store.fingerprint(first, "t")
    # the order of rows and the way they are stored do not matter
    other = BucketedTables(spark, str(tmp_path / "o"), {"t": "k"}, 4).write(5, {"t": (rows.orderBy(F.desc("v")), range(4))})
    assert store.fingerprint(other, "t") == store.fingerprint(first, "t")


def test_idle_tick_reads_no_events(spark, tmp_path):
    landing, root, target = tmp_path / "landing", str(tmp_path / "state"), str(tmp_path / "live")
    landing.mkdir()
    state = CdcState(spark, root, FALLBACK, buckets=4)

    def tick(name=None, events=()):
        if name:
            drop_csv(landing, name, events)
        cdc_stream.start(cdc_stream.event_stream(spark, str(landing)), root, after_batch=state.after_batch).awaitTermination()
        return state.emit_if_changed(target)

    assert tick("a.csv", [event(1, "I", "A", "C", "5"), event(2, "I", "B", "C", "6")]) == (True, 2)
    remove_folder(spark, f"{root}/log")
    assert tick() == (False, 2)
    assert tick("b.csv", [event(3, "D", "A", "C")]) == (True, 1)
    assert tick("c.csv", [event(4, "D", "A", "C")]) == (False, 1)
    assert values(spark.read.parquet(target), "article_id") == [("B",)]


def test_reads_before_the_first_batch(spark, tmp_path):
    root = str(tmp_path / "fresh")
    assert cdc_stream.metrics(spark, root).columns[0] == "batch" and cdc_stream.metrics(spark, root).isEmpty()
    assert cdc_stream.dead_letters(spark, root).isEmpty()
    assert cdc_stream.live_state(spark, root).columns == list(cdc_stream.LIVE_COLUMNS)
    state = CdcState(spark, root, FALLBACK)
    assert state.table("view_company_latest_arr").isEmpty() and state.table("live").isEmpty()


def test_csv_with_many_columns_and_odd_names(spark, tmp_path):
    landing, root = tmp_path / "land ing", str(tmp_path / "state")
    landing.mkdir()
    extra = [f"x{i}" for i in range(300)]
    row = {f: "" for f in EVENT_FIELDS} | dict(zip(EVENT_FIELDS, by_field([event(1, "I", "A", "C", "5")])[0][1:]))
    header = [*extra, *EVENT_FIELDS]
    (landing / "wide 100%.csv").write_text(",".join(header) + "\n" + ",".join(str(row.get(h) or "") for h in header) + "\n")
    (landing / "empty.csv").write_text("")
    cdc_stream.start(cdc_stream.event_stream(spark, str(landing)), root).awaitTermination()
    assert values(cdc_stream.live_state(spark, root), "article_id", "arr_usd_M") == [("A", 5.0)]


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"{i:02}.csv").write_text("a,b\n1,2\n" if i % 2 else '"b","c,d"\n3,4\n')
    tracker, group = spark.sparkContext.statusTracker(), "headers"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = readers.headers(spark, readers._listed(spark, str(tmp_path), "*.csv"))
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(p) for h, p in found.items()} == {("a", "b"): 30, ("b", "c,d"): 30}
    # listing the files may take a job of its own
    assert jobs <= 4
    assert readers.read_csv_folder(spark, str(tmp_path)).agg(F.count("a"), F.count("b"), F.count("c,d")).first() == (30, 60, 30)


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    size_conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size_conf)
    spark.conf.set(size_conf, "20k")
    try:
        tables = BucketedTables(spark, str(tmp_path), {"facts": "k"}, buckets=1)
        rows = spark.range(0, 40_000, 1, 8).select(F.col("id").cast("string").alias("k"), F.rand().alias("x"))
        version = tables.write(0, {"facts": (rows, [0])})
    finally:
        spark.conf.set(size_conf, before)
    files = [f for f in os.listdir(tmp_path / "facts" / "version=0" / "_bucket=0") if f.startswith("part-")]
    assert len(files) > 1
    assert tables.read(version, "facts").count() == 40_000 == tables.fingerprint(version, "facts")[0]


def test_a_batch_is_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(parts):
        for pdf in parts:
            read.add(len(pdf))
            yield pdf

    rows = [e[1:] for e in by_field(BATCHES[1] + BATCHES[2])]
    schema = ", ".join(f"{f} STRING" for f in EVENT_FIELDS)
    batch = spark.createDataFrame(rows, schema).mapInPandas(counted, schema)
    cdc_stream._log(batch, str(tmp_path), 0, cdc_stream.event_time(48))
    assert read.value == len(rows) == cdc_stream.metrics(spark, str(tmp_path)).first().total_records_ingested
