"""Ingest as a stream: the same rows as the batch, once each, whatever is interrupted."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from test_events import payload
from tillbook.functions.codec import clean, parse
from tillbook.operators.versions import VersionedTable
from tillbook.plans import quality, reports
from tillbook.schema import CLEAN, STORED
from tillbook.session import pin
from tillbook.sources.events import raw_source
from tillbook.streaming import ingest, waiting
from tillbook.streaming.ingest import rejects_of, running_query, start_ingest, stored_events
from tillbook.streaming.journal import Journal
from tillbook.streaming.progress import progress


def arrive(folder, name, *texts):
    """Put a file into the landing folder the way a producer does: complete or not at all."""
    os.makedirs(f"{folder}/landing", exist_ok=True)
    with open(f"{folder}/.{name}", "w") as out:
        out.write("".join(t + "\n" for t in texts))
    os.replace(f"{folder}/.{name}", f"{folder}/landing/{name}")


def one(number, **changes):
    return payload(transaction_id=f"t{number}", **changes)


def source(spark, folder, **options):
    return raw_source(pin(spark), "files", f"{folder}/landing", **options)


def run(spark, folder, sink="versions", mode="strict", **options):
    target = f"{folder}/table" if sink == "versions" else f"{folder}/out"
    query = start_ingest(source(spark, folder, **options), sink, target, f"{folder}/checkpoint", trigger="availableNow", mode=mode)
    quality.settle(query, location=f"{folder}/landing", checkpoint=f"{folder}/checkpoint")
    query.awaitTermination()
    return query


def settle(query, folder, timeout=60.0):
    quality.settle(query, timeout, location=f"{folder}/landing", checkpoint=f"{folder}/checkpoint")


@pytest.fixture
def stored(spark, folder):
    return VersionedTable(pin(spark), f"{folder}/table", STORED)


def ids(frame):
    return sorted(r["transaction_id"] for r in frame.select("transaction_id").collect())


def test_stream_equals_batch(spark, folder, stored):
    texts = [one(1), one(2, payment_status="failed"), one(3, payment_status="refunded"), "junk", one(4, items=[])]
    arrive(folder, "a", *texts)
    run(spark, folder)
    batch = clean(parse(spark.read.text(f"{folder}/landing").select(F.col("value").cast("binary"))))
    key = "transaction_id"
    assert stored.current().orderBy(key).collect() == batch.select(CLEAN.fieldNames()).orderBy(key).collect()


def test_one_version_per_micro_batch(spark, folder, stored):
    for n in range(3):
        arrive(folder, f"f{n}", one(n))
        os.utime(f"{folder}/landing/f{n}", (n + 1000, n + 1000))
    run(spark, folder, per_batch=1)
    assert [(r["operation"], r["total_records"]) for r in stored.snapshots().collect()] == [("append", n) for n in (1, 2, 3)]
    assert ids(stored.as_of(2)) == ["t0", "t1"]


def test_restart_adds_only_what_is_new(spark, folder, stored):
    arrive(folder, "a", one(1))
    run(spark, folder)
    run(spark, folder)
    arrive(folder, "b", one(2))
    run(spark, folder)
    assert ids(stored.current()) == ["t1", "t2"]
    assert stored.snapshots().count() == 2


@pytest.mark.parametrize("sink, mode", [("versions", "strict"), ("versions", "quarantine"), ("parquet", "quarantine")])
def test_replay_after_a_crash(spark, folder, stored, monkeypatch, sink, mode):
    """The batch is written, but its query dies before it can say so. Strict Parquet is Spark's own sink."""
    arrive(folder, "a", one(1), "junk")
    make = ingest._batch_writer

    def crashing(*arguments):
        write = make(*arguments)

        def crash(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("power cut")

        return crash

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "_batch_writer", crashing)
        for _ in range(2):
            with pytest.raises(Exception, match="power cut"):
                run(spark, folder, sink=sink, mode=mode)
    arrive(folder, "b", one(2))
    run(spark, folder, sink=sink, mode=mode)
    run(spark, folder, sink=sink, mode=mode)
    assert ids(stored.current() if sink == "versions" else stored_events(spark, f"{folder}/out")) == ["t1", "t2"]
    if mode == "quarantine":
        target = f"{folder}/table" if sink == "versions" else f"{folder}/out"
        assert spark.read.option("recursiveFileLookup", "true").parquet(rejects_of(sink, target, f"{folder}/checkpoint")).count() == 1


def test_delete_during_a_stream(spark, folder, stored):
    """A change by another program takes the version number the stream was about to use."""
    arrive(folder, "a", one(1, payment_status="refunded"))
    query = start_ingest(source(spark, folder), "versions", stored.root, f"{folder}/checkpoint", trigger="1 second")
    try:
        settle(query, folder)
        stored.delete_where("payment_status = 'refunded'")
        arrive(folder, "b", one(2, payment_status="refunded"))
        settle(query, folder)
    finally:
        query.stop()
    assert ids(stored.current()) == ["t2"]
    assert [r["operation"] for r in stored.snapshots().collect()] == ["append", "delete", "append"]


def test_a_new_checkpoint_is_a_new_stream(spark, folder, stored):
    """Batch numbers start again; rows of the second stream are not taken for a replay."""
    arrive(folder, "a", one(1))
    for checkpoint in ("one", "two"):
        query = start_ingest(source(spark, folder), "versions", stored.root, f"{folder}/{checkpoint}", trigger="availableNow")
        query.awaitTermination()
    assert ids(stored.current()) == ["t1", "t1"]


def test_parquet_sink(spark, folder):
    arrive(folder, "a", one(1), one(2, payment_status=None))
    run(spark, folder, sink="parquet")
    run(spark, folder, sink="parquet")
    assert ids(stored_events(spark, f"{folder}/out")) == ["t1"]


def test_poison_time_stops_strict_and_not_quarantine(spark, folder, stored):
    arrive(folder, "a", one(1), one(2, timestamp="junk"))
    for _ in range(2):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            run(spark, folder)
    assert stored.current().count() == 0
    run(spark, folder, mode="quarantine")
    assert ids(stored.current()) == ["t1"]
    aside = spark.read.parquet(rejects_of("versions", stored.root, f"{folder}/checkpoint")).collect()
    assert [(r["reason"], json.loads(bytes(r["value"]))["transaction_id"]) for r in aside] == [("timestamp", "t2")]


def test_start_twice_returns_the_running_query(spark, folder, stored):
    arrive(folder, "a", one(1))
    first = start_ingest(source(spark, folder), "versions", stored.root, f"{folder}/checkpoint", trigger="1 second")
    try:
        again = start_ingest(source(spark, folder), "versions", stored.root, f"{folder}/checkpoint", trigger="1 second")
        assert again.runId == first.runId and first.isActive
    finally:
        first.stop()
    assert running_query(spark, f"{folder}/checkpoint") is None
    assert running_query(spark, f"{folder}/elsewhere") is None


def test_latest_skips_what_was_there(spark, folder, stored):
    arrive(folder, "old", one(1))
    os.utime(f"{folder}/landing/old", (1000, 1000))
    options = {"start": "latest", "checkpoint": f"{folder}/checkpoint"}
    run(spark, folder, **options)
    assert stored.current().count() == 0
    time.sleep(0.01)
    arrive(folder, "new", one(2))
    run(spark, folder, **options)
    assert ids(stored.current()) == ["t2"]


def test_table_source(spark, folder, stored):
    pin(spark).createDataFrame([(one(1).encode(),)], "value binary").write.parquet(f"{folder}/landing")
    raw = raw_source(spark, "table", f"{folder}/landing")
    start_ingest(raw, "versions", stored.root, f"{folder}/checkpoint", trigger="availableNow").awaitTermination()
    assert ids(stored.current()) == ["t1"]


def test_wrong_names_fail_before_anything_starts(spark, folder, stored):
    os.makedirs(f"{folder}/landing")
    raw = source(spark, folder)
    for arguments in ({"sink": "csv"}, {"sink": "versions", "mode": "loose"}):
        with pytest.raises(ValueError):
            start_ingest(raw, target=stored.root, checkpoint=f"{folder}/checkpoint", **arguments)
    with pytest.raises(ValueError):
        raw_source(spark, "socket", "x")
    with pytest.raises(ValueError):
        raw_source(spark, "files", folder, start="latest")
    with pytest.raises(ValueError):
        raw_source(spark, "files", folder, start="yesterday")
    assert not os.path.exists(f"{folder}/checkpoint")


def test_progress(spark, folder, stored):
    arrive(folder, "a", one(1), one(2))
    rows = progress(spark, run(spark, folder)).collect()
    assert sum(r["input_rows"] for r in rows) == 2
    assert rows[0]["batch_id"] == 0 and rows[0]["end_offset"]


def test_gated_run(spark, folder, stored):
    arrive(folder, "a", one(1))
    start = lambda: start_ingest(source(spark, folder), "versions", stored.root, f"{folder}/checkpoint", trigger="availableNow")
    place = {"location": f"{folder}/landing", "checkpoint": f"{folder}/checkpoint"}
    assert quality.gated_run(start, stored.current, **place).first().asDict() == {
        "row_count": 1, "null_transaction_ids": 0, "failed_payments": 0
    }
    arrive(folder, "b", payload(transaction_id=None))
    with pytest.raises(quality.DataQualityError) as failed:
        quality.gated_run(start, stored.current, **place)
    assert (failed.value.rule, failed.value.value) == ("null_transaction_ids", 1)


@pytest.fixture
def running(spark, folder, stored):
    """A query with a long trigger: it looks for new files once a minute."""
    arrive(folder, "a", one(1))
    query = start_ingest(source(spark, folder), "versions", stored.root, f"{folder}/checkpoint", trigger="60 seconds")
    yield query
    query.stop()


def test_waiting_for_an_idle_query_returns_at_once(running, folder, stored):
    settle(running, folder)
    assert ids(stored.current()) == ["t1"]
    before = time.monotonic()
    settle(running, folder, timeout=5.0)
    assert time.monotonic() - before < 3 and running.isActive


def test_waiting_for_a_stuck_query_times_out(running, folder):
    settle(running, folder)
    arrive(folder, "b c", one(2))  # the next trigger is a minute away
    with pytest.raises(TimeoutError):
        settle(running, folder, timeout=1.0)


def test_waiting_does_not_depend_on_what_arrives_meanwhile(spark, folder, stored):
    """A producer that never stops, and a query that takes one file at a time."""
    for n in range(3):
        arrive(folder, f"a{n}", one(n))
    stop = threading.Event()

    def produce():
        n = 100
        while not stop.is_set():
            arrive(folder, f"b{n}", one(n))
            n += 1
            time.sleep(0.1)

    query = start_ingest(source(spark, folder, per_batch=1), "versions", stored.root, f"{folder}/checkpoint", trigger="100 milliseconds")
    producer = threading.Thread(target=produce)
    producer.start()
    try:
        settle(query, folder)
        assert {"t0", "t1", "t2"} <= set(ids(stored.current())) and query.isActive
    finally:
        stop.set()
        producer.join()
        query.stop()


class Reporting:
    """A query whose source reports its latest offsets, as Kafka does."""

    def __init__(self, *ends, latest):
        self.ends, self.latest, self.isActive = list(ends), latest, True

    @property
    def lastProgress(self):
        end = self.ends.pop(0) if len(self.ends) > 1 else self.ends[0]
        return {"sources": [{"endOffset": end, "latestOffset": self.latest}]}

    def awaitTermination(self, seconds):
        return False

    def exception(self):
        return None


@pytest.mark.parametrize("ends, latest, stuck", [
    (['{"t":{"0":5,"1":2}}', '{"t":{"0":5,"1":2}}', '{"t":{"0":9,"1":7}}'], '{"t":{"0":9,"1":6}}', False),
    (['{"t":{"0":9,"1":6}}'], '{"t":{"0":9,"1":6}}', False),
    (['{"t":{"0":9,"1":5}}'], '{"t":{"0":9,"1":6}}', True),
    (['{"t":{"0":9}}'], '{"t":{"0":9,"1":6}}', True),
    (["3", "4"], "4", False), ([None], None, True), ([{"t": {"0": 1}}], {"t": {"0": 1}}, False),
])
def test_waiting_by_reported_offsets(ends, latest, stuck):
    if stuck:
        with pytest.raises(TimeoutError):
            waiting.settle(Reporting(*ends, latest=latest), 0.3)
    else:
        waiting.settle(Reporting(*ends, latest=latest), 5.0)


def test_waiting_raises_what_stopped_the_query(spark, folder, stored):
    arrive(folder, "a", one(1, timestamp="junk"))
    query = start_ingest(source(spark, folder), "versions", stored.root, f"{folder}/checkpoint", trigger="1 second")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        settle(query, folder)


def test_the_journal_outlives_its_queries(spark, folder, stored):
    """Rows of a stopped query and of its restart, with the quality counts, in one table."""
    with Journal(spark, f"{folder}/journal") as journal:
        assert journal.rows().count() == 0
        for n, texts in enumerate([[one(1), one(2, payment_status="failed")], [], [one(3), payload(transaction_id=None), "junk"]]):
            if texts:
                arrive(folder, f"f{n}", *texts)
            journal.wait(run(spark, folder))
    arrive(folder, "later", one(9))
    run(spark, folder)  # nobody listens any more
    found = journal.rows().orderBy("batch_id").collect()
    assert [(r["batch_id"], r["input_rows"], r["row_count"], r["null_transaction_ids"], r["failed_payments"]) for r in found] == [(0, 2, 1, 0, 0), (1, 3, 2, 1, 0)]
    assert len({r["query_id"] for r in found}) == 1 and len({r["run_id"] for r in found}) == 2
    assert all(r["sources"][0]["end_offset"] and r["duration_ms"] >= 0 and r["late_rows"] == 0 for r in found)


def test_rates_of_a_stream_over_a_restart(spark, folder):
    """Open windows are kept over the restart; late events are left out and counted."""
    pin(spark)

    def stream():
        events = spark.readStream.schema("ts timestamp").json(f"{folder}/landing")
        counts = reports.windowed_counts(events, seconds=60, delay="2 minutes")
        writer = counts.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
        return writer.outputMode("append").trigger(availableNow=True).start()

    def at(*minutes):
        return [json.dumps({"ts": f"2026-04-09T10:{m:02d}:30Z"}) for m in minutes]

    with Journal(spark, f"{folder}/journal") as journal:
        for name, minutes in (("a", (0, 0, 3)), ("b", (2, 4, 0)), ("c", (9, 9))):  # 0 is late when b arrives
            arrive(folder, name, *at(*minutes))
            query = stream()
            query.awaitTermination()
            journal.wait(query)
    counts = spark.read.schema("window_start timestamp, found long").parquet(f"{folder}/out")
    rates = reports.rates_of_counts(counts, seconds=60, low=0.01, high=0.03).orderBy("window_start").collect()
    assert [(r["events"], r["in_range"]) for r in rates] == [(2, False), (0, False), (1, True), (1, True), (1, True)]
    assert sum(r["late_rows"] for r in journal.rows().collect()) == 1


def test_a_hot_store_is_split_in_a_micro_batch(spark, folder):
    """Adaptive execution also holds inside foreachBatch."""
    pin(spark)
    stored = VersionedTable(spark, f"{folder}/table", STORED, ("store",))
    many = spark.range(40_000).select(
        F.replace(F.lit(payload(transaction_id="NUMBER")), F.lit("NUMBER"), F.sha2(F.col("id").cast("string"), 256)).alias("value")
    )
    many.repartition(8).write.text(f"{folder}/landing")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "256KB")
    try:
        query = start_ingest(source(spark, folder), "versions", stored.root, f"{folder}/checkpoint", trigger="availableNow", layout=("store",))
        query.awaitTermination()
    finally:
        spark.conf.set(advisory, before)
    assert stored.total_records() == 40_000
    assert stored.partitions().first()["files"] > 2


class Recorder:
    """Stands in for a session whose Kafka connector is missing: notes the options of the reader."""

    def __init__(self):
        self.options = {}
        self.readStream = self

    def format(self, name):
        self.options["format"] = name
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self

    def select(self, *columns):
        self.options["columns"] = columns
        return self


@pytest.mark.parametrize("arguments, expected", [
    ({}, {"startingOffsets": "latest", "failOnDataLoss": "true", "subscribe": "raw_pos_transactions"}),
    ({"start": "earliest", "tolerate_loss": True, "topic": "t", "per_batch": 9},
     {"startingOffsets": "earliest", "failOnDataLoss": "false", "subscribe": "t", "maxOffsetsPerTrigger": 9}),
])
def test_kafka_options(arguments, expected):
    recorder = Recorder()
    raw_source(recorder, "kafka", "broker:9092", **arguments)
    assert recorder.options == {
        "format": "kafka", "kafka.bootstrap.servers": "broker:9092", "columns": ("value",), **expected
    }
