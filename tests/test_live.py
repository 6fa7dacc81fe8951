"""What a stream keeps up to date: the feed, status folds, sinks with positions of their own, reprocessing."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from ledgerlane.operators.feed import latest_feed
from ledgerlane.operators.metrics import latest_status, transitions
from ledgerlane.plans import streams
from ledgerlane.session import scratch
from ledgerlane.sources.archive import Archive
from ledgerlane.streaming import deliver as DV
from ledgerlane.streaming.dlq import read_dlq
from ledgerlane.streaming.feed import FeedSink
from ledgerlane.streaming.live import REMEMBERED, StatusFold
from ledgerlane.streaming.poller import drain, polled
from ledgerlane.streaming.reprocess import Reprocessor, dlq_stream
from ledgerlane.streaming.sinks import IndependentSinks


def offset(n):
    return f"{n:018d}"


def test_the_feed_after_every_micro_batch_is_the_batch_feed(spark):
    rows = spark.range(0, 400).select(F.lpad((F.col("id") * 37 % 400).cast("string"), 18, "0").alias("ledger_offset"), F.lit("created").alias("event_type"),
                                      F.lit(None).cast("string").alias("choice"), F.col("id").alias("at")).persist()
    sink = FeedSink(scratch(spark, "t-feed"), "ledger_offset string, event_type string, choice string", n=30)
    for k in range(5):  # offsets come in no order
        part = rows.filter((F.col("at") >= k * 80) & (F.col("at") < k * 80 + 80))
        sink(part, k)
        if k == 2:
            sink(part, k)  # tried again
        want = latest_feed(rows.filter(F.col("at") < k * 80 + 80), 30)
        assert sorted(r.ledger_offset for r in sink.feed(spark).collect()) == sorted(r.ledger_offset for r in want.collect())
    sink(rows.limit(0), 5)
    assert sink.feed(spark).count() == 30


def test_transitions_with_rows_in_any_order(spark):
    rows = spark.range(0, 600).select((F.col("id") % 3).cast("string").alias("k"), (F.xxhash64("id") % 2 == 0).cast("int").alias("s"), F.col("id").alias("o"),
                                      F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)).alias("batch")).persist()
    fold = StatusFold(scratch(spark, "t-fold"), "k", "s", "o", width=50)
    for b in (2, 0, 3):
        fold(rows.filter(F.col("batch") == b), b)
    late = rows.filter((F.col("batch") == 1))
    fold(late, 4)
    fold(late, 4)  # tried again
    want = transitions(rows, "k", "s", "o", F.lit(0))
    assert sorted(map(tuple, fold.reconnects(spark).collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, fold.latest(spark).collect())) == sorted(map(tuple, latest_status(rows, "k", "s", "o").collect()))


def test_live_counts_are_of_more_micro_batches_than_a_query_remembers(spark, monkeypatch):
    d = scratch(spark, "t-rate")
    (spark.range(0, 700).selectExpr("id AS o_orderkey", "id % 50 AS o_custkey", "if(id % 7 = 0, 'F', 'O') AS o_orderstatus", "1D AS o_totalprice",
                                    "TIMESTAMP_NTZ'2024-01-01' AS o_orderdate", "concat(id % 5 + 1, '-X') AS o_orderpriority").write.parquet(f"{d}/orders.parquet"))
    events = [k for k in range(700) for _ in range(2 if k % 7 == 0 else 1)]
    want = []
    for kind, priorities in (("kafka", {0}), ("kinesis", {2, 3, 4}), ("pulsar", {1})):
        failed = [k % 13 == 0 for k in events if k % 5 in priorities]
        want.append((kind, len(failed), failed.count(False), failed.count(True)))
    monkeypatch.setattr(streams, "LIVE_PAGES", 1)  # eight micro-batches, of which a query remembers two
    monkeypatch.setattr(streams, "MOST_PAGES", 1)
    before = spark.conf.get(REMEMBERED)
    spark.conf.set(REMEMBERED, 3)
    try:
        got = streams.failure_rate_live(spark, d).collect()
        assert spark.conf.get(REMEMBERED) == "3"
    finally:
        spark.conf.set(REMEMBERED, before)
    assert sorted(map(tuple, got)) == want


def test_a_sink_that_is_down_holds_up_no_other(spark):
    a = Archive(spark, scratch(spark, "t-alone"), "ledger_offset string, event_id bigint", file_rows=100)
    a.append(spark.range(0, 700).select(F.lpad(F.col("id").cast("string"), 18, "0").alias("ledger_offset"), F.col("id").alias("event_id")))
    root, calls = scratch(spark, "t-alone-out"), []

    def write(name):
        def part(df, number):
            calls.append((name, number))
            if name == "b" and len([c for c in calls if c[0] == "b"]) <= 3:
                raise DV.SendError("NetworkException", "down")
            df.select("event_id").write.mode("append").parquet(f"{root}/{name}")  # appends: a part sent twice would show
        return part

    sinks = IndependentSinks(a, scratch(spark, "t-alone-log"), {n: write(n) for n in "ab"})
    ck = scratch(spark, "t-alone-ckpt")
    drain(polled(a, pages_per_batch=1).writeStream.foreachBatch(sinks).option("checkpointLocation", ck))
    log = sorted((r.sink, r.first_after, r.upto, r.events, r.caught_up) for r in sinks.log(spark).collect())
    assert [x[3] for x in log if x[0] == "a"] == [100] * 7 and not any(x[4] for x in log if x[0] == "a")
    assert [(x[1], x[2], x[3], x[4]) for x in log if x[0] == "b"][0] == ("", offset(399), 400, True)  # three batches late, then all at once
    assert sinks.catch_up(spark) == []
    for n in "ab":
        assert sorted(r.event_id for r in spark.read.parquet(f"{root}/{n}").collect()) == list(range(700))


def entry(i, **meta):
    return json.dumps({"timestamp": "t", "reason": "r", "stackTrace": "s", "metadata": meta, "event": {"event_id": i, "v": f"x{i}"}})


def test_reprocessing_sends_each_entry_once_or_quarantines_it(spark):
    dlq, root, ck = scratch(spark, "t-dlq"), scratch(spark, "t-again"), scratch(spark, "t-again-ckpt")
    lines = [entry(i, offset=str(i)) for i in range(10)] + ["not json", json.dumps({"reason": "no event", "metadata": {}})]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(dlq)
    accepts = lambda: (F.col("event_id") % 5 != 0) & ((F.col("event_id") % 2 == 0) | (F.col("replays") >= 1))

    def run(fail=None):
        out = Reprocessor(root, dlq, "event_id bigint, v string", accepts, 3, fail)
        drain(dlq_stream(spark, dlq).writeStream.foreachBatch(out).option("checkpointLocation", ck))
        return out

    with pytest.raises(StreamingQueryException):
        run(fail=0)  # data written, mark not
    assert Reprocessor(root, dlq, "event_id bigint, v string", accepts).sent(spark).count() == 0
    out = run()
    out = run()  # nothing left
    assert sorted(map(tuple, out.sent(spark).select("event_id", "v", "replays").collect())) == sorted((i, f"x{i}", 0 if i % 2 == 0 else 1) for i in range(10) if i % 5)
    held = out.quarantined(spark).collect()
    assert sorted((json.loads(r.event)["event_id"], r.metadata) for r in held if r.event) == [(0, {"offset": "0", "replays": "2"}), (5, {"offset": "5", "replays": "2"})]
    assert len(held) == 4
    assert read_dlq(spark, dlq).count() >= len(lines)  # entries sent back lie beside the first ones
