"""Sink behaviour: transactional batches, offset commits, dedupe (FIXTURES A3, SURVEY §5 d)."""

import time

import pytest
from pyspark.sql import functions as F

from ledgerlane.session import scratch
from ledgerlane.streaming import deliver as DV
from ledgerlane.streaming.sources import file_stream, run_to_end

SCHEMA = "type string, ledger_offset string, transaction_id string, contract_id string, template_id string, payload string"


def _events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_single_and_mixed_batch_commit_last_offset(spark):
    root = scratch(spark, "t-offsets")
    sink = scratch(spark, "t-offsets-sink")
    com = DV.OffsetCommitter(root, "stream", lambda df, batch: df.write.parquet(f"{sink}/batch_id={batch}"), "ledger_offset")
    single = _events(spark, [("created", "offset-1", "tx-1", "cid-1", "tid", '{"field":"value"}')]).withColumn(
        "stream", F.lit("s"))
    com(single, 0)
    assert [(r.stream, r.committed_offset) for r in com.committed(spark).collect()] == [("s", "offset-1")]
    mixed = _events(spark, [("created", "offset-10", "tx", "c", "t", "{}"), ("archived", "offset-11", "tx", "c", "t", None),
                            ("created", "offset-12", "tx", "c", "t", "{}")]).withColumn("stream", F.lit("m"))
    com(mixed, 1)
    got = {r.stream: r.committed_offset for r in com.committed(spark).collect()}
    assert got == {"s": "offset-1", "m": "offset-12"}
    # a late, smaller batch never moves the committed offset back (monotone)
    com(mixed.limit(1), 2)
    assert {r.stream: r.committed_offset for r in com.committed(spark).collect()}["m"] == "offset-12"
    assert spark.read.parquet(sink).count() == 5  # every batch was written before its offset was committed


def test_a_failed_write_commits_no_offset(spark):
    def write(df, batch):
        if batch == 1:
            raise RuntimeError("sink is down")

    com = DV.OffsetCommitter(scratch(spark, "t-offsets"), "s", write, "o")
    assert com.committed(spark).collect() == []
    rows = lambda o: spark.createDataFrame([("a", o), ("b", o)], "s string, o string")
    com(rows("offset-1"), 0)
    with pytest.raises(RuntimeError):
        com(rows("offset-2"), 1)
    assert {r.committed_offset for r in com.committed(spark).collect()} == {"offset-1"}
    for batch in range(2, 9):
        com(rows(f"offset-{batch}"), batch)
    assert {(r.s, r.committed_offset) for r in com.committed(spark).collect()} == {("a", "offset-8"), ("b", "offset-8")}
    assert len({f.split("half=")[1][0] for f in spark.read.parquet(com.root).inputFiles()}) == 2  # the log doesn't grow


def test_an_empty_batch_loses_no_committed_offset(spark):
    d, written = scratch(spark, "t-landing"), []
    for rows in ([("a", "offset-1")], [], [("b", "offset-2")], [], [], [("c", "offset-3")]):  # a micro-batch each
        spark.createDataFrame(rows, "s string, o string").coalesce(1).write.mode("append").parquet(d)
        time.sleep(0.02)
    com = DV.OffsetCommitter(scratch(spark, "t-offsets"), "s", lambda df, batch: written.append(batch), "o")
    run_to_end(file_stream(spark, d, "s string, o string").writeStream.foreachBatch(com)
               .option("checkpointLocation", scratch(spark, "t-offsets-ckpt")), timeout_s=120)
    assert {(r.s, r.committed_offset) for r in com.committed(spark).collect()} == {("a", "offset-1"), ("b", "offset-2"), ("c", "offset-3")}
    assert written == [0, 2, 5]


def test_abort_empty_and_retry(spark):
    root = scratch(spark, "t-txn")
    rows = _events(spark, [("created", "offset-1", "tx-1", "cid-1", "tid", "{}")])
    failing = DV.TransactionalSink(root, "ledger_offset", fail_before_commit_of=0)
    with pytest.raises(RuntimeError):
        failing(rows, 0)
    sink = DV.TransactionalSink(root, "ledger_offset")
    seen = lambda: (sink.committed(spark, SCHEMA).count(), [(r.committed_batch, r.last_offset) for r in sink.markers(spark).collect()])
    assert seen() == (0, [])  # aborted: neither messages nor offset
    sink(rows.limit(0), 1)  # empty batch: no commit
    assert seen() == (0, [])
    sink(rows, 0)  # retry of the same batch id: messages and offset, once
    assert seen() == (1, [(0, "offset-1")])


def test_only_a_missing_folder_reads_as_empty(spark):
    from py4j.protocol import Py4JJavaError

    from ledgerlane.session import read_or_empty
    assert read_or_empty(spark, scratch(spark, "t-none"), "a int").collect() == []
    with pytest.raises(Py4JJavaError):
        read_or_empty(spark, scratch(spark, "t-none"), "a int", "no_such_format")


@pytest.mark.parametrize("error,attempts,waits", [
    (DV.SendError("RecordTooLargeException", "too large"), 1, []),
    (ValueError("bad record"), 1, []),
    (DV.SendError("TimeoutException", "slow"), 5, [0.2, 0.4, 0.8, 1.0]),
])
def test_retry_by_error_class_then_dead_letter(spark, error, attempts, waits):
    """A permanent error is tried once, a passing one as often as the rule says; then the batch is dead-lettered whole."""
    tried, slept = [], []

    def write(df, batch):
        tried.append(batch)
        raise error

    w = DV.DeadLetterWriter(scratch(spark, "t-dlq"), write, "o", sleep=slept.append)
    text = 'quote " and\nnewline ' + "x" * 2000
    rows = spark.createDataFrame([(1, "o-1", text), (2, "o-2", None)], "id int, o string, t string")
    w(rows, 7)
    assert len(tried) == attempts and slept == waits
    dead = w.dead(spark).collect()
    assert sorted(r.metadata["offset"] for r in dead) == ["o-1", "o-2"]
    assert {(r.reason, r.metadata["batch"], r.metadata["attempts"]) for r in dead} == {(str(error), "7", str(attempts))}
    assert all("Traceback" in r.stackTrace and str(error) in r.stackTrace for r in dead)
    assert w.delivered(spark, "id int").collect() == []
    # Reprocessing: the events come back whole, through a sink.
    from ledgerlane.streaming import dlq as Q
    out = []
    Q.replay(w.dead(spark), "id int, o string, t string", lambda df: out.extend(df.collect()))
    assert sorted((r.id, r.o, r.t) for r in out) == [(1, "o-1", text), (2, "o-2", None)]
    assert [(r.reason, r.entries) for r in Q.by_reason(w.dead(spark)).collect()] == [(str(error), 2)]


def test_a_passing_error_is_delivered_on_retry(spark):
    left = [2]
    root = scratch(spark, "t-dlq")

    def write(df, batch):
        left[0] -= 1
        if left[0] >= 0:
            raise DV.SendError("NetworkException", "reset")
        df.write.parquet(f"{root}/sink/batch_id={batch}")

    w = DV.DeadLetterWriter(root, write, "id", sleep=lambda s: None)
    w(spark.createDataFrame([(1,)], "id int"), 0)
    assert [r.id for r in w.delivered(spark, "id int").collect()] == [1] and w.dead(spark).collect() == []
    log = spark.read.parquet(w.log).first()
    assert (log.status, log.events, log.attempts) == ("delivered", 1, 3)


def test_batches_of_one_write_fail_and_are_retried_alone(spark):
    root, tries, slept = scratch(spark, "t-units"), [], []
    errors = {1: [DV.SendError("RecordTooLargeException", "too large")], 2: [DV.SendError("TimeoutException", "slow")] * 2, 3: [DV.SendError("NetworkException", "reset")] * 9}

    def write(df, batch):
        here = sorted(r.b for r in df.select("b").distinct().collect())
        tries.append(here)
        bad = {b: errors[b][len(tries) - 1] for b in here if len(errors.get(b, [])) >= len(tries)}
        df.filter(~F.col("b").isin(list(bad))).write.mode("overwrite").parquet(f"{root}/sink/batch_id={batch}")
        if bad:
            raise DV.BatchErrors(bad)

    w = DV.DeadLetterWriter(root, write, "id", sleep=slept.append, batch_col="b")
    rows = spark.range(50).select("id", F.floor(F.col("id") / 10).alias("b"))
    for _ in range(2):  # a micro-batch that is tried again leaves the same
        tries.clear()
        w(rows, 6)
        assert tries == [[0, 1, 2, 3, 4]] + [[0, 2, 3, 4]] * 4
        assert sorted(r.id for r in w.delivered(spark, "id bigint").collect()) == [*range(10), *range(20, 30), *range(40, 50)]
        dead = w.dead(spark).collect()
        assert sorted(int(r.metadata["offset"]) for r in dead) == [*range(10, 20), *range(30, 40)]
        assert {(r.metadata["batch"], r.reason, r.metadata["attempts"]) for r in dead} == {("1", str(errors[1][0]), "1"), ("3", str(errors[3][0]), "5")}
        assert all("Traceback" in r.stackTrace and r.reason in r.stackTrace for r in dead)
        assert sorted((r.batch, r.status, r.events, r.attempts) for r in spark.read.parquet(w.log).collect()) == [
            (0, "delivered", 10, 1), (1, "dead_letter", 10, 1), (2, "delivered", 10, 3), (3, "dead_letter", 10, 5), (4, "delivered", 10, 1)]
    assert slept == [0.2, 0.4, 0.8, 1.0] * 2


def test_fan_out_counts_are_those_of_the_events(spark):
    f = DV.FanOut(scratch(spark, "t-fan-events"), scratch(spark, "t-fan-counts"))
    rows = spark.range(10).select("id", F.when(F.col("id") < 7, "a").otherwise("b").alias("topic"))
    f(rows, 0)
    f(rows, 0)  # a replayed batch replaces itself
    f(rows.filter("id = 0"), 1)
    assert {(r.topic, r.n) for r in f.counts(spark).groupBy("topic").agg(F.sum("events").alias("n")).collect()} == {("a", 8), ("b", 3)}
    assert f.events(spark).count() == 11


def test_dedupe_across_batches_and_restart(spark):
    """ST7: duplicates inside a batch, across batches and in a page replayed after a restart are dropped."""
    from ledgerlane.streaming.sources import file_stream, run_to_end
    from tests.arrival import stage_files
    src = spark.range(0, 1000).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("v"))
    d = scratch(spark, "t-dedupe-landing")
    stage_files(src.union(src.filter(F.col("event_id") % 10 == 0)), "event_id", d, n=4)  # in-batch copies
    stage_files(src.filter(F.col("event_id") % 3 == 0), "event_id", d, n=1)              # a later batch re-sends
    out, ck = scratch(spark, "t-dedupe-out"), scratch(spark, "t-dedupe-ckpt")
    stream = DV.dedupe(file_stream(spark, d, src.schema), ["event_id"])

    def run():
        run_to_end(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck))

    run()
    got = spark.read.parquet(out)
    assert got.count() == 1000 and got.select("event_id").distinct().count() == 1000
    stage_files(src.filter(F.col("event_id") % 97 == 0), "event_id", d, n=1)  # replay after the restart
    run()
    assert spark.read.parquet(out).count() == 1000


def test_crash_and_restart_stream(spark):
    """A stream fails at batch 2's commit; restart on the checkpoint: each event exactly once."""
    from ledgerlane.streaming.sources import file_stream, run_to_end
    from tests.arrival import stage_files
    src = spark.range(0, 1000).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("v"))
    d = scratch(spark, "t-landing")
    stage_files(src, "event_id", d, n=5)
    root, ck = scratch(spark, "t-crash"), scratch(spark, "t-crash-ckpt")
    stream = file_stream(spark, d, src.schema)
    from pyspark.sql.utils import StreamingQueryException
    with pytest.raises(StreamingQueryException):
        run_to_end(stream.writeStream.foreachBatch(DV.TransactionalSink(root, "event_id", fail_before_commit_of=2))
                   .option("checkpointLocation", ck))
    sink = DV.TransactionalSink(root, "event_id")
    schema = "event_id bigint, v bigint"
    assert sink.committed(spark, schema).count() == 400  # batches 0 and 1 only
    assert sorted(r.last_offset for r in sink.markers(spark).collect()) == ["199", "399"]  # nor any other offset
    run_to_end(stream.writeStream.foreachBatch(sink).option("checkpointLocation", ck))
    out = sink.committed(spark, schema)
    assert out.count() == 1000 and out.select("event_id").distinct().count() == 1000
    marks = spark.read.parquet(sink.commits).select("batch_id").distinct().count()
    assert marks == 5


def test_multi_file_pages_still_arrive_one_page_per_batch(spark, monkeypatch):
    """A page wider than PAGE_FILE_KEYS is several files (parallel writers); admission keeps batches = pages."""
    from ledgerlane.streaming import sources as S
    from tests import arrival as A
    monkeypatch.setattr(A, "PAGE_FILE_KEYS", 70)
    src = spark.range(0, 1000).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("v"))
    d = scratch(spark, "t-pages")
    ranges = A.stage_files(src, "event_id", d, n=5)
    k = A.page_files(ranges)
    assert k == 3
    assert len([f for f in spark.read.parquet(d).inputFiles()]) == 5 * k
    out = scratch(spark, "t-pages-out")

    def keep(df, batch_id):
        df.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    S.run_to_end(S.file_stream(spark, d, src.schema, k).writeStream.foreachBatch(keep)
                 .option("checkpointLocation", scratch(spark, "t-pages-ckpt")))
    got = spark.read.parquet(out).groupBy("batch").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"),
                                                         F.count(F.lit(1)).alias("n"))
    assert sorted((r.lo, r.hi + 1, r.n) for r in got.collect()) == [(lo, hi, hi - lo) for lo, hi in ranges]
