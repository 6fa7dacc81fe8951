"""The event archive, the source that polls it, bounded dedupe and batches that stay open."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from ledgerlane.operators.batching import assign_batches, batch_manifest
from ledgerlane.session import read_or_empty, scratch
from ledgerlane.sources.archive import Archive, OutOfOrder
from ledgerlane.streaming.dedupe import DedupeSink
from ledgerlane.streaming.grouping import OpenBatches
from ledgerlane.streaming.poller import drain, polled

from tests.conftest import SF001

SCHEMA = "ledger_offset string, event_id bigint, template_id string, contract_id string"


def events(spark, lo, hi):
    n = F.col("id")
    return spark.range(lo, hi).select(F.lpad((n * 10).cast("string"), 18, "0").alias("ledger_offset"), n.alias("event_id"),
                                      F.concat(F.lit("T"), (n / 1000).cast("int").cast("string")).alias("template_id"), F.concat(F.lit("#"), (n % 1777).cast("string")).alias("contract_id"))


def archive(spark, rows=200, **kw):
    return Archive(spark, scratch(spark, "t-archive"), SCHEMA, file_rows=rows, **kw)


def offset(n):
    return f"{n * 10:018d}"


def test_a_range_opens_its_own_files_only(spark):
    a = archive(spark, 100)
    a.append(events(spark, 0, 10_000))
    files = a.index().count()
    assert 90 <= files <= 110
    out = a.replay(offset(4_999), offset(5_099))  # one hundredth
    assert sorted(r.event_id for r in out.collect()) == list(range(5_000, 5_100))
    assert len(out.inputFiles()) <= 3
    assert a.replay(offset(20_000)).collect() == [] and a.replay(None, "").collect() == []
    assert a.replay().count() == 10_000


def test_filters_skip_files_and_lose_no_event(spark):
    a = archive(spark, 500, indexed=("template_id", "contract_id"))
    a.append(events(spark, 0, 10_000))
    out = a.replay(having={"template_id": ["T3"]})
    assert out.count() == 1000 and len(out.inputFiles()) <= 4
    for c in ("#0", "#5", "#1776"):
        want = [n for n in range(10_000) if n % 1777 == int(c[1:])]
        got = a.replay(having={"contract_id": [c]})
        assert sorted(r.event_id for r in got.collect()) == want
        assert len(got.inputFiles()) <= len(want) + 2
    assert a.replay(offset(0), offset(100), {"template_id": ["T3"]}).collect() == []
    assert a.replay(having={"contract_id": ["#99999", "nothing"]}).count() == 0
    with pytest.raises(ValueError):
        a.replay(having={"event_id": [1]})


def test_filter_bits_are_sorted_as_numbers(spark):
    a = archive(spark, 500, indexed=("template_id", "contract_id"))
    a.append(events(spark, 0, 2_000))
    placed = spark.read.schema(SCHEMA).parquet(f"{a.root}/data/append=0").withColumn("file", F.col("_metadata.file_path"))
    plan = a._filters(placed)._jdf.queryExecution().sparkPlan().toString()
    sorts = [line for line in plan.splitlines() if "bitmap_construct_agg" in line]
    assert sorts and all("keys=[_file" in line or "key=[_file" in line for line in sorts)  # an int, not a path in every bit


def test_appends_follow_each_other_and_are_all_or_nothing(spark):
    a = archive(spark)
    assert a.append(events(spark, 0, 0)) == -1 and a.replay().count() == 0
    assert a.append(events(spark, 0, 500)) == 0
    with pytest.raises(OutOfOrder):
        a.append(events(spark, 499, 600))
    events(spark, 500, 600).write.parquet(f"{a.root}/data/append=1")  # an append that died before its index
    assert a.replay().count() == 500
    assert a.append(events(spark, 500, 700)) == 1
    assert [r.event_id for r in a.replay().orderBy("ledger_offset").collect()] == list(range(700))


POLLED = SCHEMA + ", page bigint, cursor string"


def read_all(spark, a, out, ck, fail_before=None, **kw):
    def write(df, batch_id):
        if batch_id == fail_before:
            raise RuntimeError("planned")
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    drain(polled(a, POLLED, **kw).writeStream.foreachBatch(write).option("checkpointLocation", ck))


def test_polls_from_a_stored_offset_with_a_stop_and_an_append(spark):
    a = archive(spark, 130)  # pages lie across files
    a.append(events(spark, 0, 1_000))
    out, ck = scratch(spark, "t-poll"), scratch(spark, "t-poll-ckpt")
    kw = {"start": offset(99), "pages_per_batch": 3}
    with pytest.raises(StreamingQueryException):
        read_all(spark, a, out, ck, fail_before=2, **kw)
    assert spark.read.parquet(out).count() == 600
    read_all(spark, a, out, ck, **kw)
    read_all(spark, a, out, ck, **kw)  # nothing new: nothing again
    got = {r.event_id: (r.page, r.cursor, r.batch) for r in spark.read.parquet(out).collect()}
    assert got == {n: ((n - 100) // 100, offset(min(n - n % 100 + 99, 999)), (n - 100) // 300) for n in range(100, 1_000)}
    a.append(events(spark, 1_000, 1_250))
    read_all(spark, a, out, ck, **kw)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.event_id for r in rows) == list(range(100, 1_250))
    assert {r.event_id: r.page for r in rows} == {n: (n - 100) // 100 for n in range(100, 1_250)}


def test_a_page_that_was_not_full_is_filled_up(spark):
    a = archive(spark, 64)
    a.append(events(spark, 0, 250))
    out, ck = scratch(spark, "t-fill"), scratch(spark, "t-fill-ckpt")
    read_all(spark, a, out, ck, pages_per_batch=2)
    a.append(events(spark, 250, 520))
    read_all(spark, a, out, ck, pages_per_batch=2)
    rows = spark.read.parquet(out).collect()
    assert {r.event_id: r.page for r in rows} == {n: n // 100 for n in range(520)} and len(rows) == 520
    assert {r.cursor for r in rows if r.page == 2} == {offset(249), offset(299)}


def test_a_backlog_is_read_in_growing_batches(spark):
    a = archive(spark, 130)
    a.append(events(spark, 0, 2_030))
    out, ck = scratch(spark, "t-backlog"), scratch(spark, "t-backlog-ckpt")
    kw = {"pages_per_batch": 1, "most_pages": 8}
    with pytest.raises(StreamingQueryException):
        read_all(spark, a, out, ck, fail_before=3, **kw)
    assert spark.read.parquet(out).count() == 700
    read_all(spark, a, out, ck, **kw)
    rows = spark.read.parquet(out).collect()
    ends = [100, 300, 700, 1_500, 2_030]  # 1, 2, 4, 8 polls, and what is left
    assert sorted((r.event_id, r.page, r.batch) for r in rows) == [(n, n // 100, sum(n >= e for e in ends)) for n in range(2_030)]
    assert {(r.page, r.cursor) for r in rows} == {(p, offset(min(p * 100 + 99, 2_029))) for p in range(21)}


def test_the_registered_streams_take_a_backlog_in_few_batches(spark, monkeypatch):
    from ledgerlane.plans import streams as S
    polls = []
    monkeypatch.setattr(S, "polled", lambda *args, **kw: polls.append(kw) or polled(*args, **kw))
    for name in ("dead_letter_batches", "transactional_batches", "resume_stream", "latest_feed_stream"):
        S.__dict__[name](spark, SF001)
    assert polls and all(kw["most_pages"] >= 100 * kw["pages_per_batch"] for kw in polls)


IDS = "event_id bigint, v bigint"


def test_dedupe_state_stays_flat_and_any_replay_is_dropped(spark):
    sink = DedupeSink(spark, scratch(spark, "t-dedupe"), "event_id", "event_id", IDS, width=50)
    opened = []
    batch = spark.range(0, 2_000).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("v"))
    for i in range(20):  # each batch ends inside a bucket that the next one goes on with
        here = batch.filter((F.col("event_id") >= i * 70) & (F.col("event_id") < i * 70 + 70))
        sink(here.unionByName(here.filter("event_id % 10 = 0")), i)  # copies inside the batch
        opened.append(len(sink.seen.opened))
    assert max(opened) <= 1  # new events open no bucket, but for a false answer of a filter
    sink(batch.filter("event_id < 1400 AND event_id % 97 = 0"), 20)  # a replay of all ages
    assert len(sink.seen.opened) == 15  # 0, 97, ..., 1358: each in a bucket of its own
    sink(batch.filter("event_id >= 1390 AND event_id < 1410"), 21)
    assert sorted(r.event_id for r in sink.written(spark).collect()) == list(range(1_410))


def test_a_dedupe_batch_that_died_is_tried_again_whole(spark, monkeypatch):
    sink = DedupeSink(spark, scratch(spark, "t-dedupe-crash"), "event_id", "event_id", IDS, width=50)
    rows = spark.range(0, 100).select(F.col("id").alias("event_id"), F.lit(1).cast("bigint").alias("v"))
    sink(rows.filter("event_id < 60"), 0)
    commit = sink.seen.commit

    def dies(df, batch_id):
        commit(df, batch_id)
        raise RuntimeError("planned")
    monkeypatch.setattr(sink.seen, "commit", dies)
    with pytest.raises(RuntimeError):
        sink(rows.filter("event_id >= 40"), 1)
    monkeypatch.setattr(sink.seen, "commit", commit)
    sink(rows.filter("event_id >= 40"), 1)  # its own ids don't hide its own rows
    assert sorted(r.event_id for r in sink.written(spark).collect()) == list(range(100))
    sink(rows.limit(0), 2)
    sink(rows, 3)
    assert sink.written(spark).count() == 100


@pytest.mark.parametrize("cuts", [1, 5, 23])
def test_batches_are_the_same_however_the_stream_is_cut(spark, cuts):
    n = 1_150
    slow = F.when(F.col("id") % 10 < 7, F.lit("busy")).when(F.col("id") < 300, F.lit("ends early")).otherwise(F.lit("slow"))
    rows = spark.range(0, n).select(F.lpad((F.col("id") * 3).cast("string"), 18, "0").alias("ledger_offset"), slow.alias("topic")).persist()
    arrival = F.col("ledger_offset").cast("bigint")
    sink = OpenBatches(scratch(spark, "t-open"), "topic", arrival, 1_000, size=20)
    step = -(-n // cuts)
    for i in range(cuts):
        part = rows.filter((arrival >= i * step * 3) & (arrival < (i + 1) * step * 3))
        sink(part, i)
        if i == cuts // 2:
            sink(part, i)  # a micro-batch that is tried again
    want = batch_manifest(assign_batches(rows, "topic", size=20, arrival_ms=arrival, within_ms=1_000), "topic")
    got = sink.manifest(spark).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert read_or_empty(spark, f"{sink.root}/tail/version={sink.last % 2}", "stream string").count() <= 3  # a row per stream
