"""Unit checks of individual operators on small hand-made frames."""

import pytest
from pyspark.sql import functions as F

from ledgerlane.operators import encode as E
from ledgerlane.operators import metrics as M
from ledgerlane.operators import route as R
from ledgerlane.streaming import retry as RT


def test_kinesis_partition_key_needs_a_string_field(spark):
    df = spark.createDataFrame([("e1", '{"type":"transaction","event":{"eventId":"e1","workflowId":"wf","n":5}}')],
                               "event_id string, doc string")
    pk = lambda f: F.coalesce(R.top_level_string(F.col("doc"), "$.event", f), F.col("event_id"))
    r = df.select(pk("workflowId").alias("a"), pk("n").alias("b"), pk("transactionId").alias("c")).first()
    assert (r.a, r.b, r.c) == ("wf", "e1", "e1")  # a number is not a string key; a missing field falls back


def test_pack_requests_500_per_stream(spark):
    df = spark.range(0, 1203).select(F.lpad(F.col("id").cast("string"), 18, "0").alias("ledger_offset"),
                                     F.when(F.col("id") < 1001, "a").otherwise("b").alias("topic"))
    got = {(r.topic, r.request_no): r.n for r in
           R.pack_requests(df, "topic").groupBy("topic", "request_no").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", 0): 500, ("a", 1): 500, ("a", 2): 1, ("b", 0): 202}


def test_backoff_waits():
    b = RT.Backoff(initial_ms=100, factor=2.0, max_ms=1000, max_attempts=5)
    assert [b.wait_ms(j) for j in range(1, 5)] == [200, 400, 800, 1000]  # first wait is initial * factor


def test_retry_columns(spark):
    b = RT.Backoff()
    df = spark.createDataFrame([("TimeoutException", 2), ("TimeoutException", 9), ("RecordTooLargeException", 1),
                                (None, 0)], "err string, f int")
    rows = df.select(RT.attempts(F.col("err"), F.col("f"), b).alias("a"),
                     RT.total_wait_ms(RT.attempts(F.col("err"), F.col("f"), b), b).alias("w"),
                     RT.outcome(F.col("err"), F.col("f"), b).alias("o")).collect()
    assert [(r.a, r.w, r.o) for r in rows] == [(3, 600, "delivered"), (5, 2400, "dead_letter"),
                                               (1, 0, "dead_letter"), (1, 0, "delivered")]


def test_last_offset_gauge_skips_unparseable(spark):
    df = spark.createDataFrame([("s", "offset-10", 1), ("s", "1.2.3", 2), ("t", "abc", 1)],
                               "sub string, off string, seq int")
    got = {r.sub: r.last_offset for r in M.last_offset_gauge(df, ["sub"], "off", "seq").collect()}
    assert got == {"s": 10.0}


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(0.05,), (0.3,), (2.0,), (400.0,)], "v double")
    rows = {r.le: (r.cumulative_count, r.sample_count, r.sample_sum) for r in
            M.histogram(df, "v", M.LAG_BUCKETS).collect()}
    assert rows["0.1"][0] == 1 and rows["0.5"][0] == 2 and rows["2.5"][0] == 3 and rows["300.0"][0] == 3
    assert rows["+Inf"] == (4, 4, 402.35)


def test_envelope_roundtrip_and_bad_tags(spark):
    ev = spark.createDataFrame(
        [("tr-1", "000000000000000001", "000000000000000010", "created", "#1:0", "Main:Iou"),
         ("tr-1", "000000000000000001", "000000000000000019", "archived", "#1:0", "Main:Iou")],
        "transaction_id string, tx_offset string, ledger_offset string, event_type string, contract_id string, "
        "template_id string").withColumn("payload", F.lit(None).cast(
            "struct<issuer:string,owner:string,deal:struct<amount:decimal(15,2),status:string,priority:string,"
            "urgent:boolean,units:bigint>>"))
    env = E.tx_envelopes(ev)
    text = env.first().envelope
    assert text.startswith('{"type":"transaction","event":{"eventId":"tr-1","workflowId":"wf-1"')
    assert '"contractEvents":[{"type":"created","event":{"templateId":"Main:Iou","contractId":"#1:0"}}' in text
    dec = E.decode_envelopes(env).orderBy("idx").collect()
    assert [(r.idx, r.event_type, r.decode_error) for r in dec] == [(0, "created", None), (1, "archived", None)]
    bad = env.withColumn("envelope", F.regexp_replace("envelope", '"type":"archived"', '"type":"divulged"'))
    assert [r.decode_error for r in E.decode_envelopes(bad).collect()] == ["ContractEvent expected"]
    top = env.withColumn("envelope", F.regexp_replace("envelope", '^\\{"type":"transaction"', '{"type":"x"'))
    assert [r.decode_error for r in E.decode_envelopes(top).collect()] == ["LedgerEvent expected"]


def _hot_events(spark, n=2500, hot=2300):
    """Archived events, most of them of one transaction whose offsets span 30 values only."""
    return spark.range(0, n).select(
        F.when(F.col("id") < hot, F.lit("tr-3")).otherwise(F.concat(F.lit("tr-"), (F.col("id") * 97 + 1).cast("string")))
        .alias("transaction_id"),
        F.lit("000000000000000003").alias("tx_offset"),
        F.lpad((F.col("id") % 30).cast("string"), 18, "0").alias("ledger_offset"),
        F.lit("archived").alias("event_type"), F.concat(F.lit("e"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("event_id"),
        F.lit("#1:0").alias("contract_id"), F.lit("Main:Iou").alias("template_id"),
        F.lit(None).cast("string").alias("choice"), F.lit(None).cast("timestamp_ntz").alias("record_time"),
        F.lit(None).cast("struct<issuer:string,owner:string,deal:struct<amount:decimal(15,2),status:string,"
                         "priority:string,urgent:boolean,units:bigint>>").alias("payload"))


@pytest.mark.parametrize("part", [None, 1000, 7])
def test_part_size_changes_no_event(spark, part):
    """Events and positions of a hot transaction don't depend on how its document is cut."""
    from ledgerlane.sources.documents import parse_documents, transaction_documents
    docs = transaction_documents(_hot_events(spark), max_events=part)
    of_hot = docs.filter(F.col("transaction_id") == "tr-3")
    assert of_hot.count() == (1 if part is None else -(-2300 // part))
    back = parse_documents(docs)
    assert back.count() == 2500 and back.select("event_id").distinct().count() == 2500
    hot = [(r.idx, r.event_id) for r in back.filter(F.col("transaction_id") == "tr-3").collect()]
    assert sorted(i for i, _ in hot) == list(range(2300))
    if part is not None:  # numbered by (offset, choice, event id)
        want = sorted((f"e{i:05d}" for i in range(2300)), key=lambda e: (int(e[1:]) % 30, e))
        assert [e for _, e in sorted(hot)] == want


@pytest.mark.parametrize("part", [None, 10])
def test_a_broken_transaction_fails_once(spark, part):
    from ledgerlane.sources.documents import parse_failures, transaction_documents
    ev = _hot_events(spark, 60, 60).withColumn("transaction_id", F.lit("tr-97"))
    rows = parse_failures(transaction_documents(ev, max_events=part)).collect()
    assert [(r.transaction_id, r.parse_error) for r in rows] == [("tr-97", "malformed transaction document")]


def test_hot_transaction_is_numbered_by_many_tasks(spark):
    """No task numbers the whole of a transaction that holds most rows."""
    from ledgerlane.operators.sequence import number_rows_ranged
    ev = _hot_events(spark)
    got = number_rows_ranged(ev, ["transaction_id"], ["ledger_offset", "event_id"], "rn", partitions=20)
    hot = [r.rn for r in got.filter(F.col("transaction_id") == "tr-3").collect()]
    assert sorted(hot) == list(range(1, 2301))
    placed = spark.read.parquet(got.inputFiles()[0].rsplit("/", 1)[0])
    sizes = [r["count"] for r in placed.filter(F.col("transaction_id") == "tr-3").groupBy("_pid").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 400


def test_envelope_holds_the_whole_transaction(spark):
    env = E.tx_envelopes(_hot_events(spark)).filter(F.col("transaction_id") == "tr-3").collect()
    assert len(env) == 1 and env[0].envelope.count('"type":"archived"') == 2300 and '"part"' not in env[0].envelope


@pytest.mark.parametrize("value,threshold,sign", [
    ("1.00000000001", "1", 1), ("1" * 35, "1", 1), ("0.99", "1", -1), ("-5", "1", -1), ("-5", "-4.5", -1), ("-5", "-5.00", 0), ("007.10", "7.1", 0),
    ("0", "-0.0", 0), ("-0.0", "0", 0), ("+3", "2", 1), ("10", "9", 1), ("9", "10", -1), (".5", "0.5", 0), ("1e3", "999", 1), ("x", "1", None),
    (None, "1", None), ("", "1", None), ("1" * 60 + ".1", "1" * 60, 1), ("2", "-3", 1)])
def test_decimals_compare_exactly(spark, value, threshold, sign):
    from ledgerlane.functions.filters import compare_decimal
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(compare_decimal(F.col("v"), threshold)).first()[0] == sign


def test_schema_rows_of_changing_documents(spark):
    from ledgerlane.operators import schemas as SC
    rows = [("t", True, '{"a":1,"b":{"c":"x","odd name":true}}'), ("t", True, '{"a":2}'), ("t", False, '{"a":"2","b":{"d":[1,2]}}'), ("u", False, '{"a":1}'),
            ("u", False, None)]
    df = spark.createDataFrame(rows, "t string, old boolean, doc string")
    got = {(r.t, r.path): (r.old_type, r.new_type, r.change) for r in SC.schema_changes(df, "t", "old", "doc").collect()}
    assert got == {("t", "a"): ("BIGINT", "STRING", "retyped"), ("t", "b.c"): ("STRING", None, "removed"), ("t", "b.odd name"): ("BOOLEAN", None, "removed"),
                   ("t", "b.d"): (None, "ARRAY<BIGINT>", "added"), ("u", "a"): (None, "BIGINT", "added")}
    assert SC.field_types(df.limit(0), ["t"], "doc").collect() == []


def test_delivery_report_counts_disorder_inside_and_across_partitions(spark):
    """L2 check: violations inside a partition and at a partition edge; keys spanning partitions count once."""
    from ledgerlane.operators.feed import delivery_report
    rows = [  # (partition, topic, contract, offset) in delivery order
        (0, "t", "a", 1), (0, "t", "a", 3), (0, "t", "b", 5), (0, "t", "b", 4),   # b: 5 then 4 → 1 bad
        (1, "t", "b", 2), (1, "t", "c", 1), (1, "u", "x", 7),                      # b continues: 4 then 2 → 1 bad
        (2, "u", "x", 8), (2, "u", "y", 1)]                                          # x continues in order
    # keep the given order inside each partition: sort on the position in the list
    pos = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                "i int, p int, topic string, contract_id string, ledger_offset long")
    df = pos.repartitionByRange(3, "p").sortWithinPartitions("i").drop("i", "p")
    assert sorted(set(r[0] for r in df.select(F.spark_partition_id()).collect())) == [0, 1, 2]
    got = {r.topic: (r.events, r["keys"], r.out_of_order) for r in delivery_report(df, ["topic", "contract_id"]).collect()}
    assert got == {"t": (6, 3, 2), "u": (3, 2, 0)}


def test_delivery_report_counts_unrouted_events(spark):
    from ledgerlane.operators.feed import delivery_report
    df = spark.createDataFrame([("t", "a", 1), (None, "a", 2), (None, "a", 1), (None, None, 3)], "topic string, contract_id string, ledger_offset long").coalesce(1)
    got = {r.topic: (r.events, r["keys"], r.out_of_order) for r in delivery_report(df, ["topic", "contract_id"]).collect()}
    assert got == {"t": (1, 1, 0), None: (3, 2, 1)}


def test_prefix_topic_dots(spark):
    """K2: a prefix keeps its dots, a module's become dashes."""
    rows = [("Main:Iou",), ("pkg:Daml.Finance.Holding:Base",), ("A.B:C.D",)]
    df = spark.createDataFrame(rows, "template_id string")
    got = [r[0] for r in df.select(R.prefix_topic(prefix="canton.ledger.events")).collect()]
    assert got == ["canton.ledger.events.Main.Iou", "canton.ledger.events.Daml-Finance-Holding.Base", "canton.ledger.events.A-B.C.D"]


def test_batches_close_by_size_or_time(spark):
    """ST3: a batch ends at its size or its time limit, whichever comes first."""
    from ledgerlane.operators.batching import assign_batches, batch_manifest
    at = [0, 1, 2, 3, 4, 10, 11, 25, 26, 27]
    df = spark.createDataFrame([("s", t) for t in at], "topic string, t long").withColumn("ledger_offset", F.lpad(F.col("t").cast("string"), 18, "0"))
    rows = batch_manifest(assign_batches(df, size=3, arrival_ms=F.col("t"), within_ms=10)).collect()
    assert sorted((r.slot, r.batch_no, r.events, int(r.first_offset)) for r in rows) == [(0, 0, 3, 0), (0, 1, 2, 3), (1, 0, 2, 10), (2, 0, 3, 25)]
    assert len(batch_manifest(assign_batches(df, size=3)).collect()) == 4


@pytest.mark.parametrize("size", [1, 7, 100, 5000])
def test_pages_of_any_size(spark, size):
    from ledgerlane.operators.batching import pages
    df = spark.range(0, 2000, 3).withColumnRenamed("id", "k")
    got = sorted((r.k, r.page, r.cursor) for r in pages(df, "k", size).collect())
    keys = list(range(0, 2000, 3))
    assert got == [(k, i // size, keys[min(i // size * size + size, len(keys)) - 1]) for i, k in enumerate(keys)]


def test_offsets_over_18_digits_are_kept_whole(spark):
    from ledgerlane.functions.columns import offset_of
    df = spark.createDataFrame([(5,), (9_223_372_036_854_775_807,)], "n long")
    assert [r[0] for r in df.select(offset_of("n")).collect()] == ["0" * 17 + "5", "9223372036854775807"]


def test_reconnects_across_chunks(spark):
    """Steps inside chunks and from one chunk to a later one, per key."""
    from ledgerlane.operators.metrics import transitions
    rows = [("a", o, s) for o, s in enumerate([0, 1, 1, 0, 0, 1, 0, 1])] + [("b", 0, 1), ("b", 50, 1), ("c", 3, 0), ("c", 90, 1)]
    df = spark.createDataFrame(rows, "k string, o long, s int")
    for width in (1, 2, 3, 100):
        got = {r.k: r.reconnects for r in transitions(df, "k", "s", "o", F.floor(F.col("o") / width)).collect()}
        assert got == {"a": 3, "b": 0, "c": 1}


def test_broadcast_only_within_rows_and_bytes(spark):
    from ledgerlane.functions.joins import small
    df = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 1000))
    hinted = lambda d: "UnresolvedHint" in d._jdf.queryExecution().logical().toString() or "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(small(df)) and not hinted(small(df, max_rows=99)) and not hinted(small(df, max_bytes=50_000))


def test_numeric_predicates_agree_with_decimals(spark):
    """The fast comparison and the exact one give one answer, on text and at the edges of what a decimal(38,10) holds."""
    from decimal import Decimal

    from ledgerlane.functions import filters as X
    values = ["1", "1.00000000001", "0.9999999999", "1" * 27, "1" * 28, "1" * 35, "-1" + "0" * 30, "-0.5", "x", "", "1.", ".5", "007", "1e2"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    number = lambda v: Decimal(v) if v not in ("x", "") else None
    tagged = X._Value(F.col("v"), X.NUMERIC, F.col("v"))
    for t in ("1", "0.99999999995", "1" * 30, "-0.25", "7"):
        for p, op in ((X.NumericGt, Decimal.__gt__), (X.NumericLt, Decimal.__lt__)):
            got = [r[0] for r in df.select(X._pred(p(Decimal(t)), tagged)).collect()]
            assert got == [n is not None and op(n, Decimal(t)) for n in map(number, values)], (t, p)
    typed = spark.sql("SELECT CAST(x AS DECIMAL(38,10)) AS v FROM VALUES ('1'), ('1.0000000001'), ('9999999999999999999999999999'), ('-3'), (NULL) AS t(x)")
    for t in ("1", "0.9999999999", "999999999999999999999999999"):
        rows = typed.select("v", X._pred(X.NumericGt(Decimal(t)), X._Value(F.col("v"), X.NUMERIC, F.col("v"), 10)).alias("up")).collect()
        assert [r.up for r in rows] == [r.v is not None and r.v > Decimal(t) for r in rows]
