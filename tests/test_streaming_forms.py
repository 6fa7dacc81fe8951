"""Operators marked S in SURVEY §2 run on a streaming DataFrame and equal their batch form."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlane.functions import filters as X
from ledgerlane.functions.columns import contract_abbrev, template_short
from ledgerlane.operators import encode as E
from ledgerlane.operators import route as R
from ledgerlane.plans.filtering import HANDLERS, SUBSCRIPTIONS
from ledgerlane.session import scratch
from ledgerlane.sources.documents import parse_documents, transaction_documents
from ledgerlane.sources.ledger import PAYLOAD_TAGS, flat_events_from_orders, flat_ledger
from ledgerlane.sources.tables import table
from ledgerlane.streaming.sources import file_stream, run_to_end
from tests.arrival import stage_files
from tests.conftest import SF001


def _stateless(df, spark):
    """A chain of stateless operators: filter algebra, routing, encoders, record keys."""
    ctx = X.TypedPayload("payload", df.schema["payload"].dataType, PAYLOAD_TAGS)
    f = X.Or((X.And((X.ByTemplate(frozenset({"Main:Iou", "Main:Asset"})),
                     X.ByArgument(("deal", "amount"), X.NumericGt(Decimal("100000"))))),
              X.Not(X.ByArgument(("deal", "status"), X.TextIs("F")))))
    routed = R.route_topic(df.filter(X.compile_filter(f, ctx) | X.subscription(SUBSCRIPTIONS)), R.routing_table(spark))
    handlers = F.broadcast(spark.createDataFrame(HANDLERS, "handler string, on_type string"))
    out = routed.select(
        "event_id", "topic", E.flat_json(routed).alias("flat"), E.snake_json(routed).alias("snake"),
        E.meta_json(routed).alias("meta"), R.partition_key("payload-field", "issuer").alias("pk"),
        R.prefix_topic().alias("prefix_topic"), template_short("template_id").alias("short"),
        contract_abbrev("contract_id").alias("abbrev"), X.visible_to("Nation5").alias("vis"),
        R.render_headers(R.with_static_headers(R.kafka_headers({"templateId": F.col("template_id")}),
                                               {"source": "ledger"})).alias("headers"),
        F.explode(F.array("event_type", F.lit("*"))).alias("on_type"))
    return out.join(handlers, "on_type").drop("on_type")


def test_stateless_operators_stream_equals_batch(spark):
    orders = table(spark, SF001, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                  "o_orderdate", "o_orderpriority")
    d = scratch(spark, "t-orders")
    stage_files(orders, "o_orderkey", d, n=3)
    stream = _stateless(flat_events_from_orders(file_stream(spark, d, orders.schema)), spark)
    out, ck = scratch(spark, "t-s-out"), scratch(spark, "t-s-ck")
    run_to_end(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck))
    got = spark.read.parquet(out)
    want = _stateless(flat_ledger(spark, SF001), spark)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_parser_on_a_stream(spark):
    docs = transaction_documents(flat_ledger(spark, SF001)).withColumn(
        "tx", F.substring("transaction_id", 4, 20).cast("bigint"))
    d = scratch(spark, "t-docs")
    stage_files(docs, "tx", d, n=2)
    parsed = parse_documents(file_stream(spark, d, docs.schema))
    out, ck = scratch(spark, "t-p-out"), scratch(spark, "t-p-ck")
    run_to_end(parsed.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck))
    got = spark.read.parquet(out)
    want = parse_documents(docs)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.filter(F.col("parse_error").isNotNull()).count() > 0


def test_counter_metric_on_a_stream(spark):
    """M1 as a streaming aggregation (complete mode) equals the batch counter."""
    from ledgerlane.operators.metrics import counter
    orders = table(spark, SF001, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                  "o_orderdate", "o_orderpriority")
    d = scratch(spark, "t-orders-m")
    stage_files(orders, "o_orderkey", d, n=3)
    ev = R.route_topic(flat_events_from_orders(file_stream(spark, d, orders.schema)), R.routing_table(spark))
    q = run_to_end(counter(ev, ["event_type", "topic"], "events").writeStream.outputMode("complete")
                   .format("memory").queryName("m1_stream").option("checkpointLocation", scratch(spark, "t-m-ck")))
    got = {(r.event_type, r.topic): r.events for r in spark.sql("SELECT * FROM m1_stream").collect()}
    want = {(r.event_type, r.topic): r.events for r in
            counter(R.route_topic(flat_ledger(spark, SF001), R.routing_table(spark)), ["event_type", "topic"],
                    "events").collect()}
    assert got == want and q.exception() is None
