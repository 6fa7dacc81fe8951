"""Routing (template → topic) and sink record shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions.joins import small

# Routing of the reference's router test, and its topic naming
# (default topic, static topic name, prefix of the prefix strategy).
ROUTES = [("Main:Iou", "iou-events"), ("Main:Asset", "asset-events")]
DEFAULT_TOPIC = "canton-events-default"
STATIC_TOPIC = "canton-ledger-events"
TOPIC_PREFIX = "canton"


def routing_table(spark: SparkSession, routes=ROUTES) -> DataFrame:
    return small(spark.createDataFrame(list(routes), "template_id string, topic string"), len(routes))


def route_topic(events: DataFrame, routes: DataFrame, default_topic: str | None = DEFAULT_TOPIC) -> DataFrame:
    """K1: topic by template, else the default, else null (unrouted).

    A left equi-join against the (broadcast, size-checked) routing table: a
    map-side hash lookup, no shuffle of the event side; works stream-static.
    """
    r = routes.select("template_id", F.col("topic").alias("_route"))
    out = events.join(r, "template_id", "left")
    return out.withColumn("topic", F.coalesce(F.col("_route"), F.lit(default_topic).cast("string"))).drop("_route")


def prefix_topic(template_col: str = "template_id", prefix: str = TOPIC_PREFIX) -> Column:
    """K2: ``<prefix>.<module>.<name>``; dots inside the module become dashes (the prefix keeps its dots)."""
    parts = F.split(F.col(template_col), ":")
    return F.concat_ws(".", F.lit(prefix), F.translate(F.element_at(parts, -2), ".", "-"), F.element_at(parts, -1))


def route_party_template(events: DataFrame, party_routes: DataFrame) -> DataFrame:
    """K3: destination per (party, template); one output row per matching stakeholder.

    Stakeholders are exploded (a few per event) and joined to the size-checked
    broadcast party-route table on the equi-key (party, template).
    """
    ev = events.select("*", F.explode(F.array_distinct(F.concat("signatories", "observers"))).alias("party"))
    return ev.join(party_routes, ["party", "template_id"])


def kafka_headers(pairs: dict[str, Column]) -> Column:
    """Kafka ``headers`` column: ``array<struct<key string, value binary>>``."""
    return F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in pairs.items()])


def with_static_headers(headers: Column, static: dict[str, str]) -> Column:
    """K6: append fixed headers to every record."""
    return F.concat(headers, kafka_headers({k: F.lit(v) for k, v in static.items()}))


def render_headers(headers: str | Column = "headers") -> Column:
    """Headers as text ``k=v;k=v`` (for display and comparison)."""
    h = F.col(headers) if isinstance(headers, str) else headers
    return F.array_join(F.transform(h, lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ";")


def top_level_string(doc: Column, obj_path: str, field: str) -> Column:
    """The JSON string at ``obj_path.field`` — only when it is a string (K8)."""
    v = F.try_variant_get(F.parse_json(doc), f"{obj_path}['{field}']", "variant")
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def partition_key(strategy: str, field: str | None = None) -> Column:
    """K9: record key by contract id or by a payload field (falling back to the contract id)."""
    if strategy == "contract-id":
        return F.col("contract_id")
    if strategy == "payload-field":
        return F.coalesce(F.col("payload").getField(field).cast("string"), F.col("contract_id"))
    raise ValueError(f"unknown partition key strategy {strategy}")


MAX_RECORDS_PER_REQUEST = 500  # Kinesis PutRecords limit


def pack_requests(records: DataFrame, stream_col: str, order_col: str = "ledger_offset",
                  max_records: int = MAX_RECORDS_PER_REQUEST) -> DataFrame:
    """Number requests of at most ``max_records`` records per stream, in offset order.

    Numbering is chunked by offset prefix (``number_rows``), so a hot stream
    is spread over many tasks instead of one.
    """
    from ledgerlane.operators.sequence import number_rows, offset_chunk
    n = number_rows(records, [stream_col], [F.col(order_col)], offset_chunk(order_col), "_rn")
    return n.withColumn("request_no", F.floor((F.col("_rn") - 1) / max_records).cast("bigint")).drop("_rn")


def partial_failures(results: DataFrame, keys: list[str], failed: str = "failed", error: str = "error_code",
                     order_col: str = "ledger_offset") -> DataFrame:
    """Per request: records, failed records and the first error (in offset order)."""
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(failed)).alias("failed"),
        F.min_by(F.when(F.col(failed), F.col(error)), F.when(F.col(failed), F.col(order_col))).alias("first_error"))


# The sink system behind each topic (default: kinesis).
DESTINATION_TYPES = [("iou-events", "kafka"), ("asset-events", "pulsar")]
DEFAULT_DESTINATION = "kinesis"


def destination_type(topic: str = "topic") -> Column:
    out = F.lit(DEFAULT_DESTINATION)
    for t, d in reversed(DESTINATION_TYPES):
        out = F.when(F.col(topic) == t, d).otherwise(out)
    return out


def pulsar_sequence(producer: str | None, offset: str = "ledger_offset") -> Column:
    """K7: a named producer's sequence id, which the broker deduplicates by; an unnamed one has none.

    It is the event's own offset, which is unique and grows along the flat
    stream however many events a transaction has.
    """
    return F.col(offset).cast("bigint") if producer else F.lit(None).cast("bigint")
