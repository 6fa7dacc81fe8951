"""Registered queries: event filters and predicates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions import filters as X
from ledgerlane.functions.joins import small
from ledgerlane.operators.encode import payload_json
from ledgerlane.plans.oracle import with_ledger
from ledgerlane.plans.registry import register
from ledgerlane.sources.ledger import PAYLOAD_TAGS, ledger
from ledgerlane.sources.tables import table

OUT = ["event_id", "ledger_offset", "event_type", "template_id"]
OUT_SQL = "SELECT event_id, ledger_offset, event_type, template_id FROM ledger"


def typed(df: DataFrame) -> X.TypedPayload:
    return X.TypedPayload("payload", df.schema["payload"].dataType, PAYLOAD_TAGS)


def _apply(f: X.EventFilter):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = ledger(spark, sf_dir)
        return df.filter(X.compile_filter(f, typed(df))).select(*OUT)
    return q


def _reg(name: str, f: X.EventFilter, where: str):
    register(name, with_ledger(f"{OUT_SQL} WHERE {where}"))(_apply(f))


def arg(path: str, pred) -> X.ByArgument:
    return X.ByArgument(tuple(path.split(".")) if path else (), pred)


_reg("filter_accept_all", X.AcceptAll(), "true")
_reg("filter_reject_all", X.RejectAll(), "false")
_reg("filter_and",
     X.And((X.ByTemplate(frozenset({"Main:Iou", "Main:Asset"})),
            arg("deal.amount", X.NumericGt(Decimal("100000"))), X.And(()))),
     "template_id IN ('Main:Iou', 'Main:Asset') AND coalesce(amount > 100000, false)")
_reg("filter_or",
     X.Or((arg("deal.urgent", X.BoolIs(True)), X.ByTemplate(frozenset({"SupplyChain:Shipment"})), X.Or(()))),
     "coalesce(urgent, false) OR template_id = 'SupplyChain:Shipment'")
_reg("filter_not", X.Not(arg("deal.status", X.TextIs("F"))), "NOT coalesce(status = 'F', false)")
_reg("filter_by_template", X.ByTemplate(frozenset({"Token:Fungible", "Unknown:Template"})),
     "template_id IN ('Token:Fungible', 'Unknown:Template')")
_reg("filter_by_argument", arg("owner", X.PartyIs("Nation7")), "coalesce(owner = 'Nation7', false)")
_reg("pred_exists", X.And((arg("deal.priority", X.Exists()), X.Not(arg("deal.memo", X.Exists())))),
     "priority IS NOT NULL")
_reg("pred_equals",
     X.Or((X.And((arg("deal.status", X.IsEqualTo(X.TEXT, "O")), arg("deal.units", X.IsEqualTo(X.INT64, 7)))),
           arg("deal.amount", X.IsEqualTo(X.NUMERIC, "100000.0")),
           arg("issuer", X.IsEqualTo(X.TEXT, "Cust5")))),
     "coalesce(status = 'O' AND units = 7, false)")
_reg("pred_text_is", X.Or((arg("deal.status", X.TextIs("P")), arg("issuer", X.TextIs("Cust5")))),
     "coalesce(status = 'P', false)")
_reg("pred_party_is", X.Or((arg("issuer", X.PartyIs("Cust5")), arg("deal.status", X.PartyIs("P")))),
     "coalesce(issuer = 'Cust5', false)")
_reg("pred_numeric_gt", arg("deal.amount", X.NumericGt(Decimal("300000"))), "coalesce(amount > 300000, false)")
_reg("pred_numeric_lt", arg("deal.amount", X.NumericLt(Decimal("5000.5"))), "coalesce(amount < 5000.5, false)")
_reg("pred_int64_is", X.Or((arg("deal.units", X.Int64Is(42)), arg("deal.amount", X.Int64Is(42)))),
     "coalesce(units = 42, false)")
_reg("pred_bool_is", arg("deal.urgent", X.BoolIs(False)), "coalesce(NOT urgent, false)")




@register("extract_path", with_ledger(f"""
SELECT event_id, event_type, CAST(amount AS VARCHAR) AS amount_text, CAST(NULL AS VARCHAR) AS through_leaf,
       CAST(NULL AS VARCHAR) AS missing, CAST(units AS VARCHAR) AS units_text,
       CASE WHEN issuer IS NULL THEN NULL ELSE '{{"amount":' || CAST(amount AS VARCHAR) ||
         ',"status":"' || status || '","priority":"' || priority || '","urgent":' ||
         CASE WHEN urgent THEN 'true' ELSE 'false' END || ',"units":' || CAST(units AS VARCHAR) || '}}' END AS deal_json,
       CASE WHEN issuer IS NULL THEN NULL ELSE '{{"issuer":"' || issuer || '","owner":"' || owner || '","deal":{{"amount":' ||
         CAST(amount AS VARCHAR) || ',"status":"' || status || '","priority":"' || priority || '","urgent":' ||
         CASE WHEN urgent THEN 'true' ELSE 'false' END || ',"units":' || CAST(units AS VARCHAR) || '}}}}' END AS whole_record
FROM flat_ledger"""))
def extract_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 on the typed payload: leaf, path through a leaf, missing label, nested record, empty path (the whole record)."""
    from ledgerlane.sources.ledger import flat_ledger
    df = flat_ledger(spark, sf_dir)
    p = typed(df)
    return df.select(
        "event_id", "event_type",
        X.extract_value(p, ("deal", "amount")).alias("amount_text"),
        X.extract_value(p, ("issuer", "x")).alias("through_leaf"),
        X.extract_value(p, ("nope",)).alias("missing"),
        X.extract_value(p, ("deal", "units")).alias("units_text"),
        X.extract_value(p, ("deal",)).alias("deal_json"),
        X.extract_value(p, ()).alias("whole_record"),
    )


@register("filter_json_payload", with_ledger(f"""
SELECT event_id, event_type FROM flat_ledger
WHERE coalesce(amount > 250000 AND owner = 'Nation3', false) OR NOT coalesce(status = 'F', false)"""))
def filter_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7–F9 over Daml-JSON payload text (variant path, tags from the template schema)."""
    from ledgerlane.sources.ledger import flat_ledger
    df = flat_ledger(spark, sf_dir).select("event_id", "event_type", "template_id",
                                           payload_json("payload").alias("payload_json"))
    tags = {("issuer",): X.PARTY, ("owner",): X.PARTY, ("deal", "amount"): X.NUMERIC}
    ctx = X.JsonPayload("_payload_v", tags, parsed=True)
    f = X.Or((X.And((arg("deal.amount", X.NumericGt(Decimal(250000))), arg("owner", X.PartyIs("Nation3")))),
              X.Not(arg("deal.status", X.TextIs("F")))))
    return X.parse_payload_once(df, "payload_json").filter(X.compile_filter(f, ctx)).select("event_id", "event_type")


SUBSCRIPTIONS = [("Cust7", ["Main:Iou", "Main:Asset"]), ("Nation3", [])]


@register("subscribe", with_ledger(f"""{OUT_SQL}
WHERE ((signatory = 'Cust7' OR observer = 'Cust7') AND template_id IN ('Main:Iou', 'Main:Asset'))
   OR (signatory = 'Nation3' OR observer = 'Nation3')"""))
def subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """party × template-list subscription; several parties, empty list = all templates."""
    return ledger(spark, sf_dir).filter(X.subscription(SUBSCRIPTIONS)).select(*OUT)


# Fixed values for F11: which templates implement which interface.
INTERFACE_IMPLS = [("Token:Fungible", "Holding"), ("Main:Asset", "Holding"), ("Main:Iou", "Obligation")]


@register("filter_include_exclude", with_ledger(f"""{OUT_SQL}
WHERE (template_id IN ('Main:Iou') OR template_id IN ('Token:Fungible', 'Main:Asset'))
  AND template_id NOT IN ('Main:Asset')"""))
def filter_include_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """include by template or interface id, then exclude by template id.

    Interfaces resolve through a template→interface table (broadcast after a
    size check) joined on template id; the rest is a literal predicate.
    """
    include_t, include_i, exclude_t = ["Main:Iou"], ["Holding"], ["Main:Asset"]
    impl = spark.createDataFrame(INTERFACE_IMPLS, "template_id string, interface_id string")
    via_iface = small(impl.filter(F.col("interface_id").isin(include_i))
                      .select("template_id").distinct().withColumn("_iface", F.lit(True)), len(INTERFACE_IMPLS))
    df = ledger(spark, sf_dir).join(via_iface, "template_id", "left")
    keep = (F.col("template_id").isin(include_t) | F.coalesce(F.col("_iface"), F.lit(False))) \
        & ~F.coalesce(F.col("template_id").isin(exclude_t), F.lit(False))
    return df.filter(keep).select(*OUT)


@register("template_match", with_ledger(f"{OUT_SQL} WHERE template_id IN ('Main:Iou', 'SupplyChain:Shipment')"))
def template_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """match template ids regardless of a package-hash prefix."""
    f = X.ByTemplate(frozenset({"1220abcd:Main:Iou", "pkg-9f3e:SupplyChain:Shipment"}), hash_agnostic=True)
    df = ledger(spark, sf_dir)
    return df.filter(X.compile_filter(f, typed(df))).select(*OUT)


@register("visible_to_party", with_ledger(f"{OUT_SQL} WHERE signatory = 'Nation5' OR observer = 'Nation5'"))
def visible_to_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    """only events where the party is a stakeholder."""
    return ledger(spark, sf_dir).filter(X.visible_to("Nation5")).select(*OUT)


# Fixed values for F14: handlers registered per event type; '*' sees every event.
HANDLERS = [("audit", "*"), ("ui", "created"), ("ui", "archived"), ("settle", "exercised")]


@register("dispatch_by_type", with_ledger("""
SELECT event_id, event_type, h.handler FROM ledger l
JOIN (VALUES ('audit', '*'), ('ui', 'created'), ('ui', 'archived'), ('settle', 'exercised')) h(handler, on_type)
  ON h.on_type = l.event_type OR h.on_type = '*'"""))
def dispatch_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """each event goes to the handlers of its type and to every '*' handler."""
    h = small(spark.createDataFrame(HANDLERS, "handler string, on_type string"), len(HANDLERS))
    ev = ledger(spark, sf_dir).select("event_id", "event_type",
                                      F.explode(F.array("event_type", F.lit("*"))).alias("on_type"))
    return ev.join(h, "on_type").select("event_id", "event_type", "handler")


# Sets that grow with the tables: an id for every order besides two real ones, and the parties of customers in credit.
_SETS = """big(template_id) AS (SELECT 'Generated:T' || CAST(o_orderkey AS VARCHAR) FROM orders UNION ALL VALUES ('Main:Iou'), ('Token:Fungible')),
blocked(template_id) AS (SELECT 'Blocked:T' || CAST(o_orderkey AS VARCHAR) FROM orders UNION ALL VALUES ('Token:Fungible')),
credit(party) AS (SELECT 'Cust' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 5000)"""


@register("filter_large_sets", with_ledger(f"""{OUT_SQL}
WHERE (template_id IN (SELECT template_id FROM big) OR signatory IN (SELECT party FROM credit) OR observer IN (SELECT party FROM credit))
  AND template_id NOT IN (SELECT template_id FROM blocked)""", _SETS))
def filter_large_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, F13 over tables: ``And``, ``Or`` and ``Not`` over sets as large as the orders and customers, joined and not listed."""
    def ids(prefix: str, *real: str) -> DataFrame:
        made = table(spark, sf_dir, "orders").select(F.concat(F.lit(f"{prefix}:T"), F.col("o_orderkey").cast("string")).alias("template_id"))
        return made.unionByName(spark.createDataFrame([(t,) for t in real], "template_id string"))
    credit = table(spark, sf_dir, "customer").filter("c_acctbal > 5000").select(F.concat(F.lit("Cust"), F.col("c_custkey").cast("string")).alias("party"))
    df = ledger(spark, sf_dir)
    f = X.And((X.Or((X.TemplateIn(ids("Generated", "Main:Iou", "Token:Fungible")), X.StakeholderIn(credit))), X.Not(X.TemplateIn(ids("Blocked", "Token:Fungible")))))
    return X.apply_filter(df, f, typed(df)).select(*OUT)


@register("subscribe_table", with_ledger(f"""{OUT_SQL} WHERE EXISTS (SELECT 1 FROM subs WHERE (party = signatory OR party = observer) AND (subs.template_id IS NULL OR subs.template_id = ledger.template_id))""",
    """subs AS (SELECT 'Cust' || CAST(c_custkey AS VARCHAR) AS party, CASE c_custkey % 4 WHEN 0 THEN 'Main:Iou' WHEN 1 THEN 'Main:Asset' WHEN 2 THEN 'None:Such' END AS template_id
FROM customer WHERE c_custkey % 3 = 0)"""))
def subscribe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 over a subscription table, a row for every third customer; some want one template, some all."""
    c = F.col("c_custkey")
    wanted = F.when(c % 4 == 0, "Main:Iou").when(c % 4 == 1, "Main:Asset").when(c % 4 == 2, "None:Such")
    subs = table(spark, sf_dir, "customer").filter(c % 3 == 0).select(F.concat(F.lit("Cust"), c.cast("string")).alias("party"), wanted.alias("template_id"))
    return X.subscribed(ledger(spark, sf_dir), subs).select(*OUT)


@register("pred_numeric_exponent", with_ledger("""
SELECT event_id, ledger_offset, event_type, template_id FROM flat_ledger WHERE event_type = 'created' AND CAST(substr(contract_id, 2, length(contract_id) - 3) AS BIGINT) % 4 IN (0, 3)"""))
def pred_numeric_exponent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9e, F9f on numbers in exponent form: beyond every decimal type, below it, with spaces, and plain."""
    from ledgerlane.sources.ledger import flat_ledger
    df = flat_ledger(spark, sf_dir).filter("event_type = 'created'")
    key = F.expr("CAST(substr(contract_id, 2, length(contract_id) - 3) AS BIGINT)")
    amount = F.when(key % 4 == 0, F.concat(key.cast("string"), F.lit("1E400"))).when(key % 4 == 1, F.concat(F.lit("1"), key.cast("string"), F.lit("e-300"))).when(key % 4 == 2, " 7 ").otherwise("20E-1")
    df = df.withColumn("doc", F.to_json(F.struct(amount.alias("amount"))))
    f = X.And((arg("amount", X.NumericGt(Decimal("1"))), X.Not(arg("amount", X.NumericLt(Decimal("2"))))))
    return X.parse_payload_once(df, "doc").filter(X.compile_filter(f, X.JsonPayload("_payload_v", {("amount",): X.NUMERIC}, parsed=True))).select(*OUT)
