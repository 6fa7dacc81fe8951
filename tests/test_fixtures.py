"""Golden cases from the reference's own tests (FIXTURES.md part A)."""

# The documents, identifiers and values of these cases, as they must match.

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlane.functions import filters as X
from ledgerlane.operators import encode as E
from ledgerlane.operators import route as R
from ledgerlane.sources.documents import parse_documents

ONE_CREATED = ('{"offset":"0000000000000001","events":[{"created":{"eventId":"e1","contractId":"#1:0",'
               '"templateId":"Main:Iou","payload":{"issuer":"Alice","owner":"Bob","currency":"USD","amount":"100.00"}}}]}')
ANOTHER_CREATED = ('{"offset":"0000000000000002","events":[{"created":{"contractId":"#2:0","templateId":"Main:Asset",'
                   '"payload":{"isin":"US0378331005","quantity":"50"}}}]}')
ONE_ARCHIVED = ('{"offset":"0000000000000003","events":[{"archived":{"eventId":"e3","contractId":"#1:0",'
                '"templateId":"Main:Iou"}}]}')
UNKNOWN = ('{"offset":"0000000000000004","events":[{"created":{"contractId":"#4:0","templateId":"Unknown:Template",'
           '"payload":{}}}]}')
TWO = ('{"offset":"0000000000000005","events":[{"archived":{"contractId":"#3:0","templateId":"Main:Iou"}},'
       '{"created":{"contractId":"#5:0","templateId":"Main:Iou","payload":{"amount":"1"}}}]}')
MALFORMED = '{"events": [ {"created": "not_an_object"} ]}'
NO_EVENTS = '{"events": [], "offset": "0000000000000006"}'


def _parse(spark, docs, trees=False):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_no int, doc string")
    return parse_documents(df, trees=trees).orderBy("doc_no", "idx").collect()


def test_parser_cases(spark):
    rows = _parse(spark, [ONE_CREATED, ANOTHER_CREATED, ONE_ARCHIVED, UNKNOWN, TWO, MALFORMED, NO_EVENTS])
    by = {}
    for r in rows:
        by.setdefault(r.doc_no, []).append(r)
    c = by[0][0]
    assert (c.event_type, c.contract_id, c.template_id, c.offset) == ("created", "#1:0", "Main:Iou", "0000000000000001")
    assert F is not None and '"amount":"100.00"' in c.payload  # the amount stays text
    assert by[1][0].template_id == "Main:Asset"
    a = by[2][0]
    assert a.event_type == "archived" and a.payload is None
    assert [(r.event_type, r.contract_id, r.offset) for r in by[4]] == [
        ("archived", "#3:0", "0000000000000005"), ("created", "#5:0", "0000000000000005")]
    assert len(by[5]) == 1 and by[5][0].parse_error is not None and by[5][0].event_type is None
    assert 6 not in by  # no events: no rows and no failure


def test_created_wins_and_unknown_kinds_dropped(spark):
    doc = ('{"offset":"7","events":[{"created":{"contractId":"a","templateId":"T:X","payload":{}},'
           '"archived":{"contractId":"b","templateId":"T:X"}},{"divulged":{"contractId":"c"}},'
           '{"exercised":{"contractId":"d","templateId":"T:X","choice":"Increment"}}]}')
    flat = _parse(spark, [doc])
    assert [(r.event_type, r.contract_id) for r in flat] == [("created", "a")]
    tree = _parse(spark, [doc], trees=True)
    assert [(r.event_type, r.contract_id, r.choice) for r in tree] == [("created", "a", None),
                                                                        ("exercised", "d", "Increment")]


def test_routing(spark):
    ev = spark.createDataFrame([("Main:Iou",), ("Main:Asset",), ("Unknown:Template",)], "template_id string")
    routes = R.routing_table(spark)
    got = {r.template_id: r.topic for r in R.route_topic(ev, routes).collect()}
    assert got == {"Main:Iou": "iou-events", "Main:Asset": "asset-events", "Unknown:Template": "canton-events-default"}
    only_iou = R.routing_table(spark, [("Main:Iou", "iou-events")])
    got = {r.template_id: r.topic for r in R.route_topic(ev, only_iou, default_topic=None).collect()}
    assert got == {"Main:Iou": "iou-events", "Main:Asset": None, "Unknown:Template": None}


def test_flat_json_matches_reference_format(spark):
    df = spark.createDataFrame([("created", "offset-1", "tx-1", "cid-1", "tid", '{"field":"value"}'),
                                ("archived", "offset-11", "tx-1", "cid-1", "tid", None)],
                               "event_type string, ledger_offset string, transaction_id string, contract_id string, "
                               "template_id string, payload string")
    out = [r.v for r in df.select(E.flat_json(df, F.parse_json("payload")).alias("v")).collect()]
    assert out[0] == ('{"type":"created","offset":"offset-1","transactionId":"tx-1","contractId":"cid-1",'
                      '"templateId":"tid","payload":{"field":"value"}}')
    assert out[1] == '{"type":"archived","offset":"offset-11","transactionId":"tx-1","contractId":"cid-1","templateId":"tid"}'


def _payload_df(spark):
    schema = ("id int, template_id string, payload struct<issuer:string,deal:struct<amount:decimal(15,2),"
              "status:string,units:bigint,urgent:boolean>>")
    rows = [(1, "Main:Iou", ("Alice", (Decimal("100.00"), "F", 7, True))),
            (2, "Main:Iou", ("Bob", (Decimal("5.00"), None, None, False))),
            (3, "Main:Asset", None)]
    return spark.createDataFrame(rows, schema)


def _ids(df, f, ctx):
    return sorted(r.id for r in df.filter(X.compile_filter(f, ctx)).collect())


def test_filter_algebra_edge_cases(spark):
    df = _payload_df(spark)
    ctx = X.TypedPayload("payload", df.schema["payload"].dataType, {("issuer",): X.PARTY})
    assert _ids(df, X.And(()), ctx) == [1, 2, 3]
    assert _ids(df, X.Or(()), ctx) == []
    assert _ids(df, X.ByTemplate(frozenset()), ctx) == []
    missing = X.ByArgument(("deal", "nope"), X.Exists())
    assert _ids(df, missing, ctx) == []
    assert _ids(df, X.Not(missing), ctx) == [1, 2, 3]  # Not over a missing path is true
    through_leaf = X.ByArgument(("issuer", "x"), X.Exists())
    assert _ids(df, through_leaf, ctx) == []
    valueless = X.ByArgument(("deal", "status"), X.Exists())  # field present without value = none
    assert _ids(df, valueless, ctx) == [1]
    assert _ids(df, X.Not(X.ByArgument(("deal", "status"), X.TextIs("F"))), ctx) == [2, 3]
    assert _ids(df, X.ByArgument(("issuer",), X.TextIs("Alice")), ctx) == []  # Party is not Text
    assert _ids(df, X.ByArgument(("issuer",), X.PartyIs("Alice")), ctx) == [1]
    assert _ids(df, X.ByArgument(("deal", "amount"), X.NumericGt(Decimal("50"))), ctx) == [1]
    assert _ids(df, X.ByArgument(("deal", "amount"), X.IsEqualTo(X.NUMERIC, "100.00")), ctx) == [1]
    assert _ids(df, X.ByArgument(("deal", "amount"), X.IsEqualTo(X.NUMERIC, "100.0")), ctx) == []
    assert _ids(df, X.ByArgument(("deal", "units"), X.Int64Is(7)), ctx) == [1]
    assert _ids(df, X.ByArgument(("deal", "urgent"), X.BoolIs(False)), ctx) == [2]
    assert _ids(df, X.ByArgument((), X.Exists()), ctx) == [1, 2]  # empty path = whole record


def test_json_payload_filters(spark):
    rows = [(1, '{"owner":"Alice","deal":{"amount":"100.5","n":3,"ok":true,"memo":null}}'),
            (2, '{"owner":"Bob","deal":{"amount":"abc","n":"3"}}'),
            (3, '{"owner":"Carol","deal":7}')]
    df = spark.createDataFrame(rows, "id int, p string")
    ctx = X.JsonPayload("p", {("owner",): X.PARTY, ("deal", "amount"): X.NUMERIC})
    assert _ids(df, X.ByArgument(("deal", "amount"), X.NumericGt(Decimal(100))), ctx) == [1]  # "abc" → false
    assert _ids(df, X.ByArgument(("deal", "n"), X.Int64Is(3)), ctx) == [1]  # "3" is text, not Int64
    assert _ids(df, X.ByArgument(("deal", "memo"), X.Exists()), ctx) == []  # JSON null = no value
    assert _ids(df, X.ByArgument(("deal", "x"), X.Exists()), ctx) == []  # path through a non-record (row 3)
    assert _ids(df, X.ByArgument(("owner",), X.PartyIs("Bob")), ctx) == [2]
    assert _ids(df, X.Not(X.ByArgument(("deal", "ok"), X.BoolIs(True))), ctx) == [2, 3]
