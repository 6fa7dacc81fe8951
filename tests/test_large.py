"""Sets, schemas and offsets of any size and form."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlane.functions import filters as X
from ledgerlane.operators import schemas as SC


@pytest.fixture(scope="module")
def events(spark):
    rows = [(i, f"pkg{i % 2}:M:T{i % 7}" if i % 11 else None, [f"P{i % 5}"], [f"Q{i % 3}", "all"] if i % 4 else None) for i in range(200)]
    return spark.createDataFrame(rows, "id bigint, template_id string, signatories array<string>, observers array<string>").persist()


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_sets_as_tables_equal_sets_as_lists(spark, events):
    some = {"pkg0:M:T1", "pkg1:M:T2", "pkg0:M:T4"}
    many = frozenset(some | {f"no:M:N{i}" for i in range(3_000)})
    table = ids(spark, [*many, "pkg0:M:T1", None])  # repeated and null members
    forms = [(X.ByTemplate(many), X.TemplateIn(table)), (X.ByTemplate(frozenset(some), True), X.TemplateIn(ids(spark, some), True)),
             (X.ByTemplate(frozenset()), X.TemplateIn(ids(spark, [])))]
    for listed, joined in forms:
        for wrap in (lambda f: f, X.Not, lambda f: X.Or((X.Not(f), X.ByTemplate(frozenset({"pkg1:M:T3"})))), lambda f: X.And((f, X.Not(X.And((f, X.AcceptAll())))))):
            want = [r.id for r in events.filter(X.compile_filter(wrap(listed), None)).orderBy("id").collect()]
            got = X.apply_filter(events, wrap(joined), None)
            assert got.columns == events.columns and [r.id for r in got.orderBy("id").collect()] == want


def test_long_lists_are_not_in_the_plan(spark, events):
    many = frozenset(f"no:M:N{i}" for i in range(3_000)) | {"pkg0:M:T1"}
    plan = X.apply_filter(events, X.ByTemplate(many), None)._jdf.queryExecution().optimizedPlan().toString()
    assert "N2999" not in plan and " IN " not in plan and "INSET" not in plan


def test_party_tables_and_subscription_tables(spark, events):
    rows = events.collect()
    who = lambda r: set(r.signatories or []) | set(r.observers or [])
    got = X.apply_filter(events, X.Not(X.StakeholderIn(ids(spark, ["P1", "Q2", "nobody", "P1"]))), None)
    assert sorted(r.id for r in got.collect()) == [r.id for r in rows if not who(r) & {"P1", "Q2"}]
    subs = [("P1", None), ("Q0", "pkg0:M:T1"), ("Q0", "pkg1:M:T2"), ("all", "none"), (None, None), ("P1", "pkg0:M:T1")]
    out = X.subscribed(events, spark.createDataFrame(subs, "party string, template_id string"))
    assert sorted(r.id for r in out.collect()) == [r.id for r in rows if "P1" in who(r) or ("Q0" in who(r) and r.template_id in ("pkg0:M:T1", "pkg1:M:T2"))]


def test_large_party_sets_meet_no_sort_of_stakeholder_lists(spark, events, monkeypatch):
    monkeypatch.setattr(X, "is_small", lambda *a: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        subs = spark.createDataFrame([("P1", None), ("Q0", "pkg0:M:T1")], "party string, template_id string")
        for out in (X.subscribed(events, subs), X.apply_filter(events, X.StakeholderIn(ids(spark, ["P1", "Q2"])), None)):
            plan = out._jdf.queryExecution().sparkPlan().toString()
            top = next(line for line in plan.splitlines() if "Join" in line)
            assert "ShuffledHashJoin" in top, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("value,threshold,sign", [
    ("1E30", "1", 1), ("1E+5", "100000", 0), ("-1e999999999", "0", -1), ("1e-999999999", "0", 1), ("1e-999999999", "0.1", -1), (" 7 ", "1", None), ("7 ", "1", None),
    ("1E", "1", None), ("e5", "1", None), (".", "0", None), ("1e3000000000", "1", None), ("0e5", "0", 0), ("00.0010e3", "1", 0), ("12.5e-1", "1.25", 0), ("-12.5E-1", "-1.2", -1),
    ("+.5e1", "5", 0), ("999e-3", "1", -1), ("5.", "4.9", 1), ("0", "-1e5", 1), ("-0.0", "1E-9", -1)])
def test_exponents_compare_exactly(spark, value, threshold, sign):
    assert spark.createDataFrame([(value,)], "v string").select(X.compare_decimal(F.col("v"), threshold)).first()[0] == sign


def test_numeric_filters_take_exponents(spark):
    values = ["1E30", "1e-30", "5", " 7 ", "x", "-2E2"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    tagged = X._Value(F.col("v"), X.NUMERIC, F.col("v"))
    assert [r[0] for r in df.select(X._pred(X.NumericGt(Decimal(1)), tagged)).collect()] == [True, False, True, False, False, False]
    assert [r[0] for r in df.select(X._pred(X.NumericLt(Decimal(1)), tagged)).collect()] == [False, True, False, False, False, True]


def test_schemas_of_very_many_fields(spark):
    # 50,000 field names, ten a document: the plan doesn't know them.
    doc = F.to_json(F.map_from_entries(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.struct(F.concat(F.lit("f"), (F.col("id") * 10 + i).cast("string")), F.col("id")))))
    out = SC.field_types(spark.range(5_000).select(F.lit("t").alias("k"), doc.alias("doc")), ["k"], "doc")
    assert out.agg(F.count("*"), F.countDistinct("path"), F.max("events")).first()[:] == (50_000, 50_000, 1)


def test_merged_types_and_required_fields(spark):
    docs = ['{"a":1,"b":"x","c":{"d":true,"e":{"f":null}},"n":null}', '{"a":1.5,"b":"y","c":{"d":false,"e":{"f":[1]}},"n":null}', '{"a":2,"b":3,"c":7}', "{}", "[1]", "bad"]
    out = SC.merged_schema(spark.createDataFrame([("k", d) for d in docs], "k string, doc string"), ["k"], "doc")
    got = {r.path: (r.type, r.events, r.required) for r in out.collect()}
    assert got == {"a": ("DECIMAL", 3, False), "b": ("VARIANT", 3, False), "c": ("BIGINT", 1, False), "c.d": ("BOOLEAN", 2, False), "c.e.f": ("ARRAY", 2, False), "n": ("VOID", 2, False)}


def test_versions_and_their_compatibility(spark):
    of = {0: '{"a":1}', 1: '{"a":1}', 2: '{"a":1,"b":"x"}', 3: '{"a":1.5,"b":"x"}', 4: '{"a":1}', 6: '{"a":1}'}
    rows = [("k", r, d) for r, d in of.items() for _ in range(3)] + [("k", 2, '{"a":1}')] + [("other", 5, '{"z":true}')]
    got = {(r.k, r.version): r[2:] for r in SC.schema_versions(spark.createDataFrame(rows, "k string, r int, doc string"), "k", "r", "doc").collect()}
    assert got == {("k", 1): (0, 1, 1, 0, 0, 0, None, None),
                   ("k", 2): (2, 2, 2, 1, 0, 0, True, True),    # an optional field more
                   ("k", 3): (3, 3, 2, 0, 0, 1, False, False),  # b is required now, old readers can't take a decimal for an integer
                   ("k", 4): (4, 6, 1, 0, 1, 1, False, False),
                   ("other", 1): (5, 5, 1, 0, 0, 0, None, None)}
    assert SC.schema_versions(spark.createDataFrame([], "k string, r int, doc string"), "k", "r", "doc").collect() == []


def test_offsets_that_are_not_digits(spark):
    from ledgerlane.operators.batching import assign_batches, batch_manifest
    offsets = ["offset-1", "offset-2", "offset-3", f"{5:018d}", f"{1_000_007:018d}", "0-odd"]
    df = spark.createDataFrame([("s", o) for o in offsets], "topic string, ledger_offset string")
    rows = batch_manifest(assign_batches(df, size=4), opaque=True).collect()
    # Fixed-width offsets come first, then the others by their text.
    assert sorted((r.batch_no, r.events, r.first_offset, r.last_offset) for r in rows) == [(0, 4, f"{5:018d}", "offset-1"), (1, 2, "offset-2", "offset-3")]


def test_a_large_template_set_puts_no_template_in_one_task(spark):
    rows = spark.range(0, 3_000).select("id", F.when(F.col("id") % 3 == 0, "Main:Iou").when(F.col("id") % 3 == 1, "Other:T").alias("template_id"))
    ids = spark.range(0, 100_050).select(F.concat(F.lit("Generated:T"), F.col("id").cast("string")).alias("t")).unionByName(spark.createDataFrame([("Main:Iou",)], "t string"))
    for f, want in ((X.TemplateIn(ids), lambda i: i % 3 == 0), (X.Not(X.TemplateIn(ids)), lambda i: i % 3 != 0), (X.TemplateIn(ids, True), lambda i: i % 3 == 0)):
        out = X.apply_filter(rows, f, None)
        assert sorted(r.id for r in out.collect()) == [i for i in range(3_000) if want(i)]
        plan = out._jdf.queryExecution().toString()
        assert "hint=(strategy=broadcast)" in plan or "rightHint=(strategy=broadcast)" in plan
