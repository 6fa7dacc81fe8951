"""Event filter algebra compiled to one boolean Column.

Filters are plain Python values; ``compile_filter`` turns one into a
Catalyst expression, so the predicate runs JVM-side, folds constants
(``AcceptAll`` disappears) and pushes plain-column parts into the scan.

Two-valued logic: every leaf is wrapped in ``coalesce(..., false)`` so a
missing path never yields SQL null, and ``Not`` over a missing path is true.

Two payload forms are supported:

* typed: the payload is a Spark struct; the ledger value type of each path
  is resolved at plan time from the Spark type, plus ``tags`` for strings
  that are Parties (a wrong tag compiles to ``false``);
* json: the payload is JSON text (Daml-JSON, numbers as strings); values are
  read with ``try_variant_get`` and the tag is taken from ``tags`` or, for
  untagged paths, from the JSON type of the value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions.columns import template_key
from ledgerlane.functions.joins import is_small, small
from ledgerlane.session import scratch

TEXT, PARTY, NUMERIC, INT64, BOOL, RECORD = "text", "party", "numeric", "int64", "bool", "record"


# ---------------------------------------------------------------- filters
class EventFilter:
    pass


@dataclass(frozen=True)
class AcceptAll(EventFilter):
    pass


@dataclass(frozen=True)
class RejectAll(EventFilter):
    pass


@dataclass(frozen=True)
class And(EventFilter):
    filters: tuple = ()


@dataclass(frozen=True)
class Or(EventFilter):
    filters: tuple = ()


@dataclass(frozen=True)
class Not(EventFilter):
    filter: EventFilter


@dataclass(frozen=True)
class ByTemplate(EventFilter):
    template_ids: frozenset = frozenset()
    hash_agnostic: bool = False


@dataclass(frozen=True, eq=False)
class TemplateIn(EventFilter):
    """F6 over a table of template ids (its first column), of any size."""

    templates: DataFrame
    hash_agnostic: bool = False


@dataclass(frozen=True, eq=False)
class StakeholderIn(EventFilter):
    """F13 over a table of parties (its first column): any of them is a signatory or observer."""

    parties: DataFrame


@dataclass(frozen=True)
class _Flag(EventFilter):
    """A membership that a join has put into a column."""

    column: str


@dataclass(frozen=True)
class ByArgument(EventFilter):
    path: tuple
    predicate: "ValuePredicate"


# ------------------------------------------------------------- predicates
class ValuePredicate:
    pass


@dataclass(frozen=True)
class Exists(ValuePredicate):
    pass


@dataclass(frozen=True)
class IsEqualTo(ValuePredicate):
    tag: str
    value: object


@dataclass(frozen=True)
class TextIs(ValuePredicate):
    value: str


@dataclass(frozen=True)
class PartyIs(ValuePredicate):
    value: str


@dataclass(frozen=True)
class NumericGt(ValuePredicate):
    threshold: Decimal


@dataclass(frozen=True)
class NumericLt(ValuePredicate):
    threshold: Decimal


@dataclass(frozen=True)
class Int64Is(ValuePredicate):
    value: int


@dataclass(frozen=True)
class BoolIs(ValuePredicate):
    value: bool


# ------------------------------------------------------------- contexts
@dataclass
class TypedPayload:
    """Payload as a Spark struct column with a known schema."""
    column: str
    schema: T.StructType
    tags: dict = field(default_factory=dict)


@dataclass
class JsonPayload:
    """Payload as Daml-JSON text (or, with ``parsed``, an already parsed variant column).

    ``tags`` maps paths to ledger types.
    """
    column: str
    tags: dict = field(default_factory=dict)
    parsed: bool = False


def parse_payload_once(df, column: str, into: str = "_payload_v"):
    """Add the payload parsed to a variant, computed once per row.

    Catalyst would push a filter below a plain projection and inline the
    parse into every predicate leaf (one JSON parse per leaf and row).  A
    filter on a generator's output cannot move below the generator, so the
    parsed value is produced by exploding a one-element array: the JSON is
    parsed once per row and the leaves read the (binary) variant.
    """
    return df.select("*", F.explode(F.array(F.try_parse_json(F.col(column)))).alias(into))


@dataclass(frozen=True)
class _Value:
    """An extracted value: ``col`` is null when absent; ``tag`` is static or a Column."""
    col: Column | None
    tag: object  # str, or a Column yielding a tag string (json form)
    text: Column | None = None  # canonical text form (for Numeric equality)
    scale: int | None = None  # of a decimal column


def _typed_extract(ctx: TypedPayload, path: tuple) -> _Value:
    cur_type: T.DataType = ctx.schema
    c = F.col(ctx.column)
    for i, label in enumerate(path):
        if not isinstance(cur_type, T.StructType) or label not in cur_type.fieldNames():
            return _Value(None, None)  # path through a non-record, or missing label
        cur_type = cur_type[label].dataType
        c = c.getField(label)
    if isinstance(cur_type, T.StructType):
        tag = RECORD
    elif isinstance(cur_type, T.StringType):
        tag = ctx.tags.get(tuple(path), TEXT)
    elif isinstance(cur_type, T.DecimalType):
        tag = NUMERIC
    elif isinstance(cur_type, (T.LongType, T.IntegerType, T.ShortType)):
        tag = INT64
    elif isinstance(cur_type, T.BooleanType):
        tag = BOOL
    else:
        tag = ctx.tags.get(tuple(path), TEXT)
    text = c.cast("string") if tag != RECORD else F.to_json(c)
    return _Value(c, tag, text, cur_type.scale if isinstance(cur_type, T.DecimalType) else None)


def _json_extract(ctx: JsonPayload, path: tuple) -> _Value:
    v = F.col(ctx.column) if ctx.parsed else F.try_parse_json(F.col(ctx.column))
    jpath = "$" + "".join(f"['{p}']" for p in path)
    val = F.try_variant_get(v, jpath, "variant") if path else v
    # A JSON null is a value of type null: Daml "field without value" = none.
    present = val.isNotNull() & ~F.is_variant_null(val)
    vtype = F.schema_of_variant(val)
    given = ctx.tags.get(tuple(path))
    if given is not None:
        tag = F.when(present, F.lit(given))
    else:
        tag = (F.when(~present, None)
               .when(vtype == "STRING", TEXT)
               .when(vtype == "BOOLEAN", BOOL)
               .when(vtype.startswith("OBJECT"), RECORD)
               .when(vtype.rlike("^(BIGINT|INT|SMALLINT|TINYINT)$"), INT64)
               .when(vtype.rlike("^(DECIMAL|DOUBLE|FLOAT)"), NUMERIC))
    text = F.when(vtype == "STRING", F.try_variant_get(val, "$", "string")).otherwise(F.to_json(val))
    return _Value(F.when(present, val), tag, text)


def _tag_is(v: _Value, tag: str) -> Column:
    if isinstance(v.tag, str):
        return F.lit(v.tag == tag)
    return F.coalesce(v.tag == tag, F.lit(False))


def _as(v: _Value, spark_type: str) -> Column:
    return v.col if isinstance(v.tag, str) else F.try_variant_get(v.col, "$", spark_type)


def _numeric_text(v: _Value) -> Column:
    return v.col.cast("string") if isinstance(v.tag, str) else F.try_variant_get(v.col, "$", "string")


_FITS = r"^-?[0-9]{1,27}(\.[0-9]{1,10})?$"
_NUMBER = r"^([+-]?)([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]+))?$"
_MAX_EXPONENT = 2_147_483_647  # fixed value: decimals have 32-bit scales


def compare_decimal(text: Column, threshold: str) -> Column:
    """Sign of ``text - threshold`` of decimal numbers of any length and exponent, exactly; null where ``text`` is no number.

    A number other than zero is its sign, its digits without zeros at either
    end, and the place of the point before them: larger places are larger,
    equal places compare by the digits as text.  An exponent only moves the
    point, so nothing is written out.  Spaces aren't part of a number.
    """
    t = Decimal(threshold)
    digits_t = "".join(map(str, t.as_tuple().digits)).lstrip("0")
    place_t = len(digits_t) + int(t.as_tuple().exponent)
    digits_t = digits_t.rstrip("0")

    def part(i: int) -> Column:
        return F.regexp_extract(text, _NUMBER, i)

    digits = F.concat(part(2), part(3))
    exponent = F.when(part(4) == "", F.lit(0).cast("bigint")).otherwise(part(4).try_cast("bigint"))
    number = text.rlike(_NUMBER) & (digits != "") & (F.abs(exponent) <= _MAX_EXPONENT)
    cut = F.regexp_replace(digits, "^0+", "")
    place = F.length(part(2)) - (F.length(digits) - F.length(cut)) + exponent
    d = F.regexp_replace(cut, "0+$", "")

    def sign(a: Column, b: Column) -> Column:
        return F.when(a > b, 1).when(a < b, -1).otherwise(0)

    size = F.when(place != place_t, sign(place, F.lit(place_t))).otherwise(sign(d, F.lit(digits_t))) if digits_t else F.lit(1)
    negative = part(1) == "-"
    zero = F.lit(0 if not digits_t else 1 if t < 0 else -1)  # how a zero compares with the threshold
    if digits_t and t < 0:
        other = F.when(negative, -size).otherwise(1)
    else:
        other = F.when(negative, -1).otherwise(size)
    return F.when(F.coalesce(number, F.lit(False)), F.when(d == "", zero).otherwise(other))


def _pred(p: ValuePredicate, v: _Value) -> Column:
    if v.col is None:  # statically absent path
        return F.lit(False)
    if isinstance(p, Exists):
        return v.col.isNotNull()
    if isinstance(p, TextIs):
        return _tag_is(v, TEXT) & (_as(v, "string") == p.value)
    if isinstance(p, PartyIs):
        return _tag_is(v, PARTY) & (_as(v, "string") == p.value)
    if isinstance(p, Int64Is):
        return _tag_is(v, INT64) & (_as(v, "bigint") == p.value)
    if isinstance(p, BoolIs):
        return _tag_is(v, BOOL) & (_as(v, "boolean") == p.value)
    if isinstance(p, (NumericGt, NumericLt)):
        text, t = _numeric_text(v), Decimal(str(p.threshold))
        up = compare_decimal(text, str(t))
        exact = up > 0 if isinstance(p, NumericGt) else up < 0
        if abs(t) < Decimal(10) ** 27 and t.as_tuple().exponent >= -10:
            if v.scale is not None and v.scale <= 10:  # the column's decimals widen to the limit's without loss
                d, limit = v.col, F.lit(t)
                return _tag_is(v, NUMERIC) & F.coalesce(d > limit if isinstance(p, NumericGt) else d < limit, F.lit(False))
            # A number that a decimal(38,10) holds exactly, as nearly all do, is compared as one; the answer is the same.
            d, limit = text.try_cast("decimal(38,10)"), F.lit(t).cast("decimal(38,10)")
            exact = F.when(text.rlike(_FITS), d > limit if isinstance(p, NumericGt) else d < limit).otherwise(exact)
        return _tag_is(v, NUMERIC) & F.coalesce(exact, F.lit(False))
    if isinstance(p, IsEqualTo):
        # Equality of the ledger value, type included; Numeric compares its
        # text ("1.0" is not "1.00"), records compare their JSON text.
        if p.tag == NUMERIC:
            return _tag_is(v, NUMERIC) & (v.text == str(p.value))
        if p.tag == RECORD:
            return _tag_is(v, RECORD) & (v.text == p.value)
        kind = {TEXT: "string", PARTY: "string", INT64: "bigint", BOOL: "boolean"}[p.tag]
        return _tag_is(v, p.tag) & (_as(v, kind) == F.lit(p.value))
    raise TypeError(f"unknown predicate {p!r}")


def compile_filter(f: EventFilter, payload, template_col: str = "template_id") -> Column:
    """Compile ``f`` to a never-null boolean Column."""
    if isinstance(f, AcceptAll):
        return F.lit(True)
    if isinstance(f, RejectAll):
        return F.lit(False)
    if isinstance(f, And):
        out = F.lit(True)
        for sub in f.filters:
            out = out & compile_filter(sub, payload, template_col)
        return out
    if isinstance(f, Or):
        out = F.lit(False)
        for sub in f.filters:
            out = out | compile_filter(sub, payload, template_col)
        return out
    if isinstance(f, Not):
        return ~F.coalesce(compile_filter(f.filter, payload, template_col), F.lit(False))
    if isinstance(f, ByTemplate):
        if not f.template_ids:
            return F.lit(False)
        ids = sorted(f.template_ids)
        t = F.col(template_col)
        if f.hash_agnostic:
            return F.coalesce(template_key(t).isin(sorted({":".join(i.split(":")[-2:]) for i in ids})), F.lit(False))
        return F.coalesce(t.isin(ids), F.lit(False))
    if isinstance(f, _Flag):
        return F.coalesce(F.col(f.column), F.lit(False))
    if isinstance(f, (TemplateIn, StakeholderIn)):
        raise TypeError("a filter over a table is a join: use apply_filter")
    if isinstance(f, ByArgument):
        path = tuple(f.path)
        v = _typed_extract(payload, path) if isinstance(payload, TypedPayload) else _json_extract(payload, path)
        return F.coalesce(_pred(f.predicate, v), F.lit(False))
    raise TypeError(f"unknown filter {f!r}")


def extract_value(payload, path) -> Column:
    """F8: the value at ``path`` as text (records as JSON), null when absent."""
    path = tuple(path)
    v = _typed_extract(payload, path) if isinstance(payload, TypedPayload) else _json_extract(payload, path)
    if v.col is None:
        return F.lit(None).cast("string")
    return F.when(v.col.isNotNull(), v.text)


# ------------------------------------------------------- party filters
def stakeholders(signatories: str = "signatories", observers: str = "observers") -> Column:
    return F.array_union(F.coalesce(F.col(signatories), F.array().cast("array<string>")),
                         F.coalesce(F.col(observers), F.array().cast("array<string>")))


def visible_to(party: str) -> Column:
    """the party is a stakeholder (signatory or observer)."""
    return F.coalesce(F.array_contains(stakeholders(), party), F.lit(False))


def subscription(subs: list[tuple[str, list[str]]], template_col: str = "template_id") -> Column:
    """any (party, templates) pair matches; an empty template list means all.

    Subscriptions are configuration (a handful of parties), so they compile
    to a literal expression; nothing is joined or shuffled.
    """
    out = F.lit(False)
    for party, templates in subs:
        tmpl = F.lit(True) if not templates else F.coalesce(F.col(template_col).isin(list(templates)), F.lit(False))
        out = out | (visible_to(party) & tmpl)
    return out


# ------------------------------------------------------ filters over tables
# A set of template ids up to this size is a literal list of the predicate; a larger one is joined.
LITERAL_IDS = 1_000


def apply_filter(df: DataFrame, f: EventFilter, payload, template_col: str = "template_id", parties: tuple[str, str] = ("signatories", "observers")) -> DataFrame:
    """The rows of ``df`` that pass ``f``, where sets may be tables or long lists.

    Each such set is a left join with its distinct members that adds a flag;
    the boolean tree stands on the flags, so ``Not`` and ``Or`` over sets are
    what they are over lists.  A set is broadcast while its size is proven
    small, and shuffled beyond.  A party set meets the distinct stakeholder
    lists of the events, and a large template set their distinct templates,
    not the events: many events have one template, and a shuffle of events by
    template would put them all in one task.
    """
    columns = df.columns
    joined, n, seen = df, 0, None

    def templates() -> DataFrame:
        """The events' distinct templates, written once for all sets."""
        nonlocal seen
        if seen is None:
            path = scratch(df.sparkSession, "templates")
            found = df.select(F.col(template_col).alias("template")).distinct()
            found.write.parquet(path)
            seen = df.sparkSession.read.schema(found.schema).parquet(path)
        return seen

    def flagged(members: DataFrame, on: dict[str, Column], met: Callable[[], DataFrame] | None = None) -> EventFilter:
        """Join ``members`` (its columns named as in ``on``) and name the flag; ``met``: what a large set is cut to first."""
        nonlocal joined, n
        n += 1
        name = f"_in_{n}"
        members = members.distinct()
        few = is_small(members)
        if few:
            members = F.broadcast(members)
        elif met is not None and not df.isStreaming:
            members = small(met().distinct().join(members, list(on), "left_semi"))
        members = members.withColumn(name, F.lit(True))
        keys = {f"_key_{n}_{c}": c for c in on}
        members = members.select(*[F.col(c).alias(k) for k, c in keys.items()], name)
        if "stakeholders" in on and not few and not df.isStreaming:
            members = members.hint("shuffle_hash")  # as in ``subscribed``: lists are hashed, not sorted
        cond = None
        for k, c in keys.items():
            one = on[c].eqNullSafe(F.col(k)) if c == "stakeholders" else on[c] == F.col(k)
            cond = one if cond is None else cond & one
        joined = joined.join(members, cond, "left").drop(*keys)
        return _Flag(name)

    def walk(g: EventFilter) -> EventFilter:
        if isinstance(g, (And, Or)):
            return type(g)(tuple(walk(x) for x in g.filters))
        if isinstance(g, Not):
            return Not(walk(g.filter))
        if isinstance(g, ByTemplate) and len(g.template_ids) > LITERAL_IDS:
            ids = df.sparkSession.createDataFrame([(i,) for i in sorted(g.template_ids)], "template string")
            return walk(TemplateIn(ids, g.hash_agnostic))
        if isinstance(g, TemplateIn):
            def keyed(of):
                return template_key(of) if g.hash_agnostic else F.col(of)
            ids = g.templates.select(F.col(g.templates.columns[0]).alias("template")).select(keyed("template").alias("template"))
            return flagged(ids, {"template": keyed(template_col)}, lambda: templates().select(keyed("template").alias("template")))
        if isinstance(g, StakeholderIn):
            wanted = g.parties.select(F.col(g.parties.columns[0]).alias("party")).distinct()
            lists = df.select(stakeholders(*parties).alias("stakeholders")).distinct()
            each = lists.select("stakeholders", F.explode("stakeholders").alias("party"))
            return flagged(each.join(small(wanted), "party", "left_semi").select("stakeholders"), {"stakeholders": stakeholders(*parties)})
        return g

    tree = walk(f)
    return joined.filter(compile_filter(tree, payload, template_col)).select(*columns)


def subscribed(df: DataFrame, subscriptions: DataFrame, template_col: str = "template_id", parties: tuple[str, str] = ("signatories", "observers")) -> DataFrame:
    """F10 over a table ``(party, template_id)``: rows with a stakeholder subscribed to the template; a null template means all.

    The distinct (stakeholders, template) pairs of the events meet the table;
    the events meet the pairs that matched, in a hash join: a sort would build
    and compare the stakeholder lists again at every step.
    """
    who = stakeholders(*parties)
    pairs = df.select(who.alias("stakeholders"), F.col(template_col).alias("template")).distinct()
    subs = small(subscriptions.select(F.col("party"), F.col("template_id").alias("wanted")).distinct())
    each = pairs.select("stakeholders", "template", F.explode("stakeholders").alias("party")).join(subs, "party")
    matched = each.filter(F.col("wanted").isNull() | (F.col("wanted") == F.col("template"))).select("stakeholders", "template").distinct()
    matched = matched.select(F.col("stakeholders").alias("_who"), F.col("template").alias("_what"))
    return df.join(matched.hint("shuffle_hash"), who.eqNullSafe(F.col("_who")) & F.col(template_col).eqNullSafe(F.col("_what")), "left_semi")
