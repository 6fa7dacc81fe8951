"""Schemas of JSON payloads as rows (P10, P12): field paths, their types, and how they change.

Documents of one shape are one row before anything is taken apart: the shape
of a document is counted by partial aggregation, and one example of each
shape is exploded, level by level.  Nothing of a schema passes through the
driver, and no plan grows with the number of fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.session import scratch

# Kinds of values, a bit each: types merge by "or", so a merge is a partial aggregate in any order.
VOID, BOOLEAN, BIGINT, DECIMAL, DOUBLE, STRING, ARRAY, OBJECT, OTHER = (1 << i for i in range(9))
_KINDS = [("VOID", VOID), ("BOOLEAN", BOOLEAN), ("BIGINT", BIGINT), ("DECIMAL", DECIMAL), ("DOUBLE", DOUBLE), ("FLOAT", DOUBLE), ("STRING", STRING),
          ("ARRAY", ARRAY), ("OBJECT", OBJECT)]


def kind_of(type_text: Column) -> Column:
    """The bit of a variant's type, as ``schema_of_variant`` names it."""
    out = F.lit(OTHER)
    for name, bit in reversed(_KINDS):
        out = F.when(type_text.startswith(name), bit).otherwise(out)
    return out


def merged_type(kinds: Column) -> Column:
    """The least type that holds all of ``kinds``: numbers widen, a void adds nothing, all else that differs is a VARIANT."""
    some = kinds.bitwiseAND(F.lit(~VOID))
    out = F.when(some == 0, "VOID")
    for name, bit in _KINDS[1:]:
        out = out.when(some == bit, name)
    numbers = BIGINT | DECIMAL | DOUBLE
    out = out.when(some.bitwiseAND(F.lit(~(BIGINT | DECIMAL))) == 0, "DECIMAL").when(some.bitwiseAND(F.lit(~numbers)) == 0, "DOUBLE")
    return out.otherwise("VARIANT")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shapes(df: DataFrame, keys: list[str], doc: str) -> DataFrame:
    """``(*keys, shape, events, example)``: the distinct shapes (full type texts) of each key's documents."""
    shape = F.schema_of_variant(F.try_parse_json(doc))
    return (df.select(*keys, F.col(doc).alias("_doc"), shape.alias("shape")).filter(F.col("shape").isNotNull())
            .groupBy(*keys, "shape").agg(F.count(F.lit(1)).alias("events"), F.min("_doc").alias("example")))


def field_rows(df: DataFrame, keys: list[str], doc: str) -> DataFrame:
    """``(*keys, path, type, events)``: a row per shape and field that isn't an object with fields itself.

    Documents that aren't JSON, and those that aren't objects, have no
    fields.  Nested objects are taken apart a level at a time, as deep as
    there are any; a document's depth bounds the number of rounds.
    """
    here = _written(shapes(df, keys, doc), "shapes").select(*keys, "events", F.lit("").alias("path"), "example")
    spark, out = df.sparkSession, None
    while True:
        cols = ", ".join([*(f"t.`{k}`" for k in keys), "t.events"])
        step = spark.sql(f"SELECT {cols}, concat(t.path, if(t.path = '', '', '.'), f.key) AS path, schema_of_variant(f.value) AS type, to_json(f.value) AS example "
                         "FROM {t} AS t, LATERAL variant_explode_outer(parse_json(t.example)) AS f WHERE f.key IS NOT NULL", t=here)
        step = _written(step, "fields")
        nested = F.col("type").startswith("OBJECT<") & (F.col("type") != "OBJECT<>")
        leaves = step.filter(~nested).select(*keys, "path", "type", "events")
        out = leaves if out is None else out.unionByName(leaves)
        here = step.filter(nested).select(*keys, "events", "path", "example")
        if here.isEmpty():
            return out


def field_types(df: DataFrame, keys: list[str], doc: str) -> DataFrame:
    """P10: per key, field path and type: the events that have it: ``(*keys, path, type, events)``.

    A field of several types gives a row for each.
    """
    return field_rows(df, keys, doc).groupBy(*keys, "path", "type").agg(F.sum("events").alias("events"))


def merged_schema(df: DataFrame, keys: list[str], doc: str) -> DataFrame:
    """P10, merged: ``(*keys, path, type, events, required)``: one type per field, and whether all of the key's documents have a value there."""
    rows = field_rows(df, keys, doc)
    docs = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_docs"))
    kind = kind_of(F.col("type"))
    merged = rows.groupBy(*keys, "path").agg(F.bit_or(kind).alias("kinds"), F.sum("events").alias("events"), F.sum(F.when(kind != VOID, F.col("events")).otherwise(0)).alias("_set"))
    same = [merged[k].eqNullSafe(docs[k]) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return merged.join(docs, cond).select(*[merged[k] for k in keys], "path", merged_type(F.col("kinds")).alias("type"), "events", (F.col("_set") == F.col("_docs")).alias("required"))


def schema_changes(df: DataFrame, key: str, is_old: str, doc: str) -> DataFrame:
    """``(key, path, old_type, new_type, change)`` between documents with and without the ``is_old`` flag.

    A path's type in a range is the set of types that its documents have.
    """
    types = (field_types(df, [key, is_old], doc).groupBy(key, "path")
             .agg(*[F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(flag, F.col("type")))), "|"), F.lit("")).alias(name)
                    for name, flag in (("old_type", F.col(is_old)), ("new_type", ~F.col(is_old)))]))
    change = (F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
              .when(F.col("old_type") != F.col("new_type"), "retyped").otherwise("same"))
    return types.select(key, "path", "old_type", "new_type", change.alias("change"))


# A value of the first type can be read where the second is expected.
_READABLE = [("VOID", None), (None, "VARIANT"), ("BIGINT", "DECIMAL"), ("BIGINT", "DOUBLE"), ("DECIMAL", "DOUBLE")]


def _readable(written: Column, expected: Column) -> Column:
    out = written == expected
    for w, e in _READABLE:
        one = F.lit(True)
        if w:
            one = one & (written == w)
        if e:
            one = one & (expected == e)
        out = out | one
    return out


def schema_versions(df: DataFrame, key: str, range_col: str, doc: str) -> DataFrame:
    """P12 over any number of ranges: ``(key, version, first_range, last_range, fields, added, removed, retyped, backward, forward)``.

    A version is a run of ranges, in order, whose merged schemas have equal
    paths and types.  Against the version before: the fields added, removed
    and retyped; ``backward``: a reader of this version reads data of the one
    before (every field that this version requires was required there, with a
    type that it can read); ``forward``: the other way round.  Both are null for the
    first version.  Ranges without documents are passed over.
    """
    merged = _written(merged_schema(df, [key, range_col], doc), "range-schemas")
    of_range = merged.groupBy(key, range_col).agg(F.xxhash64(F.array_sort(F.collect_list(F.struct("path", "type")))).alias("_sig"))
    by = Window.partitionBy(key).orderBy(range_col)  # a row per range, whatever the events
    new = of_range.withColumn("_new", F.coalesce((F.lag("_sig").over(by) != F.col("_sig")).cast("int"), F.lit(1)))
    numbered = new.withColumn("version", F.sum("_new").over(by)).select(key, range_col, "version")
    of_version = _written(numbered.groupBy(key, "version").agg(F.min(range_col).alias("first_range"), F.max(range_col).alias("last_range")), "versions")
    fields = (merged.join(numbered, [key, range_col]).groupBy(key, "version", "path")
              .agg(F.min("type").alias("type"), F.bool_and("required").alias("required")))
    fields = _written(fields, "version-fields")
    before = fields.select(key, (F.col("version") + 1).alias("version"), "path", F.col("type").alias("old_type"), F.col("required").alias("old_required"))
    before = before.join(of_version.select(key, "version"), [key, "version"], "left_semi")
    both = fields.join(before, [key, "version", "path"], "full")
    was, now = F.coalesce("old_required", F.lit(False)), F.coalesce("required", F.lit(False))
    typed = F.col("type").isNull() | F.col("old_type").isNull()
    verdict = both.groupBy(key, "version").agg(
        F.count("type").alias("fields"), F.count_if(F.col("old_type").isNull()).alias("added"), F.count_if(F.col("type").isNull()).alias("removed"),
        F.count_if(F.col("type") != F.col("old_type")).alias("retyped"),
        F.bool_and((~now | was) & (typed | _readable(F.col("old_type"), F.col("type")))).alias("backward"),
        F.bool_and((~was | now) & (typed | _readable(F.col("type"), F.col("old_type")))).alias("forward"))
    first = F.col("version") == 1
    out = of_version.join(verdict, [key, "version"])
    return out.select(key, "version", "first_range", "last_range", "fields", *[F.when(~first, F.col(c)).otherwise(0).alias(c) for c in ("added", "removed", "retyped")],
                      *[F.when(~first, F.col(c)).alias(c) for c in ("backward", "forward")])
