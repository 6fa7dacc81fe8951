"""Physical-plan properties of the registered batch queries (what .explain shows)."""

import re

import pytest

from ledgerlane import plans
from tests.conftest import SF001

STREAMING = {"scan_flat_events", "bounded_stream", "commit_offsets", "dead_letter_batches",
             "transactional_batches", "dedupe_events", "resume_stream", "fan_out", "dlq_jsonl", "dlq_replay", "dlq_by_reason"}
BATCH = sorted(set(plans.QUERIES) - STREAMING)


def _plan(spark, name):
    df = plans.QUERIES[name](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_nested_loops(spark, name):
    p = _plan(spark, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "CartesianProduct"):
        assert bad not in p, (name, bad)
    if "BroadcastNestedLoopJoin" in p:
        pytest.fail(f"{name}: nested-loop join")


def _formatted(spark, name):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        plans.QUERIES[name](spark, SF001).explain("formatted")
    return buf.getvalue()


def test_offset_range_reaches_the_scan(spark):
    p = _formatted(spark, "replay_range")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderkey", p)
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(l_orderkey", p)


def test_bounded_streams_push_their_range(spark):
    """The offset range of a stream reaches the scan of its files as key bounds."""
    from ledgerlane.plans import streams as S
    start, end = S.offset_at(spark, SF001, S.SCAN_FROM), S.offset_at(spark, SF001, S.SCAN_TO)
    for kw, name in (({"start": start}, "GreaterThanOrEqual"), ({"end": end}, "LessThanOrEqual")):
        df = S._orders_stream(spark, SF001, **kw)
        assert df.isStreaming
        batch = S.bounded_orders(S.table(spark, SF001, "orders"), **kw)
        assert "o_orderkey, " in df._jdf.queryExecution().logical().toString().split("StreamingRelation")[0]
        assert re.search(rf"PushedFilters: \[[^\]]*{name}\(o_orderkey", batch._jdf.queryExecution().toString())


def test_a_cluster_needs_a_shared_folder():
    """Without one, files of a job would lie on single machines."""
    from ledgerlane.session import shared_dir

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_flagship_broadcasts_routes_and_aggregates_partially(spark):
    p = _plan(spark, "topic_summary")
    assert "BroadcastHashJoin" in p
    assert p.count("HashAggregate") >= 2  # partial (map side) + final
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string" in p or "ReadSchema" in p


def test_column_pruning_on_scans(spark):
    p = _formatted(spark, "lag_histogram")
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert schema == "struct<value:double>"


def test_feed_is_top_k_over_the_newest_orders(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "latest_feed")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_orderkey", _formatted(spark, "latest_feed"))


def test_spread_only_narrow_scans(spark):
    """A one-split scan is hash-spread over the cores; a scan with enough splits is left alone."""
    from ledgerlane.sources.tables import spread, spread_table
    narrow = spread_table(spark, SF001, "orders", "o_orderkey")
    p = narrow._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in p and "hashpartitioning(o_orderkey" in p
    wide = spark.range(0, 1000, 1, spark.sparkContext.defaultParallelism * 2)
    assert spread(wide, "id") is wide


def test_flat_documents_skip_the_hot_check(spark):
    """A document is a whole transaction: no size job, no numbering window."""
    p = _plan(spark, "parse_transactions")
    assert "Window" not in p


# K11's first error is an error text (a string buffer): its aggregate stays sort-based.
SORT_AGG_ALLOWED = {"partial_failures"}


@pytest.mark.parametrize("name", BATCH)
def test_aggregates_are_hash_based(spark, name):
    """max/min/max_by over fixed-width offsets aggregate by value: no SortAggregate."""
    if name in SORT_AGG_ALLOWED:
        return
    assert "SortAggregate" not in _plan(spark, name), name


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_declared_schemas_match_the_files(spark, sf):
    """The declared input schemas (no footer read per scan) equal what Spark infers from the files."""
    import os

    from pyspark.sql.types import StructType

    from ledgerlane.sources.tables import SCHEMAS
    root = f"/root/testdata/{sf}"
    if not os.path.isdir(root):
        pytest.skip(f"{root} absent")
    for name, ddl in SCHEMAS.items():
        inferred = spark.read.parquet(f"{root}/{name}.parquet").schema
        declared = StructType.fromDDL(ddl)
        assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in declared], name
