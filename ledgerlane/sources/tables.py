"""Reading the input tables; every scan goes through here so pruning applies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Declared schemas of the tables the engine reads: no footer is read to infer
# them on every scan, and a file that drifts from them fails loudly.
SCHEMAS = {
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
}

# Whether a path's scan needs spreading, per (path, parallelism): a layout
# property that only affects speed, so it is looked up once per session.
_SPREAD: dict[tuple[str, int], bool] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it.

    The scan is returned as it is; ``spread`` is for scans that feed heavy
    per-row work.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """``table`` spread over the cluster by ``key`` when its scan is too narrow (see ``spread``)."""
    return spread(table(spark, sf_dir, name), key, f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str, path: str | None = None) -> DataFrame:
    """Give a scan that feeds heavy per-row work at least the cluster's parallelism.

    A parquet file with a single row group is read by one task whatever its
    byte splits, so all work up to the first shuffle would run on one core.
    A scan that would keep at most half of the cores busy is
    hash-partitioned on ``key`` over ``defaultParallelism`` partitions
    (deterministic, and two tables spread on their join key are
    co-partitioned); any other (any large table) is returned unchanged, so at
    scale this adds no shuffle.  The RDD is asked for its number of partitions
    only.  Filters
    and column pruning still reach the scan below the repartition.  Light
    queries (a pruned aggregate) should not spread: the shuffle costs more
    than the single task.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        cache_key = (path, target)
        if path is None or cache_key not in _SPREAD:
            _SPREAD[cache_key] = 2 * df.rdd.getNumPartitions() <= target
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): leave the scan as it is
        return df
    return df.repartition(target, key) if _SPREAD[cache_key] else df
