"""The chunked numbering / lag helpers equal plain windows (with many chunks per group)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlane.operators.sequence import lag_rows, number_rows


def _data(spark):
    # one hot group holding most rows, plus small ones
    return spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 10).cast("string")).alias("g"),
        F.col("id").alias("o"), (F.col("id") * 7 % 3).alias("v"))


def test_number_rows_matches_window(spark):
    df = _data(spark)
    got = number_rows(df, ["g"], [F.col("o")], F.floor(F.col("o") / 137), "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("bigint"))
    assert got.select("g", "o", "rn").exceptAll(want.select("g", "o", "rn")).count() == 0
    assert got.count() == df.count()


def test_lag_rows_matches_window(spark):
    df = _data(spark)
    got = lag_rows(df, ["g"], ["o"], F.floor(F.col("o") / 137), "v", "prev")
    want = df.withColumn("prev", F.lag("v").over(Window.partitionBy("g").orderBy("o")))
    assert got.select("g", "o", "prev").exceptAll(want.select("g", "o", "prev")).count() == 0


def _want_rn(df):
    return df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("bigint"))


def test_two_level_prefix_across_super_chunks(spark):
    """Fan-out 4 over ~37 chunks: bases and carries cross many super-chunk edges."""
    df = _data(spark)
    got = number_rows(df, ["g"], [F.col("o")], F.floor(F.col("o") / 137), "rn", fanout=4)
    assert got.select("g", "o", "rn").exceptAll(_want_rn(df).select("g", "o", "rn")).count() == 0
    lagged = lag_rows(df, ["g"], ["o"], F.floor(F.col("o") / 137), "v", "prev", fanout=4)
    want = df.withColumn("prev", F.lag("v").over(Window.partitionBy("g").orderBy("o")))
    assert lagged.select("g", "o", "prev").exceptAll(want.select("g", "o", "prev")).count() == 0
    assert lagged.count() == df.count()
