"""Line dedup: lines that many documents share go; the rest is reassembled by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import SPACES, ascii_lower, digest, packed, staged


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
               min_chars: int = 1) -> DataFrame:
    """Per row: ``row`` (its columns), ``n_lines``, ``n_dropped`` and ``kept``, the text without common lines.

    A line's key is the line stripped of ASCII white space and lower-cased in
    A-Z, hashed to 128 bits.  Keys of ``min_chars`` code points or more found
    in ``min_docs`` distinct documents lose their lines everywhere.

    Only hashes and positions are shuffled for the counts and the join with
    the common keys; the text moves once, to meet its dropped positions.  The
    distinct count is partial before each shuffle; a key or row that holds a
    third of all rows is split by the skew join.

    Null or empty text: one empty line, kept.  Null ids together are one
    document; rows with one id are one document (each is returned).  An empty
    table gives no rows.  A text of any length is one row, whose lines are
    counted apart and joined again in one task.
    """
    docs = packed(df, id_col, text_col)
    keys = (docs.select("id", "k1", "k2", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
            .withColumn("line", ascii_lower(F.btrim("line", F.lit(SPACES))))
            .filter(F.char_length("line") >= min_chars))
    h1, h2 = digest(F.col("line"))
    keys = keys.select("id", "k1", "k2", "pos", h1.alias("h1"), h2.alias("h2"))
    n_docs = F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))
    common = keys.groupBy("h1", "h2").agg(n_docs.alias("n")).filter(F.col("n") >= min_docs).select("h1", "h2")
    common = staged(common, "common-lines")
    drops = (keys.join(common, ["h1", "h2"], "left_semi").groupBy("k1", "k2")
             .agg(F.sort_array(F.collect_set("pos")).alias("drops")))
    drops = staged(drops, "line-drops")
    lines = docs.join(drops, ["k1", "k2"], "left").select("row", "text", "drops", F.split("text", "\n", -1).alias("lines"))
    # The kept lines are the runs between dropped positions: linear in the lines, whatever their number.
    kept = F.expr("""array_join(flatten(transform(sequence(0, size(drops)), j -> slice(lines,
        if(j = 0, 0, drops[j - 1] + 1) + 1,
        if(j = size(drops), size(lines), drops[j]) - if(j = 0, 0, drops[j - 1] + 1)))), '\n')""")
    return lines.select("row", F.size("lines").cast("long").alias("n_lines"),
                        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
                        F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept).alias("kept"))
