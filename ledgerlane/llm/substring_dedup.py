"""Substring dedup by level-wise doubling of repeated word windows.

A window of 20 words is judged only where shorter windows in it repeat:

1. Five words.  Every 20-word window has an anchor, the five words in it with
   the smallest hash (the leftmost of equal ones).  Equal windows have equal
   anchors at the same place, so only anchors are compared, not all positions
   (about two in seventeen are one).  An anchor found once ends its windows.
2. Twice as long and more: the whole stretch of windows that share an anchor,
   20 to 35 words.  Of equal stretches only the earliest lives on; all windows
   of the others start earlier elsewhere.
3. Where an anchor still has different stretches, their 20-word windows are
   compared one by one.  No candidates survive this.

Equal texts are one text throughout (their earliest document stands for
them), so a group of copies costs one row per anchor and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import SPACE_CLASS, SPACES, digest, likely, staged
from ledgerlane.llm.words import Words, slices, split_words, window_hashes

FIRST = 5  # words of the first level


def _firsts(values: np.ndarray, width: int) -> np.ndarray:
    """For each i: the position of the smallest of values[i:i + width], the leftmost of equal ones."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:  # doubling: the smallest of 2k is that of two k, the second k wide to the right
        step = min(have, width - have)
        a, b = best[:-step], best[step:]
        right = b < a
        best, at = np.where(right, b, a), np.where(right, at[step:], at[:-step])
        have += step
    return at


def anchors(w: Words, window: int, first: int = FIRST) -> tuple[np.ndarray, ...]:
    """Anchors of a slice: (text, place, windows' words before it, after them from it, anchor hash, stretch hash).

    One row for each run of consecutive windows of a text with one anchor:
    they start ``back`` to ``near`` words before it.
    """
    n = len(w.starts)
    text = w.text_of()
    if n < window:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    h = w.hashes()
    five = window_hashes(h, np.arange(n - first + 1), np.arange(first, n + 1))
    at = _firsts(five, window - first + 1)  # of each window start 0 .. n - window
    starts = np.flatnonzero(text[:n - window + 1] == text[window - 1:])  # windows inside one text
    if not len(starts):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    place = at[starts]
    cut = np.concatenate([[True], (place[1:] != place[:-1]) | (text[starts[1:]] != text[starts[:-1]])])
    a = np.flatnonzero(cut)
    b = np.concatenate([a[1:], [len(starts)]]) - 1
    lo, hi, place = starts[a], starts[b], place[a]
    stretch = window_hashes(w.hashes(1), lo, hi + window, 1)
    own = text[lo]
    return own, place - w.bounds[own], place - lo, place - hi, five[place], stretch


def _emit_anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    seen: set[tuple[int, int]] = set()  # copies in this task's split: one of equal texts is enough
    for batch in batches:
        for part in slices(batch, "text"):
            t1, t2 = (part.column(c).to_numpy(zero_copy_only=False) for c in ("t1", "t2"))
            own, place, back, near, five, stretch = anchors(split_words(part.column("text")), window)
            fresh = np.zeros(part.num_rows, bool)
            for i in np.unique(own).tolist():
                key = (int(t1[i]), int(t2[i]))
                if key not in seen:
                    seen.add(key)
                    fresh[i] = True
            keep = fresh[own]
            own = own[keep]
            span = place[keep] << 16 | back[keep] << 8 | near[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(t1[own]), pa.array(t2[own]), pa.array(span.astype(np.int64)), pa.array(five[keep].view(np.int64)),
                 pa.array(stretch[keep].view(np.int64))], names=["t1", "t2", "span", "five", "stretch"])


def _emit_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The 20-word windows of the stretches still in question."""
    for batch in batches:
        for part in slices(batch, "text"):
            w = split_words(part.column("text"))
            n = len(w.starts)
            spans = part.column("spans")
            values = spans.flatten().to_numpy(zero_copy_only=False)
            own = np.repeat(np.arange(part.num_rows), np.diff(spans.offsets.to_numpy()))
            place, back, near = values >> 16, values >> 8 & 255, values & 255
            size = back - near + 1
            start = np.repeat(place - back - np.cumsum(size) + size, size) + np.arange(size.sum())
            own = np.repeat(own, size)
            at = start + w.bounds[own]
            a, b = (window_hashes(w.hashes(k), at, at + window, k) for k in (0, 1)) if n else (np.zeros(0, np.uint64),) * 2
            pick = [part.column(c).take(pa.array(own)) for c in ("id", "t1", "t2")]
            yield pa.RecordBatch.from_arrays([*pick, pa.array(start.astype(np.int64)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                             names=["id", "t1", "t2", "start", "w1", "w2"])


def _emit_kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            w = split_words(part.column("text"))
            removed, kept = [], []
            spans = part.column("ranges")
            values, offs = spans.flatten().to_numpy(zero_copy_only=False), spans.offsets.to_numpy()
            offs = offs - offs[0]
            for i in range(part.num_rows):
                first, last = int(w.bounds[i]), int(w.bounds[i + 1])
                r = values[offs[i]:offs[i + 1]]
                gone = np.zeros(last - first + 1, np.int64)
                np.add.at(gone, r >> 16, 1)
                np.add.at(gone, np.minimum((r >> 16) + (r & 65535), last - first), -1)
                stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0) + first
                removed.append(last - first - len(stay))
                kept.append(hashlib.sha256(b" ".join(w.word(k) for k in stay.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("t1"), part.column("t2"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=["t1", "t2", "n_removed", "kept_sha256"])


def _order(id_col: str = "id") -> Column:
    """Documents' order: a null id is the smallest."""
    return F.struct(F.col(id_col).isNotNull().alias("some"), F.col(id_col).alias("id"))


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t1, t2 = digest(F.coalesce(F.col(text_col), F.lit("")))
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), t1.alias("t1"), t2.alias("t2"))


def repeated_ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """(t1, t2, ranges): per distinct text (by digest), its ranges of words (``start << 16 | words``) that start earlier elsewhere.

    As seen from the text's earliest document; see ``substring_dedup``.
    """
    if not FIRST < window <= 200:
        raise ValueError(f"a window has more than {FIRST} and up to 200 words")
    docs = _texts(df, id_col, text_col)
    id_type = df.schema[id_col].dataType.simpleString()
    found = docs.select("t1", "t2", "text").mapInArrow(lambda it: _emit_anchors(it, window),
                                                       "t1 bigint, t2 bigint, span bigint, five bigint, stretch bigint")
    # Level one: anchors found at two places at least (a place: text and position).
    place = F.xxhash64("t1", "t2", "span")
    repeats = staged(found.groupBy("five").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b").select("five"), "anchors")
    # Copies in several tasks gave equal rows.  They go after the table is written: on top of the join, the
    # distinct would hold each anchor's rows together, and a hot anchor's couldn't be split.
    alive = staged(found.join(repeats, "five", "left_semi"), "repeated-anchors").distinct()
    earliest_doc = docs.groupBy("t1", "t2").agg(F.min(_order()).alias("doc"))
    firsts = staged(earliest_doc.join(alive.select("t1", "t2").distinct(), ["t1", "t2"]), "first-documents")
    alive = staged(alive.join(firsts, ["t1", "t2"]), "candidates")
    # Level two: of equal stretches the earliest lives on, the windows of the others are all later.
    key = ["five", "stretch", "back", "near"]
    alive = alive.withColumns({"at": F.expr("shiftright(span, 16)"), "back": F.expr("shiftright(span, 8) & 255"), "near": F.expr("span & 255")})
    first = staged(alive.groupBy(*key).agg(F.min(F.struct("doc", "at")).alias("first")), "first-stretches")
    later = (alive.join(first, key).filter(~F.struct("doc", "at").eqNullSafe(F.col("first")))
             .select("t1", "t2", F.expr(f"shiftleft(at - back, 16) | (back - near + {window})").alias("r")))
    # Level three: anchors with several stretches, window by window.
    several = staged(first.groupBy("five").count().filter("count > 1").select("five"), "open-anchors")
    unsettled = (alive.join(first, key).filter(F.struct("doc", "at").eqNullSafe(F.col("first")))
                 .join(several, "five", "left_semi").groupBy("t1", "t2", "doc").agg(F.collect_set("span").alias("spans")))
    unsettled = staged(unsettled, "open-stretches")
    one_each = (likely(docs, unsettled.select("t1", "t2"), "t1", "t2").join(unsettled, ["t1", "t2"])
                .filter(F.col("id").eqNullSafe(F.col("doc.id"))).select("id", "t1", "t2", "spans", "text"))
    windows = staged(one_each.mapInArrow(lambda it: _emit_windows(it, window),
                                         f"id {id_type}, t1 bigint, t2 bigint, start bigint, w1 bigint, w2 bigint"), "windows")
    head = staged(windows.groupBy("w1", "w2").agg(F.min(F.struct(_order().alias("doc"), "start")).alias("first")), "first-windows")
    again = (windows.join(head, ["w1", "w2"]).filter(~F.struct(_order().alias("doc"), "start").eqNullSafe(F.col("first")))
             .select("t1", "t2", F.expr(f"shiftleft(start, 16) | {window}").alias("r")))
    return staged(later.unionByName(again).groupBy("t1", "t2").agg(F.collect_set("r").alias("ranges")), "ranges")


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_removed`` and ``kept_sha256``, the digest of the kept words joined by one space.

    Removed is each word covered by a window of ``window`` words whose
    sequence also starts earlier: in a document with a smaller id (null is the
    smallest) or earlier in the same one.  Judged on the input.

    Rows with one id are one document: equal starts are no earlier ones, so
    repeated rows keep what one of them keeps.  Null or empty text: no words.
    A text of any length is cut to windows whole.  Other columns are not read;
    an empty table gives no rows.
    Only anchors, stretches and open windows are shuffled, and texts where
    something may go; the join sides that a hot passage or text could load
    are split by the skew join.
    """
    docs = _texts(df, id_col, text_col)
    ranges = repeated_ranges(df, id_col, text_col, window)
    cut = (likely(docs, ranges.select("t1", "t2"), "t1", "t2").select("t1", "t2", "text").join(ranges, ["t1", "t2"])
           .dropDuplicates(["t1", "t2"]).select("t1", "t2", "ranges", "text")
           .mapInArrow(_emit_kept, "t1 bigint, t2 bigint, n_removed bigint, kept_sha256 string"))
    plain = F.btrim(F.regexp_replace("text", f"{SPACE_CLASS}+", " "), F.lit(SPACES))
    rows = (docs.select("id", "t1", "t2", plain.alias("plain"))
            .select("id", "t1", "t2", F.sha2("plain", 256).alias("whole"),
                    F.when(F.col("plain") == "", 0).otherwise(F.char_length("plain") - F.char_length(F.replace("plain", F.lit(" "))) + 1)
                    .cast("long").alias("n_words")))
    rows = staged(rows, "rows")
    firsts = staged(rows.groupBy("t1", "t2").agg(F.min(_order()).alias("doc")), "first-rows")
    result = staged(firsts.join(cut, ["t1", "t2"], "left"), "results")
    copy = ~F.col("id").eqNullSafe(F.col("doc.id")) & (F.col("n_words") >= window)
    out = rows.join(result, ["t1", "t2"])
    return out.select("id", "n_words",
                      F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                      F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"))
