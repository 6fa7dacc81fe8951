"""Phrase collocation mining against a plain version."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerlane.llm import collocations as P
from ledgerlane.llm.common import batches_of
from tests.llm.helpers import docs_of, same_rows, texts

ROW = "lang string, text string"


def plain(rows, least, max_words=5, top=2000, percent=100):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        freq = {p: a for p, a in c.items() if a >= least}
        found, cover = [], {}
        for q, b in freq.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    cover[q[i:i + m]] = max(b, cover.get(q[i:i + m], 0))
        for p, a in freq.items():
            if len(p) >= 2 and not (p in cover and 100 * cover[p] >= percent * a):
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return out


def got(spark, rows, least, **kw):
    return P.collocations(spark.createDataFrame(rows, ROW), min_count=least, **kw).collect()


def test_matches_plain_on_documents(spark):
    rows = docs_of("sf0.001", cols=("lang", "text"))
    same_rows(got(spark, rows, 8), plain(rows, 8))


HARD = [("en", t) for _, t in texts()] + [(None, "one two three"), ("und", "one two three"), ("", "one two"), ("", "One\ttwo"), ("x", "a a a a a a a"),
        ("x", "a b. a b, a b; a b: a b! a b? a b\na b\x0ba b\x0ca b\ra b"), ("x", "É é É é"), ("x", "\x01 \x01"), (None, None), ("y", "..."), ("z", "  \t ")]


@pytest.mark.parametrize("kw", [{}, {"max_words": 2}, {"top": 3}, {"percent": 60}])
def test_hard_rows(spark, kw):
    extra = {"covered_percent" if k == "percent" else k: v for k, v in kw.items()}
    same_rows(got(spark, HARD, 2, **extra), plain(HARD, 2, **kw))


def test_many_blocks_and_segments(spark, monkeypatch):
    rows = docs_of("sf0.001", cols=("lang", "text"))
    monkeypatch.setattr(P, "BLOCK_BYTES", 50_000)
    monkeypatch.setattr(P, "SLICE", 10_000)
    monkeypatch.setattr(P, "SEGMENT", 16)
    monkeypatch.setattr(P, "BUCKET_BYTES", 5_000)
    monkeypatch.setattr(P, "ROWS", 7)
    same_rows(got(spark, rows, 8), plain(rows, 8))


def test_products_beyond_64_bits(spark):
    # 1000 * a * n of these counts is over 2^64; SQL decimals keep it exact.
    counts = spark.createDataFrame([("en", "u", 1, 3_000_000_001), ("en", "v", 1, 5_000_000_003), ("en", "u v", 2, 2_999_999_999)], "lang string, phrase string, m int, a bigint")
    totals = spark.createDataFrame([("en", 9_999_999_999_999)], "lang string, n bigint")

    def given(*_):
        return counts, totals
    saved, P.frequent_phrases = P.frequent_phrases, given
    try:
        row = P.collocations(spark.createDataFrame([], ROW)).collect()[0]
    finally:
        P.frequent_phrases = saved
    assert row["score"] == 1000 * 2_999_999_999 * 9_999_999_999_999 // (3_000_000_001 * 5_000_000_003)


def test_empty_table(spark):
    assert P.collocations(spark.createDataFrame([], ROW)).collect() == []


def test_rows_of_stripes_grow_with_the_blocks_alone():
    # Buckets grew with the table from its second block on, and each block has a row per bucket.
    assert P.buckets_of(1) == P.buckets_of(200) == P.BUCKETS
    assert P.buckets_of(1_000_000) * P.BUCKET_BYTES >= 1_000_000 * P.BLOCK_BYTES


def test_buckets_are_merged_some_at_a_time_and_across_batches(spark, monkeypatch):
    langs, texts_ = zip(*docs_of("sf0.001", cols=("lang", "text")))
    counter = P.Counter(1, None, 64)
    counter.add(pa.array(langs), pa.array(texts_))
    rows = pa.Table.from_batches(list(counter.stripes(0))).sort_by("bucket").combine_chunks()
    assert rows.num_rows <= 64
    whole = pa.Table.from_batches(P._merge(iter(rows.to_batches()), 3)).to_pylist()
    monkeypatch.setattr(P, "MERGED", 500)
    parts = [b.to_pylist() for b in P._merge(iter(rows.to_batches(max_chunksize=5)), 3)]
    assert 1 < len(parts) < 64
    by = lambda r: (r["lang"], r["phrase"])
    assert sorted((r for part in parts for r in part), key=by) == sorted(whole, key=by)


def test_batch_size_of_the_session_comes_back(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with batches_of(spark, 7):
        assert spark.conf.get(key) == "7"
    assert spark.conf.get(key) == before


def test_a_frequent_phrase_is_one_row_however_many_blocks_have_it():
    # It was a row for each block that had it, which went back to that block.
    batches = []
    for block in range(3):
        counter = P.Counter(1, None, 64)
        counter.add(pa.array(["en", None, "fr", "en"]), pa.array(["a b a", "a c", "b b b", "d"]))
        batches += counter.stripes(block)
    rows = pa.Table.from_batches(batches).sort_by("bucket").combine_chunks()
    out = [r for b in P._merge(iter(rows.to_batches()), 4) for r in b.to_pylist()]
    assert sorted((r["lang"], r["phrase"], r["n"]) for r in out) == [("en", "a", 6), ("fr", "b", 9)]


def test_table_of_frequent_phrases_has_a_fixed_size_and_misses_none(spark):
    keys = np.random.default_rng(4).integers(-1 << 63, 1 << 63, 3000)
    rows = [("en", str(k), 100 + i % 2 * P.SEGMENT, int(k)) for i, k in enumerate(keys[:2000])]
    for phrases, heavy in ((rows, 1000), (rows[::2], 0)):
        got = P.Frequent(*P._table(spark.createDataFrame(phrases, P.FREQUENT)))
        listed = np.array([r[3] for r in phrases]).view(np.uint64)
        assert got.known(listed).all() and got.known(keys[2000:].view(np.uint64)).sum() < 10 and got.bits.nbytes == 8 * P.TABLE_WORDS
        assert got.weight(listed).tolist() == [r[2] if r[2] > P.SEGMENT else 0 for r in phrases] and len(got.keys) == heavy
