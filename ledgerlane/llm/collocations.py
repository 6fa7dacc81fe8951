"""Phrase collocation mining by stripes: each prefix keys a counter of the words that follow it.

Level m counts phrases of m words as stripes of their first m - 1 words; the
stripes of all blocks of text are merged elementwise.  A merged stripe gives
the extensions of its prefix; the totals of prefixes and the largest counts
among longer phrases come from the same table, one level apart.

A phrase can't be more frequent than a part of it, so level m counts only
phrases whose first and last m - 1 words were frequent at the level before.
Tasks learn which were by a bit table of fixed size: it lets no frequent
phrase out, and one too many only costs a count that isn't kept.  No list of
phrases goes back to the blocks of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.common import remove, staged
from ledgerlane.llm.files import located
from ledgerlane.llm.words import Words, mix, slices, split_words, window_hashes
from ledgerlane.session import scratch

BLOCK_BYTES = 4 << 20     # text that one counter is merged over before the shuffle
SLICE = 1 << 19
TABLE_WORDS = 1 << 22      # of 64 bits, in the table of frequent phrases: fixed, whatever the corpus
SEGMENT = 1 << 16          # a stripe is cut so that a segment counts about so many occurrences
# A block's stripes lie in buckets, a row each: always so many that rows grow with the blocks alone, and more of them
# only for a corpus whose buckets would hold the occurrences of more text than a task merges at once.
BUCKETS = 1 << 12
BUCKET_BYTES = 3 << 19
MERGED = 1 << 18           # entries of whole buckets that a task merges at once, or those of one bucket
ROWS = 512                 # buckets of a block in an output batch

# Fixed values of the contract: what ends a piece, and what stands between words.
PIECE_ENDS = np.zeros(256, bool)
PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD_ENDS = PIECE_ENDS.copy()
WORD_ENDS[[0x20, 0x09]] = True


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, size = TaskContext.get().partitionId() << 24, 0
    for batch in batches:
        for part in slices(batch, "text"):
            n = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if size and size + n > BLOCK_BYTES:
                block, size = block + 1, 0
            size += n
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, block))], names=["lang", "text", "block"])


class Flat:
    """Words one after another with one space between, so that any phrase is a byte range."""

    def __init__(self, w: Words):
        size = w.ends - w.starts
        self.ends = np.cumsum(size + 1) - 1
        self.starts = self.ends - size
        self.data = np.full(int(self.ends[-1]) + 1 if len(size) else 0, 0x20, np.uint8)
        self.data[_runs(self.starts, size)] = w.data[_runs(w.starts, size)]

    def text(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The words first:last of each phrase (none: empty)."""
        if not len(first):
            return pa.array([], pa.large_string())
        begin = self.starts[first]
        size = np.where(last > first, self.ends[last - 1] - begin, 0)
        bounds = np.concatenate([[0], np.cumsum(size)])
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(self.data[_runs(begin, size)].tobytes()))


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for sizes[0] values, then the next run."""
    total = np.cumsum(sizes)
    return np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)


def _lang_key(langs: list[str]) -> np.ndarray:
    h = split_words(pa.array([x + "\x01" for x in langs], pa.string()), np.zeros(256, bool))
    return h.hashes(1)


class Frequent:
    """Which phrases of the level before were frequent, by bits of their hash, and the counts of the few that fill several segments."""

    def __init__(self, bits: str, heavy: str):
        where, path = located(bits)
        t = pq.read_table(path, filesystem=where, columns=["cell", "bits"], partitioning=None)
        self.bits = np.zeros(TABLE_WORDS, np.uint64)
        self.bits[t.column("cell").to_numpy()] = t.column("bits").to_numpy().view(np.uint64)
        where, path = located(heavy)
        t = pq.read_table(path, filesystem=where, columns=["key", "n"], partitioning=None)
        keys = t.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], t.column("n").to_numpy()[order]

    def known(self, keys: np.ndarray) -> np.ndarray:
        shift = (keys >> np.uint64(TABLE_WORDS.bit_length() - 1)) & np.uint64(63)
        return (self.bits[keys & np.uint64(TABLE_WORDS - 1)] >> shift & np.uint64(1)).astype(bool)

    def weight(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key that is heavy, else 0."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


@lru_cache(maxsize=1)
def _frequent(bits: str, heavy: str) -> Frequent:
    """One copy for all tasks of a process; the folders are never written again."""
    return Frequent(bits, heavy)


def _groups(key: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal (key, second) are neighbours, and where runs begin.  (After a collision of keys a group may have several runs: counters add up later.)"""
    order = np.argsort(key, kind="stable")
    k, s = key[order], second[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    return order, np.flatnonzero(new)


class Counter:
    """The stripes of one block at one level."""

    def __init__(self, level: int, frequent: Frequent | None, buckets: int):
        self.level, self.frequent, self.buckets = level, frequent, np.uint64(buckets)
        self.parts: list[tuple] = []
        self.langs: dict[str, int] = {}  # the block's languages, by number

    def add(self, langs: pa.Array, texts: pa.Array) -> None:
        m = self.level
        w = split_words(texts, WORD_ENDS, lower=True)
        n = len(w.starts)
        if n < m:
            return
        codes = pc.fill_null(langs, "und").dictionary_encode()
        names = codes.dictionary.to_pylist()
        number = np.array([self.langs.setdefault(x, len(self.langs)) for x in names], np.int32)
        of = codes.indices.to_numpy()[w.text_of()]
        salt, lang = _lang_key(names)[of], number[of]
        h, h2 = w.hashes(0), w.hashes(1)
        ends_before = np.concatenate([[0], np.cumsum(PIECE_ENDS[w.data])])
        piece = ends_before[w.starts] + w.text_of()  # grows with every piece end and every text: equal inside a piece only
        first = np.arange(n - m + 1)
        first = first[piece[first] == piece[first + m - 1]]
        prefix = np.zeros(n, np.uint64)
        if m > 1:
            shorter = np.arange(n - m + 2)
            prefix = mix(window_hashes(h, shorter, shorter + m - 1) + salt[shorter])
            known = self.frequent.known(prefix)
            first = first[known[first] & known[first + 1]]
        if not len(first):
            return
        key = mix(window_hashes(h, first, first + m) + salt[first])
        order, begin = _groups(key, window_hashes(h2, first, first + m, 1))
        rep = first[order[begin]]
        flat = Flat(w)
        self.parts.append((key[order[begin]], window_hashes(h2, rep, rep + m, 1), np.diff(np.append(begin, len(order))), self._home(prefix[rep], h[rep + m - 1]),
                           lang[rep], flat.text(rep, rep + m - 1), flat.text(rep + m - 1, rep + m)))

    def _home(self, prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
        """A hash of each entry's stripe segment; its low bits name the bucket.

        The empty prefix is cut by the word.  Others are cut by the prefix's
        count in the corpus, which all blocks know alike, so that they cut it alike.
        """
        if self.level == 1:
            return mix(word) & (self.buckets - np.uint64(1))
        cuts = 1 << np.ceil(np.log2(np.maximum(self.frequent.weight(prefix) / SEGMENT, 1))).astype(np.int64)
        return mix(prefix + (mix(word) & (cuts.astype(np.uint64) - np.uint64(1))))

    def stripes(self, block: int) -> Iterator[pa.RecordBatch]:
        """A row per bucket: its stripes, each with the words that follow its prefix and their counts.

        A row holds its languages, their occurrences, each stripe's language
        (by number), prefix and number of words, and all words and counts.
        Prefixes and words are joined by what can't stand in them.
        """
        if not self.parts:
            return
        key, second, n, home, lang = (np.concatenate([p[i] for p in self.parts]) for i in range(5))
        prefix, word = (pa.concat_arrays([p[i] for p in self.parts]) for i in range(5, 7))
        self.parts = []
        order, begin = _groups(key, second)
        count, rep = np.add.reduceat(n[order], begin), order[begin]
        bucket = (home[rep] & (self.buckets - np.uint64(1))).astype(np.int64)
        by = np.lexsort((home[rep], lang[rep], bucket))
        rep, bucket, count = rep[by], bucket[by], count[by]
        names, lang = pa.array(list(self.langs), pa.string()), lang[rep]
        prefix, word = (x.take(pa.array(rep)) for x in (prefix, word))
        del key, second, n, home, order
        row = np.ones(len(rep), bool)
        row[1:] = bucket[1:] != bucket[:-1]
        spoken = row.copy()  # where a row's next language begins
        spoken[1:] |= lang[1:] != lang[:-1]
        head = spoken.copy()
        head[1:] |= ~pc.equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(row)
        for at in range(0, len(rows), ROWS):
            a = int(rows[at])
            b = int(rows[at + ROWS]) if at + ROWS < len(rows) else len(rep)
            inside, tongues, heads = (np.flatnonzero(x[a:b]) for x in (row, spoken, head))
            lists = lambda where, values: pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(where, inside), len(where)), pa.int32()), values)
            sizes = np.diff(np.append(heads, b - a))
            which = np.cumsum(spoken[a:b])[heads] - 1 - np.searchsorted(tongues, inside)[np.cumsum(row[a:b])[heads] - 1]
            every = np.arange(b - a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(inside), block)), pa.array(bucket[a:b][inside]), lists(tongues, names.take(pa.array(lang[a:b][tongues]))),
                 lists(tongues, pa.array(np.add.reduceat(count[a:b], tongues))), lists(heads, pa.array(which.astype(np.int32))),
                 pc.binary_join(lists(heads, prefix.take(pa.array(heads + a)).cast(pa.string())), "\n"), lists(heads, pa.array(sizes.astype(np.int32))),
                 pc.binary_join(lists(every, word[a:b].cast(pa.string())), " "), lists(every, pa.array(count[a:b].astype(np.int32)))], names=COLUMNS)
        del prefix, word
        pa.default_memory_pool().release_unused()


STRIPES = ("block bigint, bucket bigint, langs array<string>, occurrences array<bigint>, lang array<int>, prefixes string, sizes array<int>, "
           "words string, counts array<int>")
COLUMNS = [x.split()[0] for x in STRIPES.split(", ")]


def _count(batches: Iterator[pa.RecordBatch], level: int, uris: tuple[str, str] | None, buckets: int) -> Iterator[pa.RecordBatch]:
    block, counter = None, None
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cut = np.flatnonzero(np.diff(blocks)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(blocks)]):
            if a == b:
                continue
            if blocks[a] != block:
                if counter:
                    yield from counter.stripes(block)
                block = int(blocks[a])
                counter = Counter(level, _frequent(*uris) if uris else None, buckets)
            for part in slices(batch.slice(a, b - a), "text", SLICE):
                counter.add(part.column("lang"), part.column("text"))
    if counter:
        yield from counter.stripes(block)


FREQUENT = "lang string, phrase string, n bigint, key bigint"


def _merged(t: pa.Table, least: int) -> pa.RecordBatch:
    """Whole buckets' stripes added up elementwise: a row per phrase of ``least`` occurrences or more."""
    t = t.combine_chunks()
    column = lambda name: t.column(name).combine_chunks()
    flat = lambda name: pc.list_flatten(column(name))
    row = pc.list_parent_indices(column("lang")).to_numpy()
    before = np.concatenate([[0], np.cumsum(pc.list_value_length(column("langs")).to_numpy())])
    spoken = flat("langs").dictionary_encode()
    lang = spoken.indices.to_numpy()[before[row] + flat("lang").to_numpy()].astype(np.int64)  # of each stripe
    prefix, words = (pc.list_flatten(pc.split_pattern(column(name), by)) for name, by in (("prefixes", "\n"), ("words", " ")))
    stripe = np.repeat(np.arange(len(lang)), flat("sizes").to_numpy())
    coded, said = words.dictionary_encode(), prefix.dictionary_encode()
    _, home = np.unique(lang * max(len(said.dictionary), 1) + said.indices.to_numpy(), return_inverse=True)
    key = home[stripe] * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    total = np.zeros(len(first), np.int64)
    np.add.at(total, inverse, flat("counts").to_numpy())
    keep = first[total >= least]
    head, word = prefix.take(pa.array(stripe[keep])), words.take(pa.array(keep))
    phrase = pc.if_else(pc.equal(head, ""), word, pc.binary_join_element_wise(head, word, " "))
    w = split_words(phrase, WORD_ENDS)
    spoke = lang[stripe[keep]]
    hashed = mix(window_hashes(w.hashes(), w.bounds[:-1], w.bounds[1:]) + _lang_key(spoken.dictionary.to_pylist())[spoke])
    return pa.RecordBatch.from_arrays([spoken.dictionary.take(pa.array(spoke)), phrase, pa.array(total[total >= least]), pa.array(hashed.view(np.int64))],
                                      names=["lang", "phrase", "n", "key"])


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The buckets of a sorted partition, merged some whole ones at a time; one may span batches."""
    held: list[pa.RecordBatch] = []
    last, size = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column("bucket").to_numpy()
        upto = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("counts")).to_numpy())])  # entries before each row
        at = 0
        for row in np.flatnonzero(np.diff(bucket, prepend=bucket[0] if last is None else last)).tolist():
            if size + upto[row] - upto[at] >= MERGED:
                yield _merged(pa.Table.from_batches([*held, batch.slice(at, row - at)]), least)
                held, size, at = [], 0, row
        held.append(batch.slice(at))
        last, size = bucket[-1], size + upto[-1] - upto[at]
    if held:
        yield _merged(pa.Table.from_batches(held), least)


def buckets_of(n_blocks: int) -> int:
    return max(BUCKETS, 1 << (n_blocks * BLOCK_BYTES // BUCKET_BYTES).bit_length())


def _table(phrases: DataFrame) -> tuple[str, str]:
    """Folders of what ``Frequent`` reads: TABLE_WORDS rows at most, and one for SEGMENT occurrences in the corpus at most."""
    cell = F.col("key").bitwiseAND(F.lit(TABLE_WORDS - 1)).alias("cell")
    bit = F.expr(f"shiftleft(1L, cast(shiftright(key, {TABLE_WORDS.bit_length() - 1}) & 63 as int))").alias("bit")
    bits = scratch(phrases.sparkSession, "frequent-bits")
    phrases.select(cell, bit).groupBy("cell").agg(F.bit_or("bit").alias("bits")).write.parquet(bits)
    heavy = scratch(phrases.sparkSession, "heavy")
    phrases.filter(F.col("n") > SEGMENT).groupBy("key").agg(F.max("n").alias("n")).write.parquet(heavy)
    return bits, heavy


def frequent_phrases(df: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 100, max_words: int = 5) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, a) of every phrase of up to ``max_words`` words with ``min_count`` occurrences or more, and (lang, n), all word occurrences."""
    spark = df.sparkSession
    text = (df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text"))
            .filter(F.length("text") > 0))
    blocks = staged(text.mapInArrow(_blocks, "lang string, text string, block bigint"), "blocks", wide=True)
    n_blocks = blocks.select(F.approx_count_distinct("block")).first()[0]
    buckets = buckets_of(n_blocks)
    uris, levels, totals = None, [], None
    for m in range(1, max_words + 1):
        stripes = blocks.mapInArrow(lambda it, m=m, uris=uris: _count(it, m, uris, buckets), STRIPES)
        if m == 1:  # read twice
            stripes = staged(stripes, "stripes", wide=True)
            each = stripes.select(F.explode(F.arrays_zip("langs", "occurrences")).alias("s")).select("s.langs", "s.occurrences")
            totals = staged(each.groupBy(F.col("langs").alias("lang")).agg(F.sum("occurrences").alias("n")), "words")
        dealt = stripes.repartition("bucket").sortWithinPartitions("bucket")
        here = staged(dealt.mapInArrow(lambda it: _merge(it, min_count), FREQUENT), f"frequent-{m}", wide=True)
        if m == 1:
            remove(stripes)  # merged: nothing reads them again
        levels.append(here.select("lang", "phrase", F.lit(m).alias("m"), F.col("n").alias("a")))
        if m == max_words or here.isEmpty():
            break
        uris = _table(here)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return staged(out, "phrases"), totals


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 100, max_words: int = 5, top: int | None = 2000,
                 covered_percent: int = 100) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to ``max_words`` words.

    ``a`` occurrences inside pieces (overlaps count), ``l`` and ``r`` those of
    the parts at the lowest-scoring cut (ties: the shortest first part), ``n``
    words of the language, ``score`` = floor(1000 * a * n / (l * r)) in exact
    decimals.  A phrase inside a longer one of ``covered_percent`` of its
    count or more is dropped; as counts only fall with length, the longest
    counts among phrases longer by one word decide.  ``top`` None: all.

    Ties in score by count, then by the phrase's UTF-8 bytes.  Null language:
    ``und``; null, empty or wordless texts count nothing; repeated rows each
    count.  A text is one value in one task, whatever its length; counters
    cover a block of text (``BLOCK_BYTES``, or one longer text).  A prefix
    with many occurrences is cut into segments by the next word, and buckets of
    segments, more of them the larger the corpus, are merged one by one.  Other
    columns are not read; an empty table gives no rows.
    """
    counts, totals = frequent_phrases(df, lang_col, text_col, min_count, max_words)
    longer = counts.filter("m >= 2").withColumn("w", F.split("phrase", " "))
    k = F.col("k")
    cuts = longer.select("lang", "phrase", "m", "a", "w", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")).select(
        "lang", "phrase", "m", "a", "k", F.array_join(F.slice("w", 1, k), " ").alias("left"), F.array_join(F.slice("w", k + 1, F.col("m") - k), " ").alias("right"))
    part = counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    exact = "decimal(38,0)"
    scored = (cuts.join(part, ["lang", "left"]).join(rest, ["lang", "right"]).join(totals, "lang")
              .withColumn("score", F.expr(f"(CAST(1000 AS {exact}) * CAST(a AS {exact}) * CAST(n AS {exact})) div (CAST(l AS {exact}) * CAST(r AS {exact}))")))
    best = scored.groupBy("lang", "phrase", "m", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = (longer.filter("m >= 3").select("lang", F.col("a").alias("cover"), F.explode(F.array(F.slice("w", 1, F.col("m") - 1), F.slice("w", F.lit(2), F.col("m") - 1))).alias("part"))
              .groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("cover").alias("cover")))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(F.col("cover").isNull() | (100 * F.col("cover") < covered_percent * F.col("a")))
    by = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    out = kept.withColumn("rank", F.row_number().over(by).cast("bigint"))
    out = out.filter(F.col("rank") <= top) if top is not None else out
    return out.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
