"""Toxicity by maximum-scoring segments of token log-odds.

Learning.  A word's tokens are the word and its stems of a few lengths.  A
token's score is its log-odds between toxic and clean labelled documents, with
a Dirichlet prior that is the whole corpus; tokens whose log-odds aren't
clearly above zero score a small negative constant, so a random text drifts
down.  A word scores as its best token.  Near copies among the labelled
documents count once: else the rare words of one text with many copies would
pass for signs of its label.  Tokens are hashed to a slot in each of two tables
of fixed size, and score the lower of both slots' scores: the model's size
doesn't depend on the vocabulary, and a token that shares a slot with a toxic
one hardly ever shares both.

Scoring.  One linear scan (Ruzzo and Tompa) finds all maximal segments of
positive score.  The best segment of a clean text of n words follows an
extreme-value law; its two constants (lambda from the token scores, K from
clean labelled texts) turn a segment's score into the number of such segments
expected by chance.  Those below a bound are the text's toxic passages; their
excess over chance and the best score give the text's probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.chosen_path import minhash_components
from ledgerlane.llm.common import staged
from ledgerlane.llm.words import NOT_ALNUM, Words, slices, split_words

SLOT_BITS = 17
SLOTS = 1 << SLOT_BITS  # of each table
STEMS = (4, 5, 6)       # bytes of the stems that are tokens besides the word
SHINGLE = 5             # words of the shingles by which near copies are told
MAX_LABELLED = 200_000  # labelled rows that the model is fitted on; more are cut to those with the smallest hash of their id
PRIOR_DOCS = 100.0      # the prior weighs as much as so many documents in each class
CLEAR = 3.0             # standard errors above zero from which a token's log-odds count
LEAST_ODDS = 2.0        # log-odds below this tell too little, however sure
TOP_SCORE = 10.0
BY_CHANCE = 0.05        # segments expected by chance in a clean text of that length, at most, of a toxic passage


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's slot in the first and in the second table."""
    first, second = hashes >> np.uint64(64 - SLOT_BITS), hashes >> np.uint64(64 - 2 * SLOT_BITS)
    return first.astype(np.int64), (second & np.uint64(SLOTS - 1)).astype(np.int64) + SLOTS


def _tokens(w: Words) -> np.ndarray:
    """A row for the words and one for each length of stems."""
    return np.vstack([w.hashes()[None], w.stem_hashes(STEMS)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the documents have each slot's tokens: all, toxic and clean ones; slot -1 counts the documents.

    A token that a document has t times counts 1 + floor(log2 t): repeats tell something, but not as much as documents.
    """
    n = 2 * SLOTS
    counts, docs = np.zeros((3, n), np.int64), np.zeros(3, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            label = part.column("label").fill_null(-1).to_numpy(zero_copy_only=False)
            w = split_words(part.column("text"), NOT_ALNUM, lower=True)
            classes = (label >= -1, label == 1, label == 0)
            docs += [of.sum() for of in classes]
            tokens = _tokens(w)
            sets = [np.unique(tokens[:, a:b], return_counts=True) for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist())]
            own = np.repeat(np.arange(len(sets)), [len(x) for x, _ in sets])
            times = np.frexp(np.concatenate([np.zeros(0), *[t for _, t in sets]]))[1]
            for slots in _slots(np.concatenate([np.zeros(0, np.uint64), *[x for x, _ in sets]])):
                for k, of in enumerate(classes):
                    counts[k] += np.bincount(slots[of[own]], times[of[own]], n).astype(np.int64)
    some = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], some])), *[pa.array(np.concatenate([docs[k:k + 1], counts[k][some]])) for k in range(3)]],
                                     names=["slot", "every", "toxic", "clean"])


def token_scores(every: np.ndarray, toxic: np.ndarray, clean: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, float]:
    """Score of each slot's tokens and the extreme-value law's lambda, from their counts.

    Log-odds with an informative Dirichlet prior: pseudo-counts in proportion
    to the whole corpus, as many as ``PRIOR_DOCS`` of its documents have.
    """
    strength = PRIOR_DOCS * every.sum() / max(docs[0], 1)
    prior = strength * (every + 0.01) / (every + 0.01).sum()
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (toxic.sum() + strength - a)) - np.log(b / (clean.sum() + strength - b))
    z = odds / np.sqrt(1 / a + 1 / b)
    score = np.where((z >= CLEAR) & (odds >= LEAST_ODDS), np.minimum(odds, TOP_SCORE), 0.0)
    p = (clean + prior) / (clean + prior).sum()
    drift = max(0.05, 2 * float((p * score).sum()))
    score = np.where(score > 0, score, -drift)
    lo, hi = 0.0, 50.0  # the positive root of E[exp(lambda * score)] = 1
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if float((p * np.exp(mid * score)).sum()) < 1 else (lo, mid)
    return score, max(lo, 1e-3)


def maximal_segments(before: list[float], after: list[float]) -> list[tuple[int, int]]:
    """Ruzzo and Tompa: all maximal scoring runs of positive tokens, as (first, last) of them.

    ``before`` and ``after`` are the running total up to and with each one.
    Each candidate remembers the nearest earlier one with a lower total before
    it, so the search backwards skips what it passed already: linear in all.
    """
    first, last, low, high, lower = [], [], [], [], []
    for k, (left, right) in enumerate(zip(before, after)):
        start = k
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= left:
                j = lower[j]
            if j < 0 or high[j] >= right:
                first.append(start)
                last.append(k)
                low.append(left)
                high.append(right)
                lower.append(j)
                break
            start, left = first[j], low[j]  # extend to the candidate, which swallows all after it
            del first[j:], last[j:], low[j:], high[j:], lower[j:]
    return list(zip(first, last))


def _scan(batches: Iterator[pa.RecordBatch], score: np.ndarray) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    for batch in batches:
        for part in slices(batch, "text"):
            w = split_words(part.column("text"), NOT_ALNUM, lower=True)
            s = np.minimum(*(score[slots] for slots in _slots(_tokens(w)))).max(axis=0)
            total = np.concatenate([[0.0], np.cumsum(s)])
            hits = np.flatnonzero(s > 0)
            cuts = np.searchsorted(hits, w.bounds)
            found: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for d in np.flatnonzero(np.diff(cuts)).tolist():
                h = hits[cuts[d]:cuts[d + 1]]
                base = int(w.bounds[d])
                for a, b in maximal_segments(total[h].tolist(), total[h + 1].tolist()):
                    found[d].append({"start": int(h[a]) - base, "end": int(h[b]) + 1 - base, "score": float(total[h[b] + 1] - total[h[a]])})
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(w.bounds), pa.int64()), pa.array(found, kind)],
                                             names=["id", "n", "segments"])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression (the last one the constant's), by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text is 0 modulo 5 (a null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_labels(labels: DataFrame, id_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """(id, label) of ids that aren't held out, one row each (toxic if any says so): ``max_labelled`` at most."""
    rows = (labels.filter(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
            .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    return staged(rows.orderBy(F.xxhash64("id")).limit(max_labelled), "training-labels")


def _without_copies(src: DataFrame, train: DataFrame) -> DataFrame:
    """(id, label) of one document of each label and group of near copies (five-word shingles, similarity 0.8 or more) among the labelled ones."""
    labelled = src.join(F.broadcast(train.select("id")), "id").select("id", "text")
    group = minhash_components(labelled, "id", "text", shingle=SHINGLE).select("id", "component_id").distinct()
    one = group.join(F.broadcast(train), "id").groupBy("component_id", "label").agg(F.min("id").alias("id")).select("id", "label").distinct()
    return staged(one, "training-documents")


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per row: ``id``, ``held_out``, ``score``, ``predicted`` and ``passages`` (start, end, score, by_chance) in words.

    The classifier is fitted on a bounded sample of labelled rows that aren't
    held out (``max_labelled``); the prior's counts cover all rows.  No text is
    shuffled: the sample is broadcast, within its bound, and so are the scores
    of 2 ^ 18 slots.  Labelled texts are read to tell near copies, all texts to
    count and to scan.  Other columns are not read.

    Null or empty text, or one without words: no segment, scored as such.  A
    text of any length is scanned whole, in one task.  Ties: of segments that
    score alike all are found; an id that labels call both is toxic; of rows
    that share a labelled id the least values enter the fit.
    Without a label of each class every score is 0.  Repeated rows are scored
    alike; an empty table gives no rows.
    """
    spark = df.sparkSession
    train = training_labels(labels, id_col, label_col, max_labelled)
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = src.join(F.broadcast(_without_copies(src, train)), "id", "left").select("text", "label")
    counts = (known.mapInArrow(_count, "slot bigint, every bigint, toxic bigint, clean bigint").groupBy("slot")
              .agg(*[F.sum(c).alias(c) for c in ("every", "toxic", "clean")]).toArrow())  # a row for each slot at most
    slot = counts.column("slot").to_numpy() + 1
    full = np.zeros((3, 2 * SLOTS + 1))
    for k, c in enumerate(("every", "toxic", "clean")):
        full[k, slot] = counts.column(c).to_numpy()
    docs = full[:, 0]
    fits = docs[1] > 0 and docs[2] > 0
    tables = [token_scores(*full[:, a:a + SLOTS], docs) if fits else (np.full(SLOTS, -1.0), 1.0) for a in (1, SLOTS + 1)]
    # Each table's scores are at least the tokens': the smaller lambda is the cautious one.
    score, lam = np.concatenate([t for t, _ in tables]), min(x for _, x in tables)
    shared = spark.sparkContext.broadcast(score)
    id_type = df.schema[id_col].dataType.simpleString()
    found = staged(src.mapInArrow(lambda it: _scan(it, shared.value),
                                  f"id {id_type}, n bigint, segments array<struct<start: bigint, end: bigint, score: double>>"), "segments")
    best = F.coalesce(F.expr("array_max(transform(segments, x -> x.score))"), F.lit(0.0))
    found = found.withColumn("best", best)
    # One row of each labelled id, whatever the number of rows that share it: the sample is bounded by ``max_labelled``.
    names = ["x0", "x1", "x2", "x3"]
    labelled = found.join(F.broadcast(train), "id").groupBy("id", "label").agg(F.min(F.struct("n", "best")).alias("r")).select("label", "r.n", "r.best")
    chance = labelled.filter("label = 0 and n > 0").agg(F.avg(F.col("n") * F.exp(-lam * F.col("best")))).first()[0]
    k = 1 / chance if chance else 1.0
    # Of each segment: how many as good are expected by chance in a clean text of that length.
    found = found.withColumn("passages", F.expr(f"""filter(transform(segments, x -> named_struct('start', x.start, 'end', x.end, 'score', x.score,
        'by_chance', {k!r}D * n * exp(-{lam!r}D * x.score))), x -> x.by_chance <= {BY_CHANCE}D)"""))
    found = found.withColumns({"x0": lam * F.col("best"), "x1": F.log1p("n"), "x3": F.size("passages").cast("double"),
                               "x2": F.log1p(F.expr("aggregate(passages, 0D, (a, x) -> a + greatest(0D, -ln(x.by_chance + 1e-300D)))"))})
    p = F.lit(0.0)
    if fits:
        sample = found.join(F.broadcast(train), "id").groupBy("id", "label").agg(F.min(F.struct(*names)).alias("r")).select("r.*", "label").toArrow()
        w = logistic(np.column_stack([sample.column(c).to_numpy() for c in names]), sample.column("label").to_numpy().astype(float))
        line = F.lit(float(w[-1]))
        for name, weight in zip(names, w):
            line = line + F.col(name) * float(weight)
        p = 1 / (1 + F.exp(-line))
    out = found.withColumns({"held_out": held_out("id"), "score": p})
    return out.select("id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")
