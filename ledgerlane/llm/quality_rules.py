"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, the posterior decides.

Everything is DataFrame expressions: features of whole texts, votes, one count
per vote pattern, and a posterior that is a sum of fitted weights.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import SPACE_CLASS, SPACES, packed, staged

REPEAT = 5  # words of a window whose repeats count
# Two or more marks in a row, or one alone between spaces.
ODD_MARKS = r"[^\p{L}\p{N}\x20\x09-\x0D]{2,}|(?<= )[^\p{L}\p{N}\x20\x09-\x0D](?= )"


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_rows: bool = False) -> DataFrame:
    """The id and the counts of each whole text that the rules look at, with the row itself if asked for.

    Null or empty text, or white space alone: all counts 0.  A text of any
    length is counted whole, in one row.  The caller's columns travel in one
    struct, so none clashes.
    """
    first = ["row", "id"] if with_rows else ["id"]
    d = packed(df, id_col, text_col).select(*first, "text", F.btrim("text", F.lit(SPACES)).alias("trimmed"))
    d = d.select(*first, "text",
                 F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", f"{SPACE_CLASS}+")).alias("words"),
                 F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"))
    window = ", ".join(f"words[i + {k}]" for k in range(REPEAT))
    d = d.select(*first, F.size("words").cast("long").alias("n_words"),
                 F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                 F.regexp_count("text", F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
                 F.regexp_count("text", F.lit(ODD_MARKS)).cast("long").alias("n_odd_marks"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.expr(f"""if(size(words) < {REPEAT}, cast(array() as array<bigint>),
                     transform(sequence(0, size(words) - {REPEAT}), i -> xxhash64({window})))""").alias("windows"))
    keep = [*first, "n_words", "word_chars", "n_symbols", "n_upper", "n_odd_marks", "n_lines", "n_dup_lines"]
    # Only texts with a window twice sort theirs: equal windows then stand side by side.
    d = d.select(*keep, F.expr("""if(size(array_distinct(windows)) = size(windows), null,
        sort_array(transform(windows, (h, i) -> named_struct('h', h, 'i', i))))""").alias("s"))
    d = d.select(*keep, F.expr("""sort_array(transform(filter(s, (x, j) -> (j > 0 and s[greatest(j, 1) - 1].h = x.h)
        or (j < size(s) - 1 and s[least(j + 1, size(s) - 1)].h = x.h)), x -> x.i))""").alias("at"))
    return d.select(*keep, F.coalesce(F.expr(f"""aggregate(at, named_struct('n', 0L, 'to', 0),
        (a, x) -> named_struct('n', a.n + x + {REPEAT} - greatest(x, a.to), 'to', x + {REPEAT}), a -> a.n)"""), F.lit(0)).alias("n_repeat_words"))


#: Each rule: a ratio of two counts, and the ranges of it that vote good and bad; in between it abstains.
#: A rule abstains, too, where its divisor is 0.
RULES = {
    "symbols": ("n_symbols", "word_chars", "{r} <= 0.01", "{r} > 0.05"),
    "word_length": ("word_chars", "n_words", "{r} between 3.5 and 10", "{r} < 2.5 or {r} > 14"),
    "odd_marks": ("n_odd_marks", "n_words", "{r} <= 0.05", "{r} > 0.25"),
    "capitals": ("n_upper", "word_chars", "{r} <= 0.12", "{r} > 0.3"),
    "repeated_lines": ("n_dup_lines", "n_lines", "{r} <= 0.1", "{r} > 0.3"),
    "repeated_words": ("n_repeat_words", "n_words", "{r} <= 0.05", "{r} > 0.15"),
    "length": ("n_words", None, "{r} >= 50", "{r} < 20"),
}


def votes(d: DataFrame) -> DataFrame:
    """One column ``v_<rule>`` for each rule: 1 good, -1 bad, 0 abstains."""
    out = {}
    for name, (top, under, good, bad) in RULES.items():
        r = f"({top} / nullif({under}, 0))" if under else top
        out[f"v_{name}"] = F.expr(f"case when {good} then 1 when {bad} then -1 else 0 end".format(r=r))
    return d.withColumns(out)


#: What is believed of the rules before any vote is seen: the share of good documents, and of right votes among
#: those of good and of bad documents; it weighs as much as votes on this part of all documents.
PRIOR_GOOD, PRIOR_RIGHT, PRIOR_WEIGHT = 0.85, (0.98, 0.3), 0.01


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> tuple[float, list[tuple[float, float]]]:
    """EM over vote patterns and their counts: the log-odds of good before any vote, and for each rule's good and bad vote.

    Two classes of documents; a rule has an accuracy in each: the chance that
    its vote, where it doesn't abstain, is right.  Each round weighs documents
    by their posterior and counts the votes again, with the prior as
    pseudo-votes.  No rule is taken for one that is more often wrong than
    right about the bad: its good vote never speaks against a document.
    """
    j, n = len(RULES), sum(c for _, c in patterns)
    share, right, extra = PRIOR_GOOD, [PRIOR_RIGHT] * j, max(1.0, PRIOR_WEIGHT * n)
    for _ in range(rounds):
        weights = [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in right]
        prior = math.log(share / (1 - share))
        post = [(p, c, 1 / (1 + math.exp(-max(-500.0, _log_odds(p, prior, weights))))) for p, c in patterns]
        share = (sum(c * q for _, c, q in post) + PRIOR_GOOD * extra) / (n + extra)
        new = []
        for k in range(j):
            of_good, of_bad = ({v: sum(c * (q if good else 1 - q) for p, c, q in post if p[k] == v) for v in (1, -1)}
                               for good in (True, False))
            g = (of_good[1] + PRIOR_RIGHT[0] * extra) / (of_good[1] + of_good[-1] + extra)
            b = (of_bad[-1] + PRIOR_RIGHT[1] * extra) / (of_bad[1] + of_bad[-1] + extra)
            new.append((g, max(b, 1 - g)))
        done = max(abs(x - y) for old, now in zip(right, new) for x, y in zip(old, now)) < 1e-9
        right = new
        if done:
            break
    return math.log(share / (1 - share)), [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in right]


def _log_odds(votes: tuple[int, ...], prior: float, weights: list[tuple[float, float]]) -> float:
    return prior + sum(good if v > 0 else bad if v < 0 else 0.0 for v, (good, bad) in zip(votes, weights))


def judged(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10, max_repeat_percent: int = 20,
           threshold: float = 0.5, with_rows: bool = False) -> DataFrame:
    """Per row: ``id``, its counts, votes, ``base_failed``, ``quality`` (posterior) and ``kept``; ``row``, too, if asked for.

    ``base_failed``: under ``min_words`` words, or over ``max_repeat_percent``
    percent of the words in repeated windows; such rows are never kept.  The
    others are where the posterior is ``threshold`` or more.

    The accuracies are fitted to all rows: the driver gets one count for each
    pattern of votes, 3 ^ rules at most.  Nothing is shuffled but those counts.
    Repeated rows count as often as they are there; an empty table gives none.
    Very long texts are judged by the same counts; ties don't arise.
    """
    d = staged(votes(features(df, id_col, text_col, with_rows)), "quality")
    names = [f"v_{r}" for r in RULES]
    counts = sorted((tuple(r[:-1]), r["count"]) for r in d.groupBy(*names).count().collect())
    prior, weights = fit(counts)
    log_odds = F.lit(prior)
    for name, (good, bad) in zip(names, weights):
        log_odds = log_odds + F.when(F.col(name) > 0, good).when(F.col(name) < 0, bad).otherwise(0.0)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    d = d.withColumns({"base_failed": failed, "quality": 1 / (1 + F.exp(-log_odds))})
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def kept_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, with their columns."""
    good = judged(df, id_col, text_col, with_rows=True).filter("kept")
    return good.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])
