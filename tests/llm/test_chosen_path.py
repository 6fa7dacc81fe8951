"""MinHash near-dedup against a plain all-pairs version."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlane.llm import chosen_path as C
from ledgerlane.llm import common
from tests.llm.helpers import docs_of, same_rows, texts

DOC = "doc_id bigint, text string"


def shingles(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def expected(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    kinds = sorted({s for s in sets if s}, key=sorted)
    at = {s: i for i, s in enumerate(kinds)}
    ids = {}
    for s in kinds:
        for x in s:
            ids.setdefault(x, []).append(at[s])
    root = list(range(len(kinds)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(kinds):
        both = np.bincount(np.concatenate([ids[x] for x in s]), minlength=len(kinds))
        for j in np.flatnonzero(both[:i]):
            if 100 * both[j] >= percent * (len(s) + len(kinds[j]) - both[j]):
                root[find(i)] = find(j)
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            r = find(at[s])
            least[r] = min(i, least.get(r, i))
    out = []
    for (i, _), s in zip(rows, sets):
        c = least.get(find(at[s])) if s else i
        out.append((i, len(s), c, i is not None and i == c))
    return out


def got(spark, rows, **kw):
    out = C.minhash_components(spark.createDataFrame(rows, DOC), **kw)
    return out.select("id", "n_shingles", "component_id", "kept").collect()


def test_matches_all_pairs_on_documents(spark):
    rows = docs_of("sf0.01")
    same_rows(got(spark, rows), expected(rows))


def test_edge_rows(spark):
    rows = texts() + [(50, "A b"), (51, "a B"), (52, "one"), (None, "a b"), (53, " \x0b\r"), (None, "alone with null"), (None, "alone with null")]
    same_rows(got(spark, rows), expected(rows))


def near_copies(n, words, changes, seed):
    """Texts that differ from one base in up to ``changes`` words; similarities lie on both sides of 0.8."""
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for p in rng.choice(words, rng.integers(0, changes + 1), replace=False):
            w[p] = f"x{i}y{p}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("node_sets", [64, 4096])
def test_large_nodes_branch_or_shed_their_core(spark, node_sets):
    many = near_copies(120, 150, 6, 1) + near_copies(60, 150, 1, 2) + [f"own text number {i} " + "shared passage of some words " * 3 for i in range(40)]
    rows = [(i * 3, t) for i, t in enumerate(many)] + [(1000 + i, many[0]) for i in range(30)]
    same_rows(got(spark, rows, node_sets=node_sets), expected(rows))


def test_link_limit_is_exact():
    # 8 of 10 shingles in common is a link, 7 of 9 is none: integers decide.
    def edges(a, b):
        items = pa.array([sorted(a), sorted(b)], pa.list_(pa.int64()))
        rows = pa.RecordBatch.from_arrays([pa.array([1, 1]), pa.array([1, 1]), pa.array([5, 6]), pa.array([7, 8]), items], names=["c1", "c2", "s1", "s2", "items"])
        return sum(x.num_rows for x in C._confirmed(iter([rows]), 80))
    assert edges(range(9), range(1, 10)) == 1
    assert edges(range(8), range(1, 9)) == 0


def test_agreeing_tokens_lose_no_link():
    # Pairs just above the limit all pass the first comparison.
    rng = np.random.default_rng(3)
    for _ in range(300):
        both, one = rng.integers(0, 1 << 63, 400).astype(np.uint64), rng.integers(0, 1 << 63, 100).astype(np.uint64)
        a, b = np.sort(np.concatenate([both, one[:50]])), np.sort(np.concatenate([both, one[50:]]))
        t = C.tokens(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert (t[0] == t[1]).sum() >= C.AGREE


def test_one_tree_misses_some_and_five_none(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(150):  # pairs of similarity 0.8 to 0.83, among texts that share a passage
        w = [f"p{i}w{j}" for j in range(200)]
        other = list(w)
        for p in rng.choice(np.arange(0, 200, 8), 5, replace=False):
            other[p] = f"q{i}w{p}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(other))]
    want = expected(rows)
    assert sum(c != i for i, _, c, _ in want) > 100
    same_rows(got(spark, rows, node_sets=8), want)


def test_other_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e", 1, "x"), (2, "a b c d e", 2, "y")], "doc_id bigint, text string, s1 int, node string")
    assert sorted(C.minhash_components(df).select("id", "component_id").collect()) == [(1, 1), (2, 1)]
    assert C.minhash_components(spark.createDataFrame([], DOC)).collect() == []


def test_only_wanted_texts_are_shuffled(spark, monkeypatch):
    met = []

    def counted(docs, wanted, *keys):
        out = common.likely(docs, wanted, *keys)
        met.append((docs.count(), wanted.count(), out.count()))
        return out

    monkeypatch.setattr(C, "likely", counted)
    alone = [(i, " ".join(f"w{i}x{k}" for k in range(8))) for i in range(600)]
    near = [(1000 + i, "a b c d e f g h i j k l m n o p q r s t u v w x y z " + "!" * (i + 1)) for i in range(4)]
    rows = alone + near + near[:2] + [(7000, None)]
    got = {r.id: r.component_id for r in C.minhash_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: 1000 if 1000 <= i < 1004 else i for i, _ in rows}
    assert met and all(docs == len(rows) and wanted <= kept < 60 for docs, wanted, kept in met)


def test_texts_travel_with_their_cells_to_where_sets_are_made():
    rows = pa.RecordBatch.from_pydict({"c1": pa.array([1, 1]), "c2": pa.array([2, 2]), "s1": pa.array([3, 4]), "s2": pa.array([5, 6]), "text": pa.array(["a b c d e", "A b c d e"])})
    out, = C._sets(iter([rows]), 4)
    assert out.schema.names == ["c1", "c2", "s1", "s2", "items"] and out.column("c1").to_pylist() == [1, 1]
    found, = C._confirmed(iter([out]), 80)
    assert found.to_pylist() == [{"a1": 3, "a2": 5, "b1": 4, "b2": 6}]


def test_sets_alone_in_their_nodes_do_not_reach_the_shuffle(spark):
    # All rows of the frontier were shuffled: a semi join is moved below whatever filters its rows by a table of bits.
    rows = spark.range(20_000).selectExpr("xxhash64(id) AS node", "id AS s1", "-id AS s2", "1L AS n")
    nodes = common.staged(rows.filter("s1 < 40").select("node", F.lit(2).alias("sets")), "test-nodes")
    out = C._inside(rows.unionByName(rows.filter("s1 < 3")), nodes)
    assert sorted(r.s1 for r in out.collect()) == sorted([*range(40), 0, 1, 2]) and out.columns == rows.columns
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [x for x in plan if "Join " in x]
    assert len(joins) == 2 and "cell#" in joins[1] and "node#" in joins[0]


def test_each_row_of_a_cell_gets_its_text_and_copies_of_a_text_count_once(spark):
    docs = spark.createDataFrame([(1, 1, "a b")] * 50 + [(2, 2, "c"), (3, 3, "d")], "k1 bigint, k2 bigint, text string")
    keyed = spark.createDataFrame([(7, 8, 1, 1), (7, 9, 2, 2), (6, 8, 1, 1)], "c1 int, s1 int, k1 bigint, k2 bigint")
    same_rows(C._texts(keyed, docs).select("c1", "s1", "text").collect(), [(7, 8, "a b"), (7, 9, "c"), (6, 8, "a b")])
