"""MinHash near-dedup as a chosen-path set similarity join.

Every document is a set of word shingles with ``COORDINATES`` minwise tokens.
A tree sends it from a node to one child for each of ``branches`` coordinates
that the node chose: the child that its token there names.  Two sets of
similarity 0.8 share a child with 0.8 for each coordinate, so with two
coordinates a node their common paths branch faster than they die out: one
tree misses such a pair with about 0.0625 at most, however deep it is, and ``TREES``
independent trees with 0.0625 ** TREES (1e-6 for five).

Nodes of at most ``node_sets`` sets are compared exhaustively: by agreeing
tokens first, which leaves cells of possible copies, and what is linked in a
cell is then decided on the full sets.  In a larger node one set is compared
with all others, on full sets too; sets that are then in one component need
no further comparison with each other, and what is still open either meets
that component in blocks or branches on.  Equal sets are one set throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import digest, likely, likely_rows, staged
from ledgerlane.llm.components import components
from ledgerlane.llm.words import mix, slices, split_words, window_hashes

COORDINATES = 64
TREES = 5
NODE_SETS = 4096          # sets of a node that one task compares
NODE_SHINGLES = 1 << 22   # and their shingles, unless the sets are few
FEW = 64
# Tokens out of 64 that two sets must share to be looked at: at similarity 0.8 fewer agree once in a million pairs.
AGREE = 35
NODE_WORDS = 1 << 19      # of 64 bits, in the table by which rows of nodes with one set are left out: fixed, whatever the input
_TOKEN = np.random.default_rng(11).integers(0, 1 << 64, COORDINATES, np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first hashes, second hashes, bounds): each text's distinct shingles as sorted 64-bit hashes with a second hash of each."""
    w = split_words(texts, lower=True)
    h, h2 = w.hashes(0), w.hashes(1)
    count = np.diff(w.bounds)
    n = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    text = np.repeat(np.arange(len(n)), n)
    first = np.repeat(w.bounds[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(text))
    last = np.minimum(first + shingle, np.repeat(w.bounds[1:], n))
    one, two = window_hashes(h, first, last, 0), window_hashes(h2, first, last, 1)
    order = np.lexsort((one, text))
    one, two, text = one[order], two[order], text[order]
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (text[1:] != text[:-1])
    one, two, text = one[new], two[new], text[new]
    return one, two, np.searchsorted(text, np.arange(len(n) + 1))


def tokens(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The minwise tokens of each set, a row each (an empty set: zeros)."""
    out = np.zeros((len(bounds) - 1, COORDINATES), np.int32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        for j, a in enumerate(_TOKEN):
            out[some, j] = np.minimum.reduceat((hashes * a >> np.uint64(32)).astype(np.uint32), bounds[some]).view(np.int32)
    return out


def _prints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            one, two, bounds = shingle_sets(part.column("text"), shingle)
            n = np.diff(bounds)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(x + np.uint64(s)), dtype=np.uint64)]) for s, x in ((1, one), (2, two))]
            s1, s2 = (pa.array((c[bounds[1:]] - c[bounds[:-1]]).view(np.int64)) for c in sums)
            sig = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * COORDINATES, pa.int32()), pa.array(tokens(one, bounds).ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], s1, s2, pa.array(n), sig], names=[*part.schema.names[:-1], "s1", "s2", "n", "sig"])


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """The rows with the full set of their last column, the text, in its place."""
    for batch in batches:
        for part in slices(batch, "text"):
            one, _, bounds = shingle_sets(part.column("text"), shingle)
            items = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(one.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], items], names=[*part.schema.names[:-1], "items"])


def forest(n: int, near) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A spanning forest of a graph of n points: (a, b) its edges and each point's tree.

    ``near(i, others)`` says which of ``others`` are linked to i; a point is
    compared with those not reached yet.
    """
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    tree = np.full(n, -1)
    todo = np.arange(n)
    while len(todo):
        start, todo = todo[0], todo[1:]
        tree[start] = start
        front = [start]
        while front and len(todo):
            i = front.pop()
            hit = near(i, todo)
            if hit.any():
                found, todo = todo[hit], todo[~hit]
                tree[found] = start
                front.extend(found.tolist())
                a.append(np.full(len(found), i))
                b.append(found)
    return np.concatenate(a), np.concatenate(b), tree


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a sorted partition; a group may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


CELLS = "c1 bigint, c2 bigint, s1 bigint, s2 bigint"


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def _cells(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The cells of each node: sets joined by chains of pairs that agree in ``AGREE`` tokens.  A cell is named by its members, so that trees that find it again give the same rows."""
    for t in _groups(batches, ["node"]):
        sig = pc.list_flatten(t.column("sig")).to_numpy().reshape(-1, COORDINATES)
        n = _column(t, "n")

        def near(i, others):
            fit = (100 * n[others] >= percent * n[i]) & (100 * n[i] >= percent * n[others])
            fit[fit] = (sig[others[fit]] == sig[i]).sum(1) >= AGREE
            return fit

        tree = forest(len(n), near)[2]
        kinds, inverse, count = np.unique(tree, return_inverse=True, return_counts=True)
        keep = np.flatnonzero(count[inverse] > 1)
        if not len(keep):
            continue
        s1, s2 = _column(t, "s1"), _column(t, "s2")
        names = []
        for salt in (1, 2):
            total = np.zeros(len(kinds), np.uint64)
            np.add.at(total, inverse, mix(mix(s1.view(np.uint64) + np.uint64(salt)) ^ s2.view(np.uint64)))
            names.append(pa.array(total[inverse[keep]].view(np.int64)))
        yield pa.RecordBatch.from_arrays([*names, pa.array(s1[keep]), pa.array(s2[keep])], names=["c1", "c2", "s1", "s2"])


EDGES = "a1 bigint, a2 bigint, b1 bigint, b2 bigint"


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each cell's links, decided on the full sets."""
    for t in _groups(batches, ["c1", "c2"]):
        items = t.column("items").combine_chunks()
        values, offs = items.flatten().to_numpy(), items.offsets.to_numpy().astype(np.int64)
        offs = offs - offs[0]
        _, values = np.unique(values, return_inverse=True)
        n = np.diff(offs)
        mark = np.zeros(len(values) and int(values.max()) + 1, np.int64)

        def near(i, others):
            fit = (100 * n[others] >= percent * n[i]) & (100 * n[i] >= percent * n[others])
            some = others[fit]
            if not len(some):
                return fit
            mine = values[offs[i]:offs[i + 1]]
            mark[mine] = 1
            size = n[some]
            ends = np.cumsum(size)
            at = np.repeat(offs[some] - (ends - size), size) + np.arange(ends[-1])
            both = np.add.reduceat(mark[values[at]], ends - size)
            mark[mine] = 0
            fit[fit] = 100 * both >= percent * (n[i] + size - both)
            return fit

        a, b, _ = forest(len(n), near)
        if len(a):
            s1, s2 = _column(t, "s1"), _column(t, "s2")
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (s1[a], s2[a], s1[b], s2[b])], names=["a1", "a2", "b1", "b2"])


def _branch(rows: DataFrame, branches: int) -> DataFrame:
    """The children of (node, s1, s2, n, sig): one for each coordinate that the node chose."""
    chosen = f"pmod(xxhash64(node, j), {COORDINATES})"
    child = f"transform(sequence(1, {branches}), j -> xxhash64(node, {chosen}, element_at(sig, CAST({chosen} AS INT) + 1)))"
    return rows.selectExpr("s1", "s2", "n", f"explode({child}) AS node")


def _keyed(rows: DataFrame, unique: DataFrame) -> DataFrame:
    """``rows`` (with s1, s2) and the digest k1, k2 of one text of each set."""
    return staged(rows.join(unique.select("s1", "s2", "text_key.k1", "text_key.k2"), ["s1", "s2"]), "text-keys")


def _texts(keyed: DataFrame, docs: DataFrame) -> DataFrame:
    """``keyed`` with the text in place of k1, k2.  A text is shuffled once, and one of its copies in a task."""
    texts = likely(docs, keyed.select("k1", "k2").distinct(), "k1", "k2").dropDuplicates(["k1", "k2"])
    return keyed.join(texts, ["k1", "k2"]).drop("k1", "k2")


def _members(sets: DataFrame, docs: DataFrame, unique: DataFrame, shingle: int) -> DataFrame:
    """(s1, s2, items): the full sets of ``sets`` (s1, s2), from one text of each."""
    return _texts(_keyed(sets.distinct(), unique), docs).select("s1", "s2", "text").mapInArrow(lambda it: _sets(it, shingle), "s1 bigint, s2 bigint, items array<bigint>")


def _inside(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``nodes`` (each once); most others, which are alone in theirs, don't reach the shuffle: a semi join would be moved below the table's."""
    return likely_rows(rows, nodes, "node", "shiftright(node, 40)", NODE_WORDS).join(nodes.select("node"), "node").select(rows.columns)


def _pivot_links(rows: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(a1, a2, b1, b2): one set of each large node, drawn by hash, is compared with all others of the node."""
    drawn = rows.groupBy("node").agg(F.min_by(F.struct("s1", "s2"), F.xxhash64("node", "s1", "s2")).alias("p"))
    shown = full.select(F.struct("s1", "s2").alias("p"), F.col("items").alias("of_pivot"))
    pivot = staged(staged(drawn, "pivots").join(shown, "p"), "pivot-sets")
    both = F.size(F.array_intersect("items", "of_pivot")).cast("bigint")
    seen = rows.join(full, ["s1", "s2"]).join(pivot, "node").withColumn("i", both).filter(100 * F.col("i") >= percent * (F.size("items") + F.size("of_pivot") - F.col("i")))
    return seen.selectExpr("p.s1 AS a1", "p.s2 AS a2", "s1 AS b1", "s2 AS b2").filter("a1 <> b1 OR a2 <> b2").distinct()


def _nodes_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.struct(F.col("a1").alias("s1"), F.col("a2").alias("s2")).alias("a"), F.struct(F.col("b1").alias("s1"), F.col("b2").alias("s2")).alias("b"))


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """``rows`` (with s1, s2) and ``root``, the component that is known so far: the set itself where it has no link yet."""
    named = label.select(F.col("node.s1").alias("s1"), F.col("node.s2").alias("s2"), "root")
    return rows.join(named, ["s1", "s2"], "left").withColumn("root", F.coalesce("root", F.struct("s1", "s2")))


def _settle(rows: DataFrame, label: DataFrame, node_sets: int) -> tuple[DataFrame, DataFrame]:
    """(rows that branch on, rows of new small nodes) of large nodes, after their pivots' links.

    Links inside a component add nothing, so of a node's largest component
    (its core) only the links with the node's other sets are still open.
    Where those others are at most half a small node, they meet the core in
    blocks, each a small node; where there are none, the node is done; else
    all its sets branch on.
    """
    half = max(node_sets // 2, 1)
    rooted = staged(_labelled(rows, label), "rooted-rows")
    sizes = rooted.groupBy("node", "root").agg(F.count("*").alias("size"))
    core = staged(sizes.groupBy("node").agg(F.max(F.struct("size", "root")).alias("core"), F.sum("size").alias("all")), "cores")
    seen = rooted.join(core, "node")
    others = F.col("all") - F.col("core.size")
    blocks = F.ceil(F.col("core.size") / half).cast("bigint")
    block = F.when(F.col("root") == F.col("core.root"), F.array(F.pmod(F.xxhash64("s1", "s2"), blocks))).otherwise(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    meet = (seen.filter((others > 0) & (others <= half)).withColumn("block", F.explode(block))
            .select(F.xxhash64("node", F.lit("core and others"), "block").alias("node"), "s1", "s2", "n"))
    return seen.filter(others > half).select("node", "s1", "s2", "n"), staged(meet, "met")


def links(docs: DataFrame, unique: DataFrame, shingle: int, percent: int = 80, trees: int = TREES, branches: int = 2, node_sets: int = NODE_SETS,
          node_shingles: int = NODE_SHINGLES) -> DataFrame:
    """(a, b): pairs of sets (as structs) whose components are those of all links.

    ``unique`` (s1, s2, n, sig, text_key) has each set once; ``docs`` (k1, k2, text) their texts.
    """
    roots = unique.filter("n > 0").withColumn("node", F.explode(F.array(*[F.xxhash64(F.lit("tree"), F.lit(t)) for t in range(trees)])))
    frontier = staged(_branch(roots, branches), "level-1")
    small, edges, label = None, None, None
    while True:
        counts = staged(frontier.groupBy("node").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).filter("sets > 1"), "node-sizes")
        fits = (F.col("sets") <= min(FEW, node_sets)) | ((F.col("sets") <= node_sets) & (F.col("shingles") <= node_shingles))
        leaves = _inside(frontier, counts.filter(fits))
        small = leaves if small is None else small.unionByName(leaves)
        large = counts.filter(~fits)
        if large.isEmpty():
            break
        rows = staged(_inside(frontier, large), "large-nodes")
        full = staged(_members(rows.select("s1", "s2"), docs, unique, shingle), "large-sets")
        more = _pivot_links(rows, full, percent)
        edges = staged(more if edges is None else edges.unionByName(more), "pivot-links")
        label = staged(components(_nodes_of(edges)), "labels")
        rows, met = _settle(rows, label, node_sets)
        small = small.unionByName(met)
        rows = staged(rows, "branching")
        sigs = likely_rows(unique.select("s1", "s2", "sig"), rows, "s1", "s2", NODE_WORDS)
        frontier = staged(_branch(rows.join(sigs, ["s1", "s2"]), branches), "level")
    # A byte of each token is shuffled: pairs that agree still do, one in 256 others seem to, and full sets decide.
    short = unique.select("s1", "s2", F.transform("sig", lambda x: (F.pmod(x, F.lit(256)) - 128).cast("tinyint")).alias("sig"))
    dealt = small.join(short, ["s1", "s2"]).repartition("node").sortWithinPartitions("node")
    cells = staged(dealt.mapInArrow(lambda it: _cells(it, percent), CELLS).distinct(), "cells")
    if label is not None:  # a cell inside one component adds nothing
        rooted = staged(_labelled(cells, label), "rooted-cells")
        ends = rooted.groupBy("c1", "c2").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        cells = staged(cells.join(staged(ends.filter("low <> high"), "open-cells"), ["c1", "c2"], "left_semi"), "cells")
    # Texts are shuffled, not the sets made of them: these are larger, and hashes don't compress.
    members = _texts(_keyed(cells, unique), docs).select("c1", "c2", "s1", "s2", "text")
    dealt = members.repartition("c1", "c2").sortWithinPartitions("c1", "c2")
    found = dealt.mapInArrow(lambda it: _confirmed(_sets(it, shingle), percent), EDGES)
    return staged(_nodes_of(found if edges is None else found.unionByName(edges)), "links", wide=True)


def minhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, percent: int = 80, trees: int = TREES,
                       branches: int = 2, node_sets: int = NODE_SETS, node_shingles: int = NODE_SHINGLES) -> DataFrame:
    """Per row: ``id``, ``k1``, ``k2`` (digest of the text), ``n_shingles``, ``component_id`` and ``kept``.

    Two documents are linked when 100 * intersection >= ``percent`` * union of
    their sets of ``shingle``-word shingles (fewer words: the whole sequence),
    lower-cased in A-Z; components are those of all links, named by their
    smallest id.  ``kept``: the row's id is that.

    Null, empty or wordless text: an empty set, linked with nothing, whose
    component is its own id.  Null ids are not the smallest; a component of
    nulls alone has a null id and keeps none.  Repeated rows share all; rows
    of one id with different texts have components of their own.  Equal sets
    are one set, so copies cost one row.  A text of any length is one value in
    one task; a node's sets are bounded by number and by shingles.  Other
    columns are not read; an empty table gives no rows.
    """
    k1, k2 = digest(F.col(f"`{text_col}`"))
    docs = df.select(F.col(f"`{id_col}`").alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(f"`{text_col}`").alias("text"))
    id_type = df.schema[id_col].dataType.simpleString()
    prints = staged(docs.mapInArrow(lambda it: _prints(it, shingle), f"id {id_type}, k1 bigint, k2 bigint, s1 bigint, s2 bigint, n bigint, sig array<int>"), "prints", wide=True)
    unique = staged(prints.groupBy("s1", "s2").agg(F.min("id").alias("first"), F.max("n").alias("n"), F.min(F.struct("k1", "k2")).alias("text_key"),
                                                  F.any_value("sig").alias("sig")), "sets")
    linked = links(docs.select("k1", "k2", "text"), unique, shingle, percent, trees, branches, node_sets, node_shingles)
    label = staged(components(linked), "labels")
    own = F.struct("s1", "s2")
    rooted = staged(unique.filter("n > 0").select("s1", "s2", "first", own.alias("node")).join(label, "node", "left")
                    .select("s1", "s2", "first", F.coalesce("root", "node").alias("root")), "rooted")
    ids = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    named = staged(rooted.join(ids, "root").select("s1", "s2", "component_id"), "components")
    out = prints.join(named, ["s1", "s2"], "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))
    return out.select("id", "k1", "k2", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
