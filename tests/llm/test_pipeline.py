"""The pipeline's stages, each against a plain version on its own input."""

import re
from collections import defaultdict

import pytest

import corpus_pipeline as P
from ledgerlane.llm import packing
from tests.llm.helpers import docs_of, same_rows
from tests.llm.test_operators import lower
from tests.llm.test_simhash import brute_components, brute_print

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """(folder, rows) of small tables with all kinds of cases, extra columns and repeated rows."""
    d = str(tmp_path_factory.mktemp("pipe"))
    rows = docs_of("sf0.001", cols=tuple(COLUMNS)) + [(None, None, None, None, None)]
    clean = " ".join(f"Word{i} follows upon clean{i} text{i}." for i in range(14))
    rows += [(900 + i, f"{clean} own{i % 3} end.\nShared line\nrest {i}", "en", "s", 1) for i in range(12)]
    rows += [rows[0], rows[0], (950, clean + ' "' + docs_of("sf0.001", "benchmark", ("item_id", "text"))[0][1] + '"', "en", None, 7)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, k1 string")
    df.write.parquet(f"{d}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    inputs = []
    for name, stage in P.STAGES:
        out = stage(spark, docs, data)
        if name != "packing":
            assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        rows = [tuple(r) for r in out.collect()]
        inputs.append((name, [tuple(r) for r in docs.collect()], rows))
        docs = spark.createDataFrame(rows, out.schema)
    got = {name: (a, b) for name, a, b in inputs}

    before, after = got["quality_rules"]
    assert set(after) <= set(before) and len([r for r in after if r[0] is not None and r[0] >= 900]) == 13

    before, after = got["line_dedup"]
    docs_of_line = defaultdict(set)
    for r in before:
        for x in (r[1] or "").split("\n"):
            docs_of_line[lower(x.strip(" \t\n\x0b\x0c\r"))].add(r[0])
    want = []
    for r in before:
        kept = [x for x in (r[1] or "").split("\n") if not ((k := lower(x.strip(" \t\n\x0b\x0c\r"))) and len(docs_of_line[k]) >= 10)]
        text = None if r[1] is None else "\n".join(kept)
        want.append((r[0], text, r[2], r[3], None if r[4] is None else len(text), *r[5:]))
    same_rows(after, want)

    before, after = got["near_dedup"]
    prints = [(r[0], brute_print(r[1])) for r in before]
    group = brute_components(prints)
    same_rows(after, {r for r, (_, f) in zip(before, prints) if r[0] == group[f]})

    before, after = got["decontaminate"]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = {tuple(w[s:s + m]) for _, t in docs_of("sf0.001", "benchmark", ("item_id", "text")) for w in [words(t)]
               for m in [min(10, len(w))] if m for s in range(len(w) - m + 1)}
    sizes = {len(w) for w in windows}
    dirty = lambda t: any(tuple(w[s:s + m]) in windows for w in [words(t)] for m in sizes for s in range(len(w) - m + 1))
    same_rows(after, [r for r in before if not dirty(r[1])])
    assert 950 in {r[0] for r in before} - {r[0] for r in after}

    before, after = got["packing"]
    fast, _ = packing.tokenizer("byte_bpe_50k.json")
    total = defaultdict(int)
    for r in after:
        total[r[0]] += r[2]
    assert total == {r[0]: len(fast(r[1] or "")) + 1 for r in before}


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_run_is_the_stages(spark, data):
    assert P.run(spark, data).columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
