"""Queries with an SQL form against DuckDB: on the given tables and on rows that are hard."""

import duckdb
import pytest

from ledgerlane.llm.queries import ORACLE, QUERIES
from tests.check import compare, duck
from tests.conftest import SF01
from tests.llm.helpers import texts


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    got = compare(spark, name, QUERIES[name], ORACLE[name], SF01, duck(SF01))
    assert got["ok"], got


#: The hard rows with distinct ids and no null id (SQL's grouping by id tells neither apart), and lines and passages that repeat.
PASSAGE = " ".join(f"p{i}" for i in range(35))
DOCUMENTS = ([(i, t and t[:12_000]) for i, (_, t) in enumerate(texts())]  # SQL's list slices are quadratic in a text's words
             + [(100 + i, f"Shared LINE \n own {i}\n\tshared line\n{PASSAGE if i % 3 else PASSAGE[:80]}\n{'x ' * i}") for i in range(14)]
             + [(200, f"{PASSAGE} middle {PASSAGE}"), (201, "a " * 50), (202, "a " * 50), (203, "Bench mark item WITH exactly, ten words in it, ok? and"),
                (204, "short item"), (205, "not a SHORT-item here"), (206, "ünï CODE\x0bünï code"), (207, None)])
ITEMS = [(1, "bench mark item with exactly ten words in it ok"), (2, "Bench mark item with exactly ten words in it ok and more"), (3, "short item"),
         (10, "short ITEM!"), (4, None), (5, ""), (6, "ünï code"), (7, "p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 p13 p14"), (7, "p20 p21")]
PAGES = [(1, "http://Example.COM/en/x?q=/fr/", "same"), (2, "https://www.example.com/en/", "same"), (3, "x://a.b.net/es/1", None), (4, "x://net/fr", ""),
         (5, None, "page"), (6, "no scheme com/", "Ünïcode \U0001f600"), (7, "http://notcom/", "same"), (8, "http://com", "x" * 300_000),
         (9, "http://a.example.com:80/en/", "\x00\x1f\x8b\x08 WARC/1.1"), (10, "a://b://com/", " "), (11, "://.com//", "page"), (12, "h://net/es/?#", "same\r\n\r\n")]


_V = [0.1 * i for i in range(64)]
VECTORS = [(1, None), (2, []), (3, _V[:63]), (4, [*_V[:63], None]), (5, [*_V[:63], float("nan")]), (6, [*_V[:63], float("-inf")])] + [
    (10 + i, [(-1) ** j * 0.01 * ((i * j) % 23) for j in range(64)]) for i in range(90)] + [(200 + i, _V) for i in range(30)]


@pytest.fixture(scope="module")
def hard(tmp_path_factory):
    d = tmp_path_factory.mktemp("hard")
    common = "Two common words. ten times over, " * 10  # phrases frequent enough, per language
    documents = [(i, t, (None, "en", "", "und")[i % 4]) for i, t in DOCUMENTS] + [(300 + i, common, (None, "en", "fr")[i % 3]) for i in range(33)]
    tables = {"documents": (documents, "doc_id BIGINT, text VARCHAR, lang VARCHAR"), "embeddings": (VECTORS, "vec_id BIGINT, embedding DOUBLE[]"), "benchmark": (ITEMS, "item_id BIGINT, text VARCHAR"),
              "pages": (PAGES, "page_id BIGINT, url VARCHAR, html VARCHAR")}
    con = duckdb.connect()
    for name, (rows, cols) in tables.items():
        con.execute(f"CREATE TABLE {name} ({cols})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
        # Columns beside those that are read, some named as working columns are.
        con.execute(f"COPY (SELECT *, 1 AS row, 'x' AS id, 2 AS k1, 'y' AS line, 3 AS n FROM {name}) TO '{d}/{name}.parquet' (FORMAT parquet)")
    return str(d), con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_hard_rows(spark, hard, name):
    path, con = hard
    got = compare(spark, name, QUERIES[name], ORACLE[name], path, con)
    assert got["ok"], got


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for t, schema in {"documents": "doc_id bigint, text string, lang string", "embeddings": "vec_id bigint, embedding array<float>", "benchmark": "item_id bigint, text string", "pages": "page_id bigint, url string, html string",
                      "labels": "doc_id bigint, quality int, toxic int"}.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []
