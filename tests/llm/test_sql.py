"""The queries that have SQL against it, on the small tables and on a few odd texts."""

import compare
import pytest

from pedalytics.llm import queries

SF = "/root/testdata/sf0.001"
ON_TEXTS = ("op1_substring_dedup", "op5_decontamination", "op6_minhash_dedup", "op10_suffix_dedup")

PASSAGE = " ".join(f"wort{i} Straße" for i in range(40))
TEXTS = [
    (1, None), (2, ""), (3, " \t "), (4, "Two words"), (5, "two WORDS"), (6, PASSAGE), (7, f"before {PASSAGE} after"),
    (8, f"{PASSAGE} {PASSAGE}"), (9, "ab " * 300), (10, "é" * 150), (11, PASSAGE.lower()), (12, "a\u00a0b\x0bc\x1fd"),
]
ITEMS = [("i1", PASSAGE[:200]), ("i2", "words"), ("i3", ""), ("i4", None), ("i5", "Two words")]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    for table, rows, schema in (("documents", TEXTS, "doc_id long, text string"), ("benchmark", ITEMS, "item_id string, text string")):
        spark.createDataFrame(rows, schema).toPandas().to_parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_small_tables(spark, name):
    assert compare.difference(queries.QUERIES[name](spark, SF), compare.connect(SF), queries.ORACLE[name]) is None


@pytest.mark.parametrize("name", ON_TEXTS)
def test_odd_texts(spark, odd, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{odd}/{table}.parquet')")
    assert compare.difference(queries.QUERIES[name](spark, odd), con, queries.ORACLE[name]) is None
