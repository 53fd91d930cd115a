"""The quality classifier and the URL filters on the small tables: plain versions and held-out accuracy."""

import pytest
from pyspark.sql import functions as F

import brute
from pedalytics.llm import quality, scan, url_filters

SF = "/root/testdata/sf0.001"


def test_quality_weights_are_those_of_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-5, None), (-6, ""), (-7, "Ein WORT wort, wort ?? \u00c9t\u00e9\x0b9")], "doc_id long, text string")
    docs = docs.unionByName(extra)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    marks = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    assert set(marks.values()) == {0, 1}
    rows = [tuple(r) for r in docs.collect()]
    plain = brute.quality_weights(rows, marks, scan.BYTE_VALUES.tolist(), scan._BASES, quality.SEED)
    got = {r["doc_id"]: r for r in quality.Resampler(docs, labels).weights(docs).collect()}
    assert set(got) == set(plain)
    for i, (weight, n, kept) in plain.items():
        assert got[i]["log_weight"] == pytest.approx(weight, abs=1e-5) and (got[i]["n_grams"], got[i]["kept"]) == (n, kept)


def test_quality_of_labels_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality IS NOT NULL")
    out = F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(3)) == 0
    found = quality.Resampler(docs, labels.where(~out)).weights(docs).join(labels.where(out), "doc_id")
    kept = {r["quality"]: r["share"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.95 and kept[0] < 0.2, kept


def test_quality_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["kept"] for r in quality.Resampler(docs, none).weights(docs).collect()] == [True, True]
    empty = docs.limit(0)
    some = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    assert quality.Resampler(empty, some).weights(empty).count() == 0


def test_rules_and_features_of_every_page(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    odd = ["HTTP://A.Example.COM/en/?q=1&r=2#f", "http://example.com", "x://://net/es/", "http://h-1.net/fr/7", "http://net/es", "", "://", None]
    pages = pages.unionByName(spark.createDataFrame([(-1 - i, u) for i, u in enumerate(odd)], "page_id long, url string"))
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    got = url_filters.judge(pages).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = brute.url_rule(urls[r["page_id"]], url_filters.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    base = url_filters.with_rules(pages, "page_id", "url").where("url <> ''")
    for r in url_filters.lexical_features(base, "url").collect():
        plain = brute.url_features(r["url"], r["host"], r["path"])
        assert {k: r[k] for k in plain} == pytest.approx(plain)


def test_urls_of_empty_and_clashing_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "s", "h")], "page_id long, url string, suffix string, host string")
    assert [tuple(r)[:5] for r in url_filters.judge(pages).collect()] == [(1, "a.com", "/x", "com/", "allow")]
    assert url_filters.judge(pages.limit(0)).count() == 0


def test_trees_score_urls_that_no_rule_decides(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    got = [r for r in url_filters.judge(pages).collect() if r["rule"] is None]
    assert len({r["score"] for r in got}) > 1 and all(0 < r["score"] < 1 for r in got)


def urls_of_one_class_each(n):
    urls = [f"http://h{i}.a.com/{'x/' * (i % 7)}{i}" for i in range(n)]
    urls += [f"http://h{i}.net/es/{'x/' * (12 + i % 7)}{i}" for i in range(n)]
    return [*urls, "http://q.org/x", "http://q.org/" + "x/" * 20, "http://q.net/de/", "http://q.net/de/" + "x/" * 20]


def test_trees_judge_urls_of_suffixes_without_both_classes(spark):
    """Allowed and blocked labels lie in different suffixes; the trees are trained, and decide if enough URLs are allowed."""
    for n, verdicts in ((80, ["allow", "block"] * 2), (40, ["allow"] * 4)):
        urls = urls_of_one_class_each(n)
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        got = {r["page_id"]: r for r in url_filters.judge(pages).collect()}
        judged = [got[i] for i in range(2 * n, 2 * n + 4)]
        assert [r["verdict"] for r in judged] == verdicts
        assert judged[0]["score"] < 0.5 < judged[1]["score"] and judged[2]["score"] < 0.5 < judged[3]["score"]
        assert all(got[i]["verdict"] == ("allow" if i < n else "block") for i in range(2 * n))


def test_tolerated_errors(spark):
    assert [url_filters.tolerated(n) for n in (0, 1, 58, 59, 92, 93, 345)] == [-1, -1, -1, 0, 0, 1, 10]
