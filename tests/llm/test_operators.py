"""The operators against plain versions on small tables with awkward rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from pedalytics.llm import (
    decontamination,
    fingerprints,
    html_extraction,
    minhash_dedup,
    quality,
    sentencepiece,
    substring_dedup,
    suffix_dedup,
    token_counts,
    url_filters,
)

RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdeé") for _ in range(RNG.randint(1, 6))) for _ in range(60)]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    line, base = prose(45), prose(120)
    texts = [None, "", "  \n", "One", "Two words", base, base, base.replace(" ", "  ", 3), prose(30) + " " + line]
    texts += [line + "\n" + prose(20), prose(10) + " " + line + " " + prose(3), "x " * 150, prose(3000) + line]
    words = base.split()
    texts += [" ".join(words[:i] + ["new"] + words[i + 1 :]) for i in (3, 50, 119)]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(i, t, "en", "s", len(t or ""), "clash") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, starts string")


def test_substring_dedup(docs, rows):
    got = substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect())) == sorted(brute.substring_dedup(rows))


@pytest.mark.parametrize("most, crowd", [(30_000, 256), (2, 1), (20, 1)])
def test_suffix_dedup(docs, rows, monkeypatch, most, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    whole = suffix_dedup.earlier_stretches
    monkeypatch.setattr(suffix_dedup, "earlier_stretches", lambda *a: whole(*a, most=most))
    got = suffix_dedup.remove_earlier(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect())) == sorted(brute.suffix_dedup(rows))


def test_merge_sort_orders_suffixes():
    data = np.frombuffer(b"banana bandana banana" * 3, np.uint8)
    at = np.arange(len(data) - 12)
    order = suffix_dedup.merge_sort(data, at, np.zeros(len(at), np.int64), 12, 0)
    raw = data.tobytes()
    assert [raw[i : i + 12] for i in at[order]] == sorted(raw[i : i + 12] for i in at)


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_minhash_dedup(docs, rows, k, percent):
    got = minhash_dedup.near_duplicates(docs, k, percent)
    assert sorted(map(tuple, got.collect())) == sorted(brute.minhash_dedup(rows, k, percent))


def test_decontamination(spark, docs, rows):
    items = [(6, "x " * 12), (7, "y x " + "x " * 9), (1, rows[5][1][:200]), (2, "two WORDS"), (3, None), (4, "!"), (2, "two words"), (5, prose(40))]
    found = decontamination.hits(docs, spark.createDataFrame(items, "item_id int, text string"))
    got = found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), "contaminated")
    assert sorted(map(tuple, got.collect())) == sorted(brute.decontamination(rows, items))


def test_fingerprints(docs, rows):
    got = fingerprints.match_fingerprints(docs).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(brute.edited_texts(rows))
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5]["fingerprint"] == by_id[6]["fingerprint"] and all(0 <= r["near_edited"] <= 1 for r in got)


def test_documents_with_few_band_terms_are_told_apart(spark):
    # "t0" to "t39" are in two documents of 80 each, so they are the band; each document has one of them.
    texts = [f"t{i % 40} " + " ".join(f"w{i}x{j}" for j in range(30)) for i in range(80)]
    data = spark.createDataFrame(list(enumerate(texts)) + [(100, texts[0]), (101, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.match_fingerprints(data).collect()}
    assert len({got[i]["fingerprint"] for i in range(80)}) == 80 and got[100]["fingerprint"] == got[0]["fingerprint"]
    assert max(got[i]["near_next"] for i in range(1, 80)) < 0.3
    edited = [got[i]["near_edited"] for i in range(80)]
    assert max(edited) < 1 and sum(edited) / 80 > 0.3


def test_likeness_across_kinds(spark):
    # A long document whose band terms fill many parts, next to one with the same words but few of the band.
    a, b = "all-1.aaaa.bbbb", "all-2.aaaa.cccc"
    row = spark.range(1).select(
        fingerprints.alike(F.lit("1234.----"), F.lit(a), F.lit(b), F.lit(b)).alias("x"),
        fingerprints.alike(F.lit("1234.----"), F.lit(a), F.lit("1234.5678"), F.lit(b)).alias("y")).first()
    assert row["x"] == pytest.approx(1 / 3) and row["y"] == 0.5


def test_sentencepiece_round_trip(docs, rows):
    coded = sentencepiece.encoded(docs)
    assert all(r["round_trip"] for r in coded.collect())
    assert {r["doc_id"]: r["text"] for r in sentencepiece.decoded(coded).collect()} == {i: t or "" for i, t in rows}


def test_stretches_solved_together():
    t = sentencepiece.transducer(sentencepiece.MODEL)
    draw = random.Random(3)
    letters = "\u2581abcdeft h\u00e9\u4f60\u597d\U0001f389ing\u0e17\u200b"
    many = ["".join(draw.choices(letters, k=draw.randint(1, 30))) for _ in range(500)] + ["a", "\U0001f389", "\n"]
    assert t.shortest_of_many(many) == [np.array(t.shortest(x)[1], np.int32).tobytes() for x in many]
    assert [len(x) for x in t.encode_many(["", "ab" * 500, ""])][::2] == [0, 0]


def test_pieces_are_the_models_own(docs, rows):
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_file=sentencepiece.MODEL)
    got = {r["doc_id"]: r["ids"] for r in sentencepiece.encoded(docs).collect()}
    assert got == {i: own.encode(t or "") for i, t in rows}
    t = sentencepiece.transducer(sentencepiece.MODEL)
    texts = ["Elle a  vu", "a\u2581b", " " * 300 + "y", "internationalisation" * 20, "\u4f60\u597d\U0001f389\U0001f389 x\ty\r\n\u200b", "\0"]
    draw = random.Random(4)
    texts += ["".join(draw.choices("abcdefthing \n\u2581h\u00e9\U0001f389", k=draw.randint(1, 40))) for _ in range(500)]
    assert [x.tolist() for x in t.encode_many(texts)] == own.encode(texts)
    assert [t.merged(t.normalise(x)) for x in texts] == own.encode(texts)


def test_shortest_path_is_least():
    t = sentencepiece.transducer(sentencepiece.MODEL)

    def least(text):
        best = [0.0] + [float("inf")] * len(text)
        for j in range(1, len(text) + 1):
            for i in range(j):
                part = text[i:j]
                step = t.pieces[part][0] if part in t.pieces else (
                    sentencepiece.BYTE_COST * len(part.encode()) if j == i + 1 else float("inf"))
                best[j] = min(best[j], best[i] + step)
        return best[-1]

    for text in ("▁hello", "▁▁▁internationalisation", "▁naïve☃", "▁x"):
        assert t.shortest(text)[0] == pytest.approx(least(text))


def test_quality_keeps_the_good(spark):
    good = [(i, prose(60), 1) for i in range(60)]
    bad = [(100 + i, " ".join(w + "%%%" for w in prose(60).split()), 0) for i in range(20)]
    extra = [(200, None), (201, ""), (202, prose(50)), (203, "%%% ".join(WORDS[:40]))]
    docs = spark.createDataFrame([r[:2] for r in good + bad] + extra, "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad], "doc_id long, quality int")
    kept = {r["doc_id"] for r in quality.Resampler(docs, labels).keep(docs).collect()}
    assert len(kept & {r[0] for r in good}) >= 58 and 202 in kept and not kept & ({r[0] for r in bad} | {203})


def test_kth_largest(spark):
    values = [RNG.randint(-(1 << 62), 1 << 62) for _ in range(500)] + [7] * 5
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert [quality.kth_largest(df, k) for k in (1, 250, 505)] == [sorted(values)[-k] for k in (1, 250, 505)]


def test_url_rules(spark):
    urls = ["http://WWW.example.com/en/1", "https://a.example.com/en/2?x=1", "http://example.com/fr/", "ftp://b.net/es/x",
            None, "no scheme", "http://c.org/q", "http://com", "http://xcom/", "http://d.net/fr/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filters.judge(pages).collect()}
    assert [got[i]["rule"] for i in range(10)] == [
        "www.example.com/en/", "example.com/en/", "com/", "net/es/", None, None, None, None, None, "net/fr/"]
    assert got[0]["host"] == "www.example.com" and got[4]["host"] == "" and {r["verdict"] for r in got.values()} <= {"allow", "block"}


def test_suffixes_of_one_class_are_not_blocked(spark):
    urls = [f"http://h{i}.example.com/{'en' if i % 3 else 'fr'}/{i}" for i in range(60)]
    urls += [f"http://h{i}.example.net/{p}/{i}" for i in range(30) for p in ("es", "fr", "de", "en")]
    urls += [f"http://h{i}.example.org/en/{i}" for i in range(30)] + [None, "no scheme"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filters.judge(pages).collect()
    assert len(got) == len(urls) and {r["verdict"] for r in got if r["rule"] is None} == {"allow"}
    assert {r["verdict"] for r in got if r["rule"] == "net/es/"} == {"block"}
    # A suffix with both classes is still judged: long paths are blocked.
    rules = (("org", "/bad/", "block"), ("org", "/good/", "allow"))
    urls = [f"http://h{i}.org/{'bad/' + 'x/' * 20 if i % 4 else 'good/'}{i}" for i in range(200)]
    urls += ["http://new.org/" + "x/" * 22 + "7", "http://new.org/other/7"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filters.judge(pages, rules=rules).collect()}
    assert (got[200], got[201]) == ("block", "allow")
    error = url_filters.held_out_error(pages, rules=rules)
    assert error["n_allow"] and error["n_block"] and not error["wrongly_blocked"] and not error["missed"]


def test_html(spark):
    page = ('<html><head><title>T</title></head><body><nav><ul><li><a>m</a></li></ul></nav><div class="ad">buy now</div>'
            "<article><h1>A &amp;  b</h1><p>one two<p>three <b>four</b></article><footer>f</footer></body></html>")
    pages = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "u", ""), (1, "u", page)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extraction.main_text(pages).collect()}
    assert got == {1: ("A & b\none two\nthree four", 24), 2: ("", 0), 3: ("", 0)}


def test_rollup_is_idempotent(spark, docs, tmp_path):
    rollup = token_counts.TokenRollup(spark, str(tmp_path / "r"))
    rows = token_counts.counted(docs, "v1")
    assert rollup.commit("a", token_counts.inserts(rows)) and not rollup.commit("a", token_counts.inserts(rows))
    before = rollup.totals().collect()
    rollup.commit("b", token_counts.revisions(rows, rows))
    assert rollup.totals().collect() == before and before[0]["n_docs"] == docs.count()
    rollup.commit("c", token_counts.deletes(rows))
    assert rollup.totals().collect() == []


def test_batch_ids_and_writers(spark, docs, tmp_path):
    rows = token_counts.counted(docs.limit(3), "v1")
    rollup = token_counts.TokenRollup(spark, str(tmp_path / "r"))
    names = ["a/b", "a=b", "50%", "a%2Fb", "ä *{x}", "..", "1", "01"]
    assert [rollup.commit(b, token_counts.inserts(rows)) for b in names + names] == [True] * 8 + [False] * 8
    assert rollup.totals().first()["n_docs"] == 3 * len(names)

    class Slow:
        """Changes that another writer commits under the same id while they are being written."""

        def groupBy(self, *group):
            assert rollup.commit("both", token_counts.deletes(rows))
            return token_counts.deletes(rows).groupBy(*group)

    assert not rollup.commit("both", Slow())
    assert rollup.totals().first()["n_docs"] == 3 * (len(names) - 1)
    assert not [p for p in (tmp_path / "r").rglob("_writing-*")]


def test_token_totals_are_over_all_rows(spark, tmp_path):
    texts = ["One two", "Only these words", "", None]
    data = [(i if i % 7 else None, texts[i % 4], ["en", "fr", None][i % 3], "ab"[i % 2], 0) for i in range(60)]
    data += [(3, "Only these words", "en", "a", 0)] * 3
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"])
           for r in token_counts.op9_token_counts(spark, str(tmp_path)).collect()}
    plain, encoding = {}, token_counts._encoding(token_counts.RANKS)
    for _, text, lang, source, _ in data:
        n, total = plain.get((source, lang, "byte-bpe-50k"), (0, 0))
        plain[source, lang, "byte-bpe-50k"] = (n + 1, total + len(encoding.encode_ordinary(text or "")))
    assert got == plain


def test_revisions_and_versions_count(spark, docs, tmp_path):
    rollup = token_counts.TokenRollup(spark, str(tmp_path / "r"))
    old = token_counts.counted(docs, "v1")
    new = token_counts.counted(docs.withColumn("text", F.lit("One two three")), "v1")
    rollup.commit("a", token_counts.inserts(old))
    rollup.commit("b", token_counts.revisions(old, new))
    rollup.commit("c", token_counts.inserts(token_counts.counted(docs, "v2", token_counts.SECOND_RANKS)))
    got = {r["tokenizer"]: (r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()}
    n = docs.count()
    assert got["v1"] == (n, 3 * n) and got["v2"][0] == n and got["v2"][1] > 0


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert substring_dedup.remove_repeats(none).count() == suffix_dedup.remove_earlier(none).count() == 0
    assert minhash_dedup.near_duplicates(none).count() == fingerprints.match_fingerprints(none).count() == 0
    assert sentencepiece.encoded(none).count() == 0


def test_digest_is_of_utf8():
    assert hashlib.sha256("é".encode()).hexdigest() == brute.edited_texts([(1, "é")])[0][2]


def test_slices_hold_all_rows_in_order():
    import pyarrow as pa

    from pedalytics.llm import scan

    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], names=["n"]) for n in (0, 3, 7)]
    got = list(scan.slices(iter(batches), 3))
    assert [b.column(0).to_pylist() for b in got] == [[0, 1, 2], [0, 1, 2], [3, 4, 5], [6]]
