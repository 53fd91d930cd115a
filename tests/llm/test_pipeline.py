"""The corpus pipeline against a plain version, and rows that only their text tells apart."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from pedalytics.llm import decontamination, minhash_dedup, quality, sentencepiece, substring_dedup, suffix_dedup

RNG = random.Random(29)
WORDS = ["".join(RNG.choice("abcdefgé") for _ in range(RNG.randint(2, 7))) for _ in range(300)]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, starts int, lengths int, _mark string, _copy int, row int, key string"


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def twins():
    """Two texts whose hashes agree in the low 24 bits."""
    seen = {}
    for i in range(100_000):
        text = f"{i} " + "alone in the world " + str(i * 7919)
        low = xxhash.xxh64_intdigest(text.encode(), 42) & ((1 << 24) - 1)
        if low in seen:
            return seen[low], text
        seen[low] = text
    raise AssertionError




def test_rows_without_id_are_told_apart(spark, twins):
    a, b = twins
    assert a != b
    rows = [(None, a), (None, b), (1, a), (7, "other " + prose(20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Short windows, so that the repeated text is all of one row and nothing of its twin.
    got = substring_dedup.remove_repeats(docs, window=4, anchor=2).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute.substring_dedup(rows, 4), key=repr)
    items = [(1, a)]
    found = decontamination.hits(docs, spark.createDataFrame(items, "item_id int, text string"))
    got = found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), "contaminated")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute.decontamination(rows, items), key=repr)
    left = decontamination.uncontaminated(docs, spark.createDataFrame(items, "item_id int, text string"))
    assert sorted(r["text"] for r in left.collect()) == sorted([b, rows[3][1]])
    kept = suffix_dedup.remove_earlier(docs, length=len(a) - 2, seed=8).select("doc_id", "n_bytes", "n_removed")
    plain = brute.suffix_dedup([(-1, a), (0, b), *rows[2:]], len(a) - 2)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(None if r[0] < 1 else r[0], r[1], r[2]) for r in plain], key=repr)
    one = minhash_dedup.one_of_each(docs)
    assert sorted(r["text"] for r in one.collect()) == sorted({a, b, rows[3][1]})


def corpus():
    base, line = prose(90), prose(70)
    words = base.split()
    texts = [(1, base), (2, base), (3, " ".join(words[:40] + ["new"] + words[41:])), (4, prose(80)), (None, prose(60)), (None, prose(65))]
    texts += [(4, prose(75)), (5, ""), (6, None), (7, "Two words"), (8, prose(30) + " " + line), (9, line + " " + prose(40)), (9, line + " " + prose(41))]
    texts += [(10, prose(50)), (10, prose(50)), (None, base)]
    texts += [(11, texts[10][1]), (11, texts[10][1])]
    return texts


def near_kept(rows):
    """Groups of near duplicates among different texts, as sets of row numbers; rows of one id and text are one."""
    sets = brute.minhash_dedup([(n, t) for n, (_, t) in enumerate(rows)], 5, 80)
    same = {}
    groups = {}
    for n, (i, t) in enumerate(rows):
        first = same.setdefault((i, t or ""), n)
        groups.setdefault(sets[first][2] if (t or "").split() else ("alone", i, t or ""), set()).add((i, t))
    return list(groups.values())


def test_near_duplicates_go_by_text(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1, 2, "m", 3, 4, "k") for i, t in rows], COLUMNS)
    one = minhash_dedup.one_of_each(docs)
    assert one.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in one.collect()]
    groups = near_kept(rows)
    assert len(got) == len(groups) and all(sum(g in group for g in got) == 1 for group in groups)


def test_run(spark, tmp_path, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, "m", 3, 4, "k") for i, t in rows], COLUMNS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items = [(1, " ".join(rows[13][1].split()[5:20])), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen = []
    real = corpus_pipeline.stage
    monkeypatch.setattr(corpus_pipeline, "stage", lambda df, name: seen.append(real(df, name)) or seen[-1])
    coded = corpus_pipeline.run(spark, str(tmp_path))
    after = [[(r["doc_id"], r["text"]) for r in df.collect()] for df in seen[:4]]
    assert all(df.columns == docs.columns for df in seen[:4])
    assert sorted(after[0], key=repr) == sorted(rows, key=repr)  # labels of one kind teach nothing
    # Stage by stage: each is judged on what its predecessor kept.
    groups = near_kept(after[0])
    assert len(after[1]) == len(groups) and all(sum(g in group for g in after[1]) == 1 for group in groups)
    order = sorted(after[1], key=lambda r: (r[0] is not None, r[0] or 0))
    texts, kept = [], []
    for (i, t), (_, n, gone, *_) in zip(order, brute.suffix_dedup(list(enumerate(t for _, t in order)))):
        if not gone:
            kept.append((i, t))
        else:
            texts.append(i)
    assert [r for r in after[2] if r in kept] and set(kept) <= set(after[2])
    assert {i for i, t in after[2] if (i, t) not in kept} <= set(texts)
    hit = {(i, t) for (i, t), r in zip(after[2], brute.decontamination(list(enumerate(t for _, t in after[2])), items)) if r[-1]}
    assert hit and sorted(after[3], key=repr) == sorted([r for r in after[2] if r not in hit], key=repr)
    decoded = sorted((r["doc_id"], r["text"]) for r in sentencepiece.decoded(coded).collect() if r["doc_id"] is not None)
    assert decoded == sorted((i, t or "") for i, t in after[3] if i is not None)


def test_labels_that_disagree_and_ids_that_repeat(spark):
    good = [(i, prose(60), 1) for i in range(60)]
    bad = [(100 + i, " ".join(w + "%%%" for w in prose(60).split()), 0) for i in range(20)]
    docs = spark.createDataFrame([r[:2] for r in good + bad] + [(100, "%%% again"), (100, "%%% again")], "doc_id long, text string")
    labels = [(i, q) for i, _, q in good + bad] + [(100, 1), (101, None), (None, 1)]
    sampler = quality.Resampler(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    kept = {r["doc_id"] for r in sampler.weights(docs).where("kept").collect()}
    assert len(kept & set(range(60))) >= 58 and not kept & {r[0] for r in bad}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    items = spark.createDataFrame([], "item_id long, text string")
    assert quality.Resampler(docs, labels).keep(docs).count() == quality.Resampler(docs, labels).weights(docs).count() == 0
    assert decontamination.hits(docs, items).count() == decontamination.uncontaminated(docs, items).count() == 0
    assert minhash_dedup.one_of_each(docs).count() == suffix_dedup.without_repeats(docs).count() == 0
    one = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    assert decontamination.uncontaminated(one, items).count() == 2
