"""Vector codes, SimHash components and source divergence against plain versions."""

import random

import numpy as np
import pytest

import brute
from pedalytics.llm import simhash_dedup, source_divergence, vector_codes
from pedalytics.llm.queries import ORACLE, QUERIES

RNG = random.Random(17)
VECTORS = "vec_id long, embedding array<float>, label int, at int, codes string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def vectors(n, width=32):
    return [np.float32([RNG.gauss(0, 0.1) for _ in range(width)]).tolist() for _ in range(n)]


@pytest.mark.parametrize("n", [0, 5, 150])
def test_vector_codes(spark, monkeypatch, n):
    monkeypatch.setattr(vector_codes, "BLOCK", 20)
    rows = [(i * 3 % 151 if i % 40 else None, v, [None, 1, 2][i % 3]) for i, v in enumerate(vectors(n))]
    rows += [(7, None, 1), (8, [float("nan")] * 32, 1), (9, [None] + [0.0] * 31, 1), (10, [float("-inf")] * 32, None)]
    rows += rows[:2] + [(4, [0.25] * 32, 1), (4, [0.25] * 32, 1)] if n else []
    data = spark.createDataFrame([(*r, 0, "clash") for r in rows], VECTORS)
    assert rows_of(vector_codes.compressed(data)) == sorted(brute.vector_codes(rows), key=repr)


def test_vectors_of_other_lengths_and_sizes(spark):
    rows = [(1, [0.5] * 20, 1), (2, [0.5], 1), (3, [], 2), (4, [1e30] * 17, None), (5, [-1e30] * 20, None), (6, [3e7] * 20, 3)]
    data = spark.createDataFrame([(*r, 0, "") for r in rows], VECTORS)
    full = [(i, [max(min(np.float32(x).item(), 10**18 / 256), -(10**18) / 256) for x in v] + [0.0] * (32 - len(v)), c) for i, v, c in rows]
    expected = [(i, code, min(e, vector_codes.MOST), min(s, vector_codes.MOST), d) for i, code, e, s, d in brute.vector_codes(full)]
    assert rows_of(vector_codes.compressed(data)) == sorted(expected, key=repr)


def test_distances_are_the_same_in_all_number_types():
    words = [np.unique(np.array([RNG.randint(-500, 500) for _ in range(30)])) for _ in range(32)]
    codes = np.array([[RNG.randrange(len(w)) for _ in range(40)] for w in words])
    books = np.array([[[RNG.randint(-500, 500) for _ in range(2)] for _ in range(9)] for _ in range(16)])
    nearest, error = vector_codes.assigned(words, codes, books)
    for factor in (1 << 20, 1 << 45):
        other, far = vector_codes.assigned([w * factor for w in words], codes, books * factor)
        assert (other == nearest).all() and far.tolist() == [[int(e) * factor**2 for e in row] for row in error]


def texts(n):
    words = ["".join(RNG.choice("abcdeé") for _ in range(RNG.randint(1, 5))) for _ in range(50)]
    out = [None, "", " \n\t", "One", "one", "Two words", "A b C", "a B c d"]
    for _ in range(n):
        base = [RNG.choice(words) for _ in range(RNG.randint(3, 80))]
        out.append(" ".join(base))
        for _ in range(RNG.randint(0, 3)):
            base[RNG.randrange(len(base))] = RNG.choice(words)
            out.append("  ".join(base) + "\n")
    return out


@pytest.mark.parametrize("k", [3, 5])
def test_simhash(spark, k):
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts(60))]
    rows += [(3, "another text under id three"), (900, None), (901, rows[20][1]), (901, rows[20][1])]
    data = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, table string, x int")
    assert rows_of(simhash_dedup.near_duplicates(data, k)) == sorted(brute.simhash_dedup(rows, k), key=repr)


def test_simhash_reads_long_texts_in_pieces(monkeypatch):
    text = " ".join(str(RNG.randint(0, 999)) for _ in range(4000)).encode()
    whole = simhash_dedup.simhash(text, 3)
    monkeypatch.setattr(simhash_dedup, "PIECE", 5)
    assert simhash_dedup.simhash(text, 3) == whole == simhash_dedup.simhash(b"\n " + text.replace(b" ", b"   ") + b"\t", 3)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_pair_in_the_radius_meets(radius):
    family = simhash_dedup.masks(radius)
    assert len(family) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        bits = RNG.sample(range(64), RNG.randint(1, radius))
        assert any(not any(m >> b & 1 for b in bits) for m in family)


@pytest.mark.parametrize("crowd", [2, 1000])
def test_links_of_crowded_buckets(spark, crowd):
    center = RNG.getrandbits(64)
    xs = {center} | {center ^ sum(1 << b for b in RNG.sample(range(64), RNG.randint(1, 4))) for _ in range(150)}
    xs |= {RNG.getrandbits(64) for _ in range(30)}
    data = spark.createDataFrame([(simhash_dedup.signed(x),) for x in xs], "x long")
    found = simhash_dedup.links(data, crowd=crowd).collect()
    apart = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    assert all(0 < apart(r["a"], r["b"]) <= 2 for r in found)

    def groups(edges):
        root = {simhash_dedup.signed(x): simhash_dedup.signed(x) for x in xs}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            a, b = sorted((top(a), top(b)))
            root[b] = a
        return {x: top(x) for x in root}

    every = sorted(simhash_dedup.signed(x) for x in xs)
    assert groups(map(tuple, found)) == groups((a, b) for a in every for b in every if a < b and apart(a, b) <= 2)


def test_source_divergence(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "HELD", 50)
    words = ["".join(RNG.choice("abcéÉX") for _ in range(RNG.randint(1, 3))) for _ in range(60)]
    rows = [(" 1".join(RNG.choices(words, range(60), k=RNG.randint(0, 80))), RNG.choice(["en", "de", None]), RNG.choice(["a", "b", "c", "", None]))
            for _ in range(150)]
    rows += [(None, "en", "silent"), ("only rare words", "xx", "a"), ("", "xx", "b"), (None, None, None)] + rows[:3]
    data = spark.createDataFrame([(*r, 0, "") for r in rows], "text string, lang string, source string, n int, term string")
    expected = sorted(brute.source_divergence(rows), key=repr)
    assert rows_of(source_divergence.audit(data)) == expected
    monkeypatch.setattr(source_divergence, "pair_sums", lambda *a, whole=source_divergence.pair_sums: whole(*a, block=7))
    monkeypatch.setattr(source_divergence, "PIECE", 3)
    assert rows_of(source_divergence.audit(data)) == expected


def test_shares_do_not_overflow():
    n, whole = 8 * 10**15, 9 * 10**15 - 1
    assert source_divergence.shares(np.array([n, 0]), whole).tolist() == [1 + 10**9 * (x + 2) // whole for x in (n, 0)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert simhash_dedup.near_duplicates(docs).count() == source_divergence.audit(docs).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    import compare

    sf = "/root/testdata/sf0.001"
    assert compare.difference(QUERIES[name](spark, sf), compare.connect(sf), ORACLE[name]) is None
