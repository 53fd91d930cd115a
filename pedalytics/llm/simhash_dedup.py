"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint has 64 bits, each the majority of that bit among the hashes of a text's word shingles.
For radius r every bit position gets a non-zero vector of r + 1 bits; each non-zero vector v of that
length gives a table, whose mask holds the positions whose vector has an odd product with v. The
vectors of r differing positions do not span all r + 1 dimensions, so some v has an even product with
all of them: its mask leaves out every differing bit, and the pair collides in that table. No pair
within the radius is missed, by construction; at radius 2 that takes 7 tables of 36 or 37 bits.

Equal fingerprints are one class. Buckets of few classes are compared in pairs, and only pairs within
the radius come out. In a bucket of more, classes are filed again under what remains when any r of the
bits outside the mask are left out: those that agree there (at most 2**r) are within the radius, and all
pairs of the bucket within the radius agree somewhere, so the work grows with the bucket, not its square.

A text of fewer words than a shingle is one shingle; a text without words (null, empty) has the
fingerprint zero and is linked like any other. Rows that share an id are one node. A row without id
gets the component of its fingerprint, null if no row with an id is in it. Repeated rows are copies.
Very long texts are read in pieces. An empty table gives no rows. Columns other than id and text are
ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalytics.llm.components import components
from pedalytics.session import stage

SHINGLE = 5
RADIUS = 2
SEED = 42
CROWD = 32  # classes of a bucket that are compared in pairs
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(text: bytes, k: int) -> Iterator[np.ndarray]:
    """XXH64 of every k consecutive lower-cased words joined by a space, repeats included, piece by piece."""
    at, tail, short = 0, [], True
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        words = tail + text[at:end].lower().split()
        at = end
        if len(words) >= k:
            joined = b" ".join(words)
            stop = np.cumsum([len(w) + 1 for w in words]) - 1
            start = np.append(0, stop[:-1] + 1)[: len(words) - k + 1]
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(joined[a:b], SEED) for a, b in zip(start.tolist(), stop[k - 1 :].tolist())], np.uint64)
            short = False
        tail = words[len(words) - k + 1 :] if len(words) >= k else words
    if short and tail:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], np.uint64)


def simhash(text: bytes, k: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, k):
        for part in np.array_split(hashes, len(hashes) // 65_536 + 1):
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the fingerprint of every row."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([simhash(t.as_py() or b"", k) for t in texts], pa.int64())], names=["id", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(marks, "id long, x long")


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def masks(radius: int) -> list[int]:
    """The masks of the covering family, each 64 bits."""
    vectors = (1 << radius + 1) - 1
    of = [1 + i % vectors for i in range(64)]
    return [sum(1 << i for i in range(64) if (of[i] & v).bit_count() & 1) for v in range(1, vectors + 1)]


def links(classes: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """(a, b) of distinct fingerprints ``classes`` (x): links that connect all pairs within the radius.

    Each link is within the radius. Pairs of a crowded bucket are linked through their least member.
    """
    family = masks(radius)
    filed = F.array(*[
        F.struct(F.lit(t).alias("table"), F.col("x").bitwiseAND(F.lit(signed(m))).alias("key")) for t, m in enumerate(family)])
    posted = classes.select("x", F.explode(filed).alias("p")).select("x", "p.table", "p.key")
    shared = stage(posted.groupBy("table", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "simhash-buckets")
    members = stage(posted.join(shared, ["table", "key"]), "simhash-members")

    few = members.where(F.col("size") <= crowd).select("table", "key", "x")
    a, b = few.alias("a"), few.alias("b")
    near = F.bit_count(F.col("a.x").bitwiseXOR(F.col("b.x"))) <= radius
    met = (F.col("a.table") == F.col("b.table")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.x") < F.col("b.x"))
    pairs = a.join(b, met & near).select(F.col("a.x").alias("a"), F.col("b.x").alias("b"))

    rest = [np.array([signed((1 << 64) - 1 - sum(1 << i for i in left_out)) for left_out in combinations(
        [i for i in range(64) if not m >> i & 1], radius)], np.int64) for m in family]

    def refiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, x = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for t in np.unique(table):
                mine = x[table == t]
                for at in range(0, len(mine), 256):
                    part = mine[at : at + 256]
                    keys = part[:, None] & rest[t][None, :]
                    n = keys.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(keys.size, t, np.int32)), pa.array(np.tile(np.arange(n, dtype=np.int32), len(part))),
                         pa.array(keys.ravel()), pa.array(np.repeat(part, n))], names=["table", "bits", "rest", "x"])

    many = members.where(F.col("size") > crowd).select("table", "x").mapInArrow(
        refiled, "table int, bits int, rest long, x long")
    agree = many.groupBy("table", "bits", "rest").agg(F.collect_set("x").alias("xs"))  # at most 2**radius each
    agree = agree.where(F.size("xs") > 1).select(F.array_min("xs").alias("a"), F.explode("xs").alias("b")).where("a <> b")
    return pairs.unionByName(agree).distinct()


def near_duplicates(
    docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id) for every row; ``component_id`` is the smallest id reachable."""
    rows = stage(fingerprints(docs, k, id_col, text_col), "simhashes")
    classes = stage(rows.groupBy("x").agg(F.min("id").alias("head")), "simhash-classes")
    several = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("x").alias("a"), F.max("x").alias("top")).where("a < top")
    one_id = rows.join(several, "id").where("x <> a").select("a", F.col("x").alias("b"))
    found = components(links(classes.select("x"), radius).unionByName(one_id))
    labelled = classes.join(found, classes["x"] == found["node"], "left").select(
        "x", "head", F.coalesce("label", "x").alias("label"))
    labelled = stage(labelled, "simhash-labels")
    least = labelled.groupBy("label").agg(F.min("head").alias("component_id"))
    named = stage(labelled.join(least, "label").select("x", "component_id"), "simhash-components")
    return rows.join(named, "x").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("x"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash_dedup(spark, sf_dir):
    """SimHash components of all documents: three-word shingles, two differing bits."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3)
