"""MinHash near-dedup by a signature-coordinate inverted join, confirmed on full shingle sets.

1. Each document becomes a set of word shingles; equal sets are one class. Documents are posted under
   pairs of signature coordinates and their values; two sets that agree to 0.85 share none of the 16
   lists with probability below 2e-9.
2. Lists are merged towards a pivot, the member whose lists are longest: collisions with pivots are
   counted, each class is compared on full sets with the pivot it meets most often, and links unite
   to components. Members of one component are skipped from here on.
3. What lists still hold of different components is merged exactly: shingles are ordered by rarity, a
   pair must share one within both prefixes, at places that leave room for the overlap (the match
   threshold). These pairs are confirmed on full sets too.

A group of copies is one class, a group of near copies costs one comparison a member plus its
outliers; no group is expanded into all pairs.

Texts without words (null, empty) have an empty set and are linked with nothing. Repeated rows are
copies. Rows that share an id are one node. A null id is linked with nothing: its component is null
and it is kept. Columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalytics.llm import repeats, scan
from pedalytics.llm.components import components
from pedalytics.session import release, stage

SHINGLE = 5
PERCENT = 80
COORDINATES = 32
_A = np.random.default_rng(11).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = np.random.default_rng(13).integers(1, 1 << 63, COORDINATES, dtype=np.uint64)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bounds, hashes): distinct k-word shingles of each text, sorted, chunk by chunk.

    A text of fewer words is one shingle as a whole; a text without words has none.
    """
    for texts in scan.chunks(column):
        tokens = scan.word_tokens(texts, fold=True)
        start, value = scan.grams(tokens, k)
        words = np.diff(tokens.bounds)
        short = np.flatnonzero((words > 0) & (words < k))
        whole = scan.stretch_hashes(scan.prefix_hashes(tokens.value), tokens.bounds[short], tokens.bounds[short + 1])
        owner = np.concatenate([np.searchsorted(tokens.bounds, start, "right") - 1, short])
        value = np.concatenate([value, whole])
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        new = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))[: len(owner)]
        yield texts.first, np.searchsorted(owner[new], np.arange(len(texts) + 1)), value[new]


def sketches(texts: DataFrame, k: int) -> DataFrame:
    """(_id, _mark, n, a, b, lists): set size, 128-bit hash of the set, keys of its coordinate lists."""
    schema = pa.schema([("_id", pa.int64()), ("_mark", pa.int64()), ("n", pa.int64()), ("a", pa.int64()),
                        ("b", pa.int64()), ("lists", pa.list_(pa.int64()))])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, bounds, value in shingle_sets(batch.column(2), k):
                n = np.diff(bounds)
                rows = slice(first, first + len(n))
                full = np.flatnonzero(n)
                at = bounds[full]
                a, b = np.zeros((2, len(n)), np.uint64)
                lists = np.zeros((len(n), COORDINATES // 2), np.uint64)
                if len(full):
                    a[full] = np.add.reduceat(scan.mix(value), at)
                    b[full] = np.add.reduceat(scan.mix(value ^ np.uint64(0x5851F42D4C957F2D)), at)
                    least = [np.minimum.reduceat(value * m + c, at) for m, c in zip(_A, _B)]
                    for i in range(COORDINATES // 2):
                        lists[full, i] = scan.mix(scan.mix(least[2 * i] + np.uint64(i)) ^ least[2 * i + 1])
                width = np.where(n > 0, COORDINATES // 2, 0)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(width)).astype(np.int32)), pa.array(lists[n > 0].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[rows], batch.column(1)[rows], pa.array(n.astype(np.int64)),
                     pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), flat], schema=schema)

    return texts.mapInArrow(sketch, "_id long, _mark long, n long, a long, b long, lists array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Of ``pairs`` (x, xm, y, ym) the links (a, b) whose full sets agree to ``percent``."""
    left = texts.toDF("x", "xm", "tx")
    right = texts.toDF("y", "ym", "ty")
    met = pairs.join(left, ["x", "xm"]).join(right, ["y", "ym"]).select("x", "y", "tx", "ty")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def sets(column: pa.Array) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for _, bounds, value in shingle_sets(column, k):
            out += np.split(value, bounds[1:-1])
        return out

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keep = []
                for p, q in zip(sets(part.column(2)), sets(part.column(3))):
                    shared = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
                yield pa.RecordBatch.from_arrays(list(part.select([0, 1]).filter(pa.array(keep, pa.bool_())).columns), schema=schema)

    return met.mapInArrow(check, "a long, b long")


def exploded_sets(texts: DataFrame, k: int) -> DataFrame:
    """(_id, _mark, shingle, n): every distinct shingle of each text."""
    schema = pa.schema([("_id", pa.int64()), ("_mark", pa.int64()), ("shingle", pa.int64()), ("n", pa.int64())])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, bounds, value in shingle_sets(batch.column(2), k):
                n = np.diff(bounds)
                take = pa.array(np.repeat(np.arange(len(n)), n) + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take),
                     pa.array(value.view(np.int64)), pa.array(np.repeat(n, n).astype(np.int64))], schema=schema)

    return texts.mapInArrow(explode, "_id long, _mark long, shingle long, n long")


def near_duplicates(
    docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``; an empty table gives none.

    Two documents are linked if 100 * shared shingles >= ``percent`` * shingles of either. ``kept``
    marks the smallest id of each component.
    """
    texts = repeats.keyed(docs, id_col, text_col)
    rows = stage(sketches(texts, k), "sketches")
    classes = rows.where("n > 0 AND _id IS NOT NULL").groupBy("a", "b").agg(
        F.min(F.struct("_id", "_mark")).alias("head"), F.first("n").alias("n"), F.first("lists").alias("lists"))
    classes = stage(classes, "classes")
    posted = classes.select("head._id", "head._mark", "n", F.explode("lists").alias("key"))
    long_ = stage(posted.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "coordinate-lists")
    posted = stage(posted.join(long_, "key"), "postings")
    among = stage(
        repeats.with_texts(texts, posted.select("_id", "_mark").distinct()).dropDuplicates(["_id", "_mark"]), "candidate-texts")

    length = posted.groupBy("_id", "_mark").agg(F.sum("m").alias("m"))
    length = stage(length.withColumnRenamed("m", "total"), "list-lengths")
    pivots = posted.join(length, ["_id", "_mark"]).groupBy("key").agg(
        F.max(F.struct("total", (-F.col("_id")).alias("back"), "_mark")).alias("p"))
    pivot_table = stage(pivots, "pivots")
    pivots = pivot_table.select("key", (-F.col("p.back")).alias("y"), F.col("p._mark").alias("ym"))
    hits = posted.join(pivots, "key").where("_id <> y").groupBy("_id", "_mark", "y", "ym").count()
    best = hits.groupBy("_id", "_mark").agg(F.max(F.struct("count", "y", "ym")).alias("p"))
    best = best.select(F.col("_id").alias("x"), F.col("_mark").alias("xm"), "p.y", "p.ym")
    first_links = stage(confirmed(best, among, k, percent), "pivot-links")
    release(long_, length, pivot_table)

    found = components(first_links)
    # Sets that may be linked are of one size band, or of neighbouring ones: band b + 1 begins 100 / percent times higher.
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent + 1e-9)).cast("int")
    labelled = posted.join(found, posted["_id"] == found["node"], "left").select(
        "key", "_id", "_mark", F.coalesce("label", "_id").alias("label"), F.explode(F.array(band, band + 1)).alias("band"))
    open_ = labelled.groupBy("key", "band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    open_ = stage(open_.select("key", "band"), "open-lists")
    active = stage(labelled.join(open_, ["key", "band"]).select("_id", "_mark", "label").distinct(), "open-classes")
    release(posted)
    links = stage(
        confirmed(prefix_pairs(among, active, k, percent), among, k, percent).unionByName(first_links), "all-links")
    release(among, open_, active, first_links)
    found = components(links)

    class_ids = classes.select("a", "b", F.col("head._id").alias("low"))
    low = rows.join(class_ids, ["a", "b"], "left").select(
        "_id", "n", F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("_id")).alias("low"))
    out = low.join(found, low["low"] == found["node"], "left").select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("_id").isNotNull(), F.coalesce("label", "low")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def one_of_each(
    docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component of ``docs``, with all columns.

    Rows are told apart by id and text, so another text under the same id, or under none, is judged by
    itself; rows that agree in both are one. Texts without words are linked with nothing.
    """
    text = F.col(f"`{text_col}`")
    key = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{id_col}`").isNull(), repeats.mark(text))
    found = near_duplicates(docs.select(key.alias("key"), text.alias("text")), k, percent, "key", "text")
    kept = stage(found.where("kept").select("key").distinct(), "kept-keys")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    one = rows.join(kept, "key", "left_semi").withColumn("copy", first).where("copy = 1")
    return one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def prefix_pairs(texts: DataFrame, active: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (x, xm, y, ym) of classes with different labels that may agree to ``percent``."""
    each = exploded_sets(texts.join(active.select("_id", "_mark"), ["_id", "_mark"], "left_semi"), k)
    rare = stage(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shingle-counts")
    shared = each.join(rare, "shingle")
    by_class = Window.partitionBy("_id", "_mark")
    place = F.col("n") - F.count(F.lit(1)).over(by_class) + F.row_number().over(by_class.orderBy("df", "shingle")) - 1
    prefix = shared.withColumn("place", place).where(f"100 * (n - place) >= {percent} * n")
    prefix = stage(prefix.join(active, ["_id", "_mark"]).select("shingle", "_id", "_mark", "label", "n", "place"), "prefixes")
    p, q = prefix.alias("p"), prefix.alias("q")
    room = F.least(F.col("p.n") - F.col("p.place"), F.col("q.n") - F.col("q.place")) * (100 + percent)
    pairs = p.join(q, F.col("p.shingle") == F.col("q.shingle")).where(
        (F.col("p.label") < F.col("q.label")) & (room >= (F.col("p.n") + F.col("q.n")) * percent)
        & (F.least("p.n", "q.n") * 100 >= F.greatest("p.n", "q.n") * percent))
    return pairs.select(F.col("p._id").alias("x"), F.col("p._mark").alias("xm"),
                        F.col("q._id").alias("y"), F.col("q._mark").alias("ym")).distinct()


def op6_minhash_dedup(spark, sf_dir):
    """Near-duplicate components of all documents: three-word shingles, similarity 0.85."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, percent=85)
