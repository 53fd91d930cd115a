"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words and marks, pairs of them, and pairs of their shapes,
with a sign for a repeated word): one of target text, labelled good, one of raw text, all documents.
A document's log weight is the summed log ratio of the two. Gumbel noise, drawn from the row itself,
is added and the k largest are kept, which samples without replacement in proportion to the weights.
k is the number of documents whose weight is above a threshold fitted on labelled documents, each half
of them weighed by a target model of the other half.

The labelled sample is bounded (``TRAIN`` rows, those with the least hashes); the raw model, weights and
selection cover all rows. The k-th largest value is found by counting bins of its bits, so no order is
built; rows tied with it stay together. Repeated rows have the same noise. Null and empty texts have
weight 0. Without labels of both kinds everything is kept. Other columns pass through or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalytics.llm import scan
from pedalytics.session import stage

BUCKETS = 1 << 12
SHRINK = 20.0  # occurrences, in a mean bucket, by which the target model leans on the raw one
TRAIN = 20_000
SEED = 20240607


def features(texts: scan.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, buckets): the hashed n-grams of each text of a chunk."""
    tokens = scan.word_tokens(texts, scan.WORD_OR_MARK, fold=True)
    n = len(tokens.value)
    if n == 0:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(tokens.bounds))
    first = texts.data[tokens.start]
    upper = lambda b: (b >= 0x41) & (b <= 0x5A)
    mark = scan.WORD_OR_MARK[first] == 2
    shape = np.where(mark, 3 + np.minimum(tokens.end - tokens.start, 4), upper(first))
    follows = np.append(False, owner[1:] == owner[:-1])
    before = np.append(tokens.value[:1], tokens.value[:-1])
    same = follows & (before == tokens.value)
    shape = (shape + 10 * same).astype(np.uint64)
    left = np.append(shape[:1], shape[:-1])
    pair = scan.mix(before * np.uint64(3) + tokens.value)[follows]
    shapes = scan.mix(left * np.uint64(1000) + shape + np.uint64(1 << 40))[follows]
    value = np.concatenate([tokens.value, pair, shapes])
    owner = np.concatenate([owner, owner[follows], owner[follows]])
    order = np.argsort(owner, kind="stable")
    return np.searchsorted(owner[order], np.arange(len(texts) + 1)), (scan.mix(value[order]) >> np.uint64(52)).astype(np.int64)


def counts(texts: DataFrame) -> np.ndarray:
    """Occurrences of each bucket in all texts (one column)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for chunk in scan.chunks(batch.column(0)):
                total += np.bincount(features(chunk)[1], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.float64)
    for r in texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]  # one row for each bucket at most
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of each bucket; what is rare in both is near 0."""
    raw = (raw + 1) / (raw.sum() + BUCKETS)
    return np.log((target + SHRINK * BUCKETS * raw) / (target.sum() + SHRINK * BUCKETS)) - np.log(raw)


def log_weights(column: pa.Array, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log weight, number of n-grams) of each text."""
    weight, size = [np.zeros(0)], [np.zeros(0, np.int64)]
    for chunk in scan.chunks(column):
        bounds, buckets = features(chunk)
        total = np.append(0.0, np.cumsum(ratio[buckets]))
        weight.append(np.round(total[bounds[1:]] - total[bounds[:-1]], 6))
        size.append(np.diff(bounds))
    return np.concatenate(weight), np.concatenate(size)


def perturbed(column: pa.Array, ids: pa.Array, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log weight, n-grams, weight plus Gumbel noise as a number of the same order in 64 bits)."""
    weight, size = log_weights(column, ratio)
    noise = [np.zeros(0, np.uint64)]
    for chunk in scan.chunks(column):
        prefix = scan.prefix_hashes(scan.BYTE_VALUES[chunk.data], 1)
        noise.append(scan.stretch_hashes(prefix, chunk.bounds[:-1], chunk.bounds[1:], 1))
    key = np.asarray(ids.cast(pa.int64()).fill_null(-1)).astype(np.uint64)
    uniform = (scan.mix(np.concatenate(noise) ^ scan.mix(key + np.uint64(SEED))) >> np.uint64(11)).astype(np.float64)
    gumbel = -np.log(-np.log((uniform + 0.5) / float(1 << 53)))
    bits = (weight + gumbel).view(np.int64)
    return weight, size, np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def kth_largest(values: DataFrame, k: int) -> int:
    """The k-th largest of a bigint column ``v``: four counts of 16 bits each."""
    found, left = 0, k
    for shift in (48, 32, 16, 0):
        part = values if shift == 48 else values.where(F.shiftright("v", shift + 16) == found)
        high = F.shiftright("v", shift)
        bins = part.groupBy(high.alias("bin")).count().collect()  # at most 65,536 rows
        for r in sorted(bins, key=lambda r: -r["bin"]):
            if r["count"] >= left:
                found = r["bin"]
                break
            left -= r["count"]
    return found


class Resampler:
    """Importance weights and the selection, fitted to ``docs`` and ``labels``."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 train: int = TRAIN):
        self.id_col, self.text_col = id_col, text_col
        labels = labels.select(F.col("doc_id").cast("long").alias("i"), F.col("quality").alias("q"))
        labels = labels.where("i IS NOT NULL AND q IS NOT NULL").groupBy("i").agg(F.min("q").alias("q"))
        n = labels.count()
        share = F.pmod(F.xxhash64("i", F.lit(SEED)), F.lit(1 << 40)) < int((1 << 40) * min(1.0, 0.9 * train / max(1, n)))
        few = F.broadcast(labels.where(share).limit(train))  # at most ``train`` rows
        text = F.coalesce(F.col(text_col), F.lit("")).alias("t")
        sample = stage(docs.select(F.col(id_col).cast("long").alias("i"), text).join(few, "i").groupBy("i", "q").agg(
            F.min_by("t", F.xxhash64("t")).alias("t")), "labelled")  # one text of each id
        kinds = {r["q"] for r in sample.select("q").distinct().limit(3).collect()}
        self.ratio, self.cut = np.zeros(BUCKETS), None
        if not {0, 1} <= kinds:
            return
        raw = counts(docs.select(text))
        half = F.pmod(F.xxhash64("i"), F.lit(2))
        parts = [counts(sample.where("q = 1").where(half == i).select("t")) for i in (0, 1)]
        self.ratio = log_ratio(parts[0] + parts[1], raw)
        other = [log_ratio(parts[1], raw), log_ratio(parts[0], raw)]

        def score(batches):
            for batch in batches:
                w = [log_weights(batch.column(0), r)[0] for r in other]
                w = np.where(np.asarray(batch.column(2).cast(pa.int32())) == 0, *w)
                yield pa.RecordBatch.from_arrays([pa.array(w), batch.column(1).cast(pa.int32())], names=["w", "q"])

        rows = sample.select("t", "q", half.alias("half")).mapInArrow(score, "w double, q int").collect()  # ``train`` at most
        w = np.array([r["w"] for r in rows])
        good = np.array([r["q"] for r in rows]) == 1
        order = np.argsort(w, kind="stable")
        lost = np.cumsum(good[order]) / good.sum()  # good ones below the cut
        gone = np.cumsum(~good[order]) / (~good).sum()
        best = int(np.argmax(gone - 4 * lost))  # a share of good ones lost weighs four times a share of bad ones kept
        threshold = float(w[order[best]]) if gone[best] > 4 * lost[best] else -np.inf
        scores = stage(self._scores(docs), "weights")
        k = scores.where(F.col("log_weight") > F.lit(threshold)).count()
        total = scores.count()
        self.cut = kth_largest(scores.select("v"), k) if 0 < k < total else None

    def _scores(self, docs: DataFrame) -> DataFrame:
        ratio = self.ratio

        def score(batches):
            for batch in batches:
                w, n, v = perturbed(batch.column(1), batch.column(0), ratio)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(w), pa.array(n), pa.array(v)], names=["i", "log_weight", "n_grams", "v"])

        rows = docs.select(F.col(self.id_col).cast("long").alias("i"), F.col(self.text_col).alias("t"))
        return rows.mapInArrow(score, "i long, log_weight double, n_grams long, v long")

    def weights(self, docs: DataFrame) -> DataFrame:
        """(id, log_weight, n_grams, kept) for each row of ``docs``."""
        kept = F.lit(True) if self.cut is None else F.col("v") >= F.lit(self.cut)
        return self._scores(docs).select(F.col("i").alias(self.id_col), "log_weight", "n_grams", kept.alias("kept"))

    def keep(self, docs: DataFrame) -> DataFrame:
        """The kept rows of ``docs`` with all their columns, in one pass without a shuffle."""
        if self.cut is None:
            return docs
        ratio, cut, at = self.ratio, self.cut, [docs.columns.index(c) for c in (self.text_col, self.id_col)]

        def select(batches):
            for batch in batches:
                v = perturbed(batch.column(at[0]), batch.column(at[1]), ratio)[2]
                yield batch.filter(pa.array(v >= cut))

        return docs.mapInArrow(select, docs.schema)


def op4_quality_classifier(spark, sf_dir):
    """Importance weight of every document and whether resampling keeps it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return Resampler(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).weights(docs)
