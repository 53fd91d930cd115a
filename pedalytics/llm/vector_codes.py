"""Vector code compression by per-dimension value dictionaries.

Components become integers, and vectors are filed once in blocks: for each dimension the distinct
integers of the block (its dictionary) and a 16-bit code for each vector. A vector is cut into equal
parts, each position with a codebook of its own. To assign a block to its codebooks, the squared
differences of every dictionary value to all entries are tabulated, so the distances of a part are
gathers from these tables by code, and adds. Each task sums what its blocks give to each entry, and
these sums are added up; what comes to the driver is the model alone (entries x dimensions numbers).

Vectors that are null or hold a null, a NaN or an infinity are left out. A shorter vector reads as
zeros at its end, and the longest one is filled up to a multiple of the parts. Entries start as the
rows of smallest id (null last, rows of one id by their vector); with fewer rows than entries there
are fewer entries. Repeated rows count each. An integer beyond +-10**18 is held there, and a sum of
squares that no long can hold is the greatest long. An empty table gives no rows. Columns other than
id, vector and label are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalytics.session import stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK = 4096  # vectors of a block, below 2**16
HELD = 10**18
MOST = (1 << 63) - 1


def integers(vectors: list | np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component."""
    with np.errstate(over="ignore"):
        found = np.floor(np.asarray(vectors, np.float64) * scale)
    return np.clip(found, -HELD, HELD).astype(np.int64)


def padded(column: pa.ListArray, size: int) -> np.ndarray:
    """The vectors of a column as rows of ``size`` numbers, zeros at the end."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    length = np.diff(column.offsets.to_numpy())
    if (length == size).all():
        return flat.reshape(-1, size)
    out = np.zeros((len(column), size))
    row = np.repeat(np.arange(len(column)), length)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out


def dictionaries(kept: DataFrame, size: int, scale: int) -> DataFrame:
    """Blocks (ids, labels, sizes, words, codes) of ``kept`` (id, label, v).

    ``words`` are the dictionaries of all dimensions, ``sizes`` long each; ``codes`` are 16-bit
    numbers, dimension by dimension.
    """
    ids, labels = (kept.schema[c].dataType.simpleString() for c in ("id", "label"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                found = integers(padded(part.column(2), size), scale)
                words, codes = zip(*(np.unique(found[:, j], return_inverse=True) for j in range(size)))
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                yield pa.RecordBatch.from_arrays(
                    [one(part.column(0)), one(part.column(1)), one(pa.array([len(w) for w in words], pa.int32())),
                     one(pa.array(np.concatenate(words))), pa.array([np.stack(codes).astype(np.uint16).tobytes()])],
                    names=["ids", "labels", "sizes", "words", "codes"])

    return kept.select("id", "label", "v").mapInArrow(
        blocks, f"ids array<{ids}>, labels array<{labels}>, sizes array<int>, words array<long>, codes binary")


def unfiled(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    """Dictionaries and codes (dimension, vector) of a block."""
    sizes = np.array(row["sizes"])
    words = np.split(np.array(row["words"], np.int64), np.cumsum(sizes)[:-1])
    return words, np.frombuffer(row["codes"], np.uint16).reshape(len(sizes), -1)


def assigned(words: list[np.ndarray], codes: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(part, vector) arrays: the nearest entry, ties to the lower one, and its squared distance.

    ``books``: (part, entry, place).
    """
    parts, entries, width = books.shape
    top = max(int(max(abs(w[0]), abs(w[-1]))) for w in words) + max(abs(int(books.min())), abs(int(books.max())))
    kind = np.int32 if top * top * width < 1 << 31 else np.int64 if top * top * width < 1 << 63 else object
    nearest = np.empty((parts, codes.shape[1]), np.int64)
    error = np.empty((parts, codes.shape[1]), object if kind is object else np.int64)
    for p in range(parts):
        distance = np.zeros((codes.shape[1], entries), kind)
        for k in range(width):
            j = p * width + k
            table = (words[j].astype(kind)[:, None] - books[p, :, k].astype(kind)[None, :]) ** 2
            distance += table[codes[j]]
        nearest[p] = distance.argmin(axis=1)
        error[p] = np.take_along_axis(distance, nearest[p][:, None], 1)[:, 0]
    return nearest, error


def entry_sums(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(cell, n, total) over all blocks: ``cell`` numbers (part, entry, place)."""
    parts, entries, width = books.shape
    schema = pa.schema([("cell", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(parts * entries, np.int64)
        total = np.zeros(parts * entries * width, object)
        for batch in batches:
            for row in batch.to_pylist():
                words, codes = unfiled(row)
                slot = assigned(words, codes, books)[0] + np.arange(parts)[:, None] * entries
                n += np.bincount(slot.ravel(), minlength=len(n))
                small = max(int(max(abs(w[0]), abs(w[-1]))) for w in words) < 1 << 40  # sums of a block fit
                for j, w in enumerate(words):
                    p, k = divmod(j, width)
                    value = w[codes[j]]
                    sum_ = np.zeros(parts * entries, np.int64 if small else object)
                    np.add.at(sum_, slot[p], value if small else value.astype(object))
                    total[k::width] += sum_
        cell = np.flatnonzero(np.repeat(n, width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell.astype(np.int32)), pa.array(np.repeat(n, width)[cell]),
             pa.array([Decimal(int(t)) for t in total[cell]], pa.decimal128(38, 0))], schema=schema)

    found = blocks.select("sizes", "words", "codes").mapInArrow(sums, "cell int, n long, total decimal(38,0)")
    return found.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))


class Codebooks:
    """Codebooks fitted on all rows of ``vectors``, and the codes of these rows."""

    def __init__(
        self, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
        id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    ):
        if not 0 < entries <= 256:
            raise ValueError("an entry's number must fit two hex digits")
        v = F.col(vector_col).cast("array<double>")
        kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), v.alias("v")).where(
            "v IS NOT NULL AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")
        longest = kept.agg(F.max(F.size("v"))).first()[0] or 1
        size = -(-max(longest, 1) // parts) * parts
        first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
        start = np.zeros((len(first), size))
        for row, (vector,) in zip(start, first):
            row[: len(vector)] = vector
        self.spark, self.names = vectors.sparkSession, (id_col, label_col)
        self.blocks = stage(dictionaries(kept, size, scale), "vector-blocks")
        self.books = integers(start, scale).reshape(len(first), parts, size // parts).transpose(1, 0, 2).copy()
        for _ in range(rounds if len(first) else 0):
            flat = self.books.reshape(-1)
            for cell, n, total in entry_sums(self.blocks, self.books).collect():  # one row for each number of the model
                flat[cell] = int(total) // n

    def sha256(self) -> str:
        """Digest of all entries by part, entry and place."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()

    def codes(self) -> DataFrame:
        """(id, label, code, error): entry numbers of each vector's parts as two hex digits each."""
        books = self.books
        id_type, label_type = (self.blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, row in enumerate(batch.select(["sizes", "words", "codes"]).to_pylist()):
                    nearest, error = assigned(*unfiled(row), books)
                    whole = [min(int(e), MOST) for e in error.sum(axis=0)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("ids")[i].values, batch.column("labels")[i].values,
                         pa.array([x.tobytes().hex() for x in nearest.T.astype(np.uint8)], pa.string()),
                         pa.array(whole, pa.int64())], names=["id", "label", "code", "error"])

        found = self.blocks.mapInArrow(code, f"id {id_type}, label {label_type}, code string, error long")
        return found.withColumnsRenamed(dict(zip(("id", "label"), self.names)))


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **model) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) for every vector kept.

    ``label_error`` is the error summed over the rows of a label; rows without label are one group.
    """
    books = Codebooks(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col, **model)
    found = stage(books.codes().toDF("id", "label", "code", "error"), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    sums = found.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return found.join(sums, found["label"].eqNullSafe(sums["of"])).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op11_vector_codes(spark, sf_dir):
    """Codes of all embeddings by 16 codebooks of 64 entries after two rounds."""
    return compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle() -> str:
    """The same in DuckDB SQL: each round is a pair of common table expressions."""
    rounds = "".join(f"""
    a{r} AS MATERIALIZED (
      SELECT r, part, arg_min(entry, dist * 64 + entry) AS entry, min(dist) AS dist
      FROM (SELECT c.r, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) AS dist
            FROM c JOIN b{r} b USING (part, place) GROUP BY ALL) GROUP BY r, part),
    b{r + 1} AS MATERIALIZED (
      SELECT b.part, b.entry, b.place, coalesce(n.v, b.v) AS v FROM b{r} b LEFT JOIN (
        SELECT part, entry, place, CAST(floor(sum(c.v) / count(*)) AS BIGINT) AS v
        FROM c JOIN a{r} a USING (r, part) GROUP BY ALL) n USING (part, entry, place)),""" for r in range(3))
    return f"""
    WITH k AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, embedding FROM embeddings
      WHERE embedding IS NOT NULL AND NOT EXISTS (SELECT 1 FROM unnest(embedding) u(x) WHERE x IS NULL OR NOT isfinite(x))),
    c AS MATERIALIZED (
      SELECT r, (i - 1) // (len(embedding) // 16) AS part, (i - 1) % (len(embedding) // 16) AS place,
        CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v
      FROM k, unnest(range(1, len(embedding) + 1)) t(i)),
    b0 AS MATERIALIZED (SELECT part, r AS entry, place, v FROM c WHERE r < 64),{rounds}
    h AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b2),
    e AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error
          FROM a2 GROUP BY r)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM k JOIN e USING (r), h
    """


ORACLE = _oracle()
