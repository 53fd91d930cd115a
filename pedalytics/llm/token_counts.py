"""Token counts as delta-maintained rollups.

Documents come as batches of changes: inserts count +1, deletes -1, a revised text is its old count
taken back and its new one added. Each batch is reduced to signed sums by source, language and tokenizer
version and committed as one folder; totals are the sum of all committed folders, so they never need
the documents again. A batch is written aside and renamed to its id, which takes effect as a whole or not
at all and for one of several writers of the same id: committing is idempotent by its id, and a batch that
broke off is never seen. (The file system's renames must be atomic.)

Null source or language is a group of its own. Null and empty texts have no tokens but are documents.
Repeated rows count as often as they occur. Groups whose documents and tokens are all taken back
are not listed. Columns other than those named are ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalytics.session import scratch_dir, stage

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VERSION = "byte-bpe-50k"
SECOND_RANKS, SECOND_VERSION = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken", "byte-bpe-multi-50k"
SLICE = 16  # the query revises one row in so many, and takes it back
GROUP = ["source", "lang", "tokenizer"]
_READY: dict = {}


def _encoding(path: str):
    if path not in _READY:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _READY[path] = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _READY[path]


def counted(docs: DataFrame, tokenizer: str, ranks: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, source, lang, tokenizer, tokens) for each row of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks)
        for batch in batches:
            n = [len(encoding.encode_ordinary(t.as_py())) if t.is_valid else 0 for t in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(n, pa.int64())],
                                             names=["id", "text_key", "source", "lang", "tokens"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.md5(F.coalesce(text_col, F.lit(""))).alias("text_key"),
        F.col("source").cast("string"), F.col("lang").cast("string"), F.col(text_col))
    rows = rows.mapInArrow(count, "id long, text_key string, source string, lang string, tokens long")
    return rows.withColumn("tokenizer", F.lit(tokenizer))


class TokenRollup:
    """Totals under ``path``, a folder every executor can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add ``changes`` (the group's columns, tokens, sign 1 or -1); False if the batch was in before."""
        to_path = self.spark._jvm.org.apache.hadoop.fs.Path
        aside = f"_writing-{uuid.uuid4().hex}"  # names that begin with _ are not read
        source, target = to_path(f"{self.path}/{aside}"), to_path(f"{self.path}/batch={quote(batch, safe='')}")
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if fs.exists(target):
            return False
        sums = changes.groupBy(*GROUP).agg(
            F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"))
        sums.write.parquet(f"{self.path}/{aside}")
        if fs.rename(source, target) and not fs.exists(to_path(target, aside)):
            return True
        # Another writer was first: the folder is left where it was, or was moved into the other's.
        fs.delete(source, True)
        fs.delete(to_path(target, aside), True)
        return False

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches."""
        deltas = self.spark.read.schema(
            "source string, lang string, tokenizer string, docs long, tokens long, batch string").parquet(self.path)
        total = deltas.groupBy(*GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return total.where("n_docs <> 0 OR n_tokens <> 0")


def inserts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sign", F.lit(1))


def deletes(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sign", F.lit(-1))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    return deletes(old).unionByName(inserts(new))


def op9_token_counts(spark, sf_dir):
    """Totals over all rows of documents.

    After the load, a slice of the rows is revised, deleted and counted by a second tokenizer version, each
    taken back by a later batch, and the load comes once more: none of it may change the totals.
    """
    rollup = TokenRollup(spark, f"{scratch_dir(spark)}/token-rollup-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = stage(counted(docs, VERSION), "token-counts")
    rollup.commit("1-load", inserts(rows))
    some = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(SLICE)) == 0
    old = rows.where(F.pmod(F.xxhash64("id"), F.lit(SLICE)) == 0)
    new = stage(counted(docs.where(some).withColumn("text", F.upper("text")), VERSION), "revised-counts")
    rollup.commit("2-revise", revisions(old, new))
    rollup.commit("3-delete", deletes(new))
    rollup.commit("4-restore", inserts(old))
    second = stage(counted(docs.where(some), SECOND_VERSION, SECOND_RANKS), "second-version")
    rollup.commit("5-second-version", inserts(second))
    rollup.commit("6-first-version", deletes(second))
    rollup.commit("1-load", inserts(rows))
    return rollup.totals()
