"""Substring dedup by seed and extend: anchors, what lies over them on both sides, maximal repeats.

``repeats`` joins documents on winnowed anchors (the seeds). A stretch reaches as far to both sides of
its anchor as windows have it for theirs. In place of extending two texts against each other word by
word, stretches are compared by hashes: those that agree as a whole are settled at once, the others
window by window with 128-bit hashes, counted before the shuffle. Overlapping repeats of a document
unite to its maximal repeats. A very long text is held by one task with some arrays of its length.

Nulls are empty texts and have no words. A repeated row is another place, so its windows repeat. A
null id is an id like others. Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalytics.llm import repeats, scan
from pedalytics.session import stage

WINDOW = 35
ANCHOR = 10


def repeated_stretches(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Maximal parts of runs, as (_id, _mark, start, length) in words, whose windows occur elsewhere.

    Texts of fewer than ``window`` words have none; an empty table gives no rows.
    """
    texts = repeats.keyed(docs, id_col, text_col)
    again, classes, mixed = repeats.repeated_runs(texts, scan.word_tokens, window, anchor)
    copies = classes.where("copies > 1").select("seed", "span")
    whole = repeats.unpack(again.join(copies, ["seed", "span"])).select(
        "_id", "_mark", "start", (F.col("n") + window - 1).alias("length")
    )
    open_ = repeats.unpack(
        mixed.select("first._id", "first._mark", "first.place", (F.col("copies") == 1).alias("single"))
    )
    stretch = open_.groupBy("_id", "_mark").agg(F.collect_list(F.struct("start", "n", "single")).alias("open"))
    windows = repeats.with_texts(texts, stretch).select("_id", "_mark", "_text", "open")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("_id", pa.int64()), ("_mark", pa.int64()),
                            ("start", pa.int32()), ("single", pa.bool_())])
        for batch in batches:
            ids, marks, open_runs = batch.column(0), batch.column(1), batch.column(3)
            for texts in scan.chunks(batch.column(2)):
                tokens = scan.word_tokens(texts)
                rows, starts, single = [], [], []
                for i in range(len(texts)):
                    for run in open_runs[texts.first + i].as_py():
                        rows.append(np.full(run["n"], i))
                        starts.append(np.arange(run["start"], run["start"] + run["n"]))
                        single.append(np.full(run["n"], run["single"]))
                row, start = np.concatenate(rows), np.concatenate(starts)
                at = start + tokens.bounds[row]
                lanes = [
                    scan.stretch_hashes(scan.prefix_hashes(tokens.value, lane), at, at + window, lane)
                    for lane in (0, 2)
                ]
                take = pa.array(row + texts.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lanes[0].view(np.int64)), pa.array(lanes[1].view(np.int64)), ids.take(take),
                     marks.take(take), pa.array(start.astype(np.int32)),
                     pa.array(np.concatenate(single))], schema=schema)

    each = windows.mapInArrow(hashed, "a long, b long, _id long, _mark long, start int, single boolean")
    twice = each.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("a", "b")
    twice = stage(twice, "repeated-windows")
    partly = each.where("single").join(twice, ["a", "b"]).select(
        "_id", "_mark", "start", F.lit(window).alias("length")
    )
    return whole.unionByName(partly)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_removed, kept): each text without the words under repeated windows.

    Kept words are joined by one space. One row for each row of ``docs``.
    """
    texts = repeats.keyed(docs, id_col, text_col)
    found = repeats.intervals(repeated_stretches(docs, window, anchor, id_col, text_col))
    joined = repeats.with_texts(texts, found, "left").select("_id", "_text", "starts", "lengths")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            words, removed, kept = [], [], []
            for i in range(batch.num_rows):
                all_words = (texts[i].as_py() or b"").split()
                words.append(len(all_words))
                starts = batch.column(2)[i].as_py()
                if starts:
                    gone = scan.covered(np.array(starts), np.array(batch.column(3)[i].as_py()), len(all_words))
                    removed.append(int(gone.sum()))
                    all_words = list(compress(all_words, ~gone))
                else:
                    removed.append(0)
                kept.append(b" ".join(all_words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=[id_col, "n_words", "n_removed", "kept"])

    return joined.mapInArrow(cut, f"`{id_col}` long, n_words long, n_removed long, kept string")


def op1_substring_dedup(spark, sf_dir):
    """Words of every document that no repeated 35-word window covers, as a digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = remove_repeats(docs)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
