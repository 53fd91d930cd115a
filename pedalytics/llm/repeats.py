"""Repeated windows of a corpus, found without comparing documents in pairs.

Every window of a document is filed under a seed, its least k-gram; runs of windows under one seed
are rows (see ``scan.winnow``). Seeds that occur once are dropped, after a count that is combined
before the shuffle. Where the whole stretch under two runs is equal, all their windows are; only one
run of each such class is looked at again, window by window, if its seed also stands in other
stretches. A passage shared by a third of all documents is one class with a count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalytics.llm import scan
from pedalytics.session import stage

_RUN = pa.schema([("seed", pa.int64()), ("span", pa.int64()), ("_id", pa.int64()), ("_mark", pa.int64()), ("place", pa.int64())])


def mark(text: Column) -> Column:
    """Hash that tells the rows of one id (or of none) apart; two texts among n share one with probability n**2 / 2**65."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _mark, _text): rows that repeat an id with another text stay apart by ``_mark``."""
    return docs.select(
        F.col(id_col).cast("long").alias("_id"),
        mark(F.col(text_col)).alias("_mark"),
        F.col(text_col).alias("_text"),
    )


def unpack(runs: DataFrame) -> DataFrame:
    """Start and window count out of ``place``."""
    return runs.select(
        *[c for c in runs.columns if c != "place"],
        F.shiftright("place", 8).cast("int").alias("start"),
        F.col("place").bitwiseAND(255).cast("int").alias("n"),
    )


def seeds(texts: DataFrame, tokens: Callable[[scan.Texts], scan.Tokens], window: int, k: int) -> DataFrame:
    """One row (seed, span, _id, _mark, place) for each run of windows under one seed."""
    if window - k + 1 > 255:
        raise ValueError("a run's length must fit eight bits")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            for texts in scan.chunks(batch.column(2)):
                found = scan.winnow(tokens(texts), window, k)
                row = pa.array(found.text + texts.first)
                place = (found.start << 8) | found.count
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.seed.view(np.int64)), pa.array(found.span.view(np.int64)), ids.take(row), marks.take(row),
                     pa.array(place)], schema=_RUN)

    return texts.mapInArrow(runs, "seed long, span long, _id long, _mark long, place long")


def repeated_runs(texts: DataFrame, tokens, window: int, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs whose seed occurs more than once; their classes; the classes of seeds with several.

    A class holds the runs that agree in seed and span: (seed, span, copies, first). The last table
    also has ``kinds``, the number of classes of the seed.
    Each side of a join is a stored table, so that a join on a crowded seed can be split.
    """
    runs = seeds(texts, tokens, window, k)
    counted = runs.groupBy("seed").agg(F.count(F.lit(1)).alias("times"))
    often = stage(counted.where("times > 1").select("seed"), "repeated-seeds")
    again = stage(runs.join(often, "seed"), "repeated-runs")
    classes = again.groupBy("seed", "span").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("_id", "place", "_mark")).alias("first")
    )
    classes = stage(classes, "run-classes")
    kinds = stage(classes.groupBy("seed").agg(F.count(F.lit(1)).alias("kinds")), "seed-kinds")
    return again, classes, classes.join(kinds.where("kinds > 1"), "seed")


def intervals(found: DataFrame) -> DataFrame:
    """(_id, _mark, starts, lengths): all stretches of a document in one row, at most its own length."""
    return found.groupBy("_id", "_mark").agg(
        F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths")
    )


def with_texts(texts: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """Join rows of ``found`` to their texts; a null id meets a null id."""
    f = found.withColumnsRenamed({"_id": "_fid", "_mark": "_fmark"})
    met = texts["_id"].eqNullSafe(f["_fid"]) & (texts["_mark"] == f["_fmark"])
    return texts.join(f, met, how).drop("_fid", "_fmark")
