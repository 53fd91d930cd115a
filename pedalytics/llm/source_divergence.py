"""Source divergence audit over run-length columns.

Within a language every source has a column: its count of each term of the vocabulary. The vocabulary
is ordered so that equal counts stand together (terms of one profile, that is with the same count in
every source, are neighbours, and profiles are sorted by total and count), dealt out in blocks of that order, and each
column of a block is run-length encoded. For two sources the run boundaries are intersected: between
two boundaries both counts stay, so the divergence of one term counts as often as the stretch is long.
Block sums of a pair are added up.

A source's share of a term is smoothed and scaled to p = 1 + floor(10**9 (count + 2) / (N + 2 V)), and
the divergence of two shares is floor((p - q)**2 / (p + q)); all arithmetic is in integers, exact while
the terms of a language number less than 9 * 10**15.

Null texts, languages and sources read as ''. Every row is a document, repeated ones too. Ties are ranked
by item. A language without vocabulary has pairs of value 0 and no terms; an empty table gives no rows.
Very long texts are read in pieces. Columns other than text, lang and source are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalytics.session import stage

DOCUMENTS = 10  # a term is kept if so many documents of its language hold it
RANKS = 10
SCALE = 1_000_000_000
BLOCK = 20_000  # profiles of a block
HELD = 200_000  # different terms that a task counts before it gives them out
PIECE = 1 << 20
_TERM = re.compile(rb"[A-Za-z\x80-\xFF]+")
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term; ``docs``: (lang, source, text)."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def given(held: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size), pa.array([source] * size), pa.array(n.keys(), pa.binary()).cast(pa.string()),
                 pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                text = text.as_py()
                if (lang, source) not in held:
                    held[lang, source] = (Counter(), Counter())
                n, docs = held[lang, source]
                before, seen, at = len(n), set(), 0
                while at < len(text):
                    cut = _BREAK.search(text, at + PIECE)
                    end = cut.start() if cut else len(text)
                    words = _TERM.findall(text[at:end].lower())
                    n.update(words)
                    seen.update(words)
                    at = end
                docs.update(seen)
                size += len(n) - before
                if size > HELD:
                    yield from given(held)
                    held, size = {}, 0
        yield from given(held)

    each = docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def profiles(counts: DataFrame, least: int = DOCUMENTS) -> DataFrame:
    """(lang, term, total, profile) of the terms kept: ``profile`` has (source, n), one for each source that holds it."""
    each = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("profile"))
    return each.where(F.col("docs") >= least).drop("docs")


def share(n: Column, whole: Column) -> Column:
    """p of a count; ``whole`` is N + 2 V."""
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)"), whole.cast("decimal(20,0)"))


def shares(n: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    """As ``share``: a long division by steps of a thousand, so that no product leaves 64 bits."""
    quotient, rest = np.divmod(n + 2, whole)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + step
    return quotient + 1


def divergence(p, q):
    """Of two arrays of shares."""
    return (p - q) ** 2 // (p + q)


def columns(block: pa.Table) -> tuple[int, dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Terms of a block (profile, terms), and of each source in it the runs: starts and counts."""
    terms = block["terms"].to_numpy()
    place = np.append(0, np.cumsum(terms))
    lists = block["profile"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat, bounds = lists.flatten(), lists.offsets.to_numpy()
    row = np.repeat(np.arange(len(lists)), np.diff(bounds))
    code = flat.field("source").dictionary_encode()
    source, n = code.indices.to_numpy(), flat.field("n").to_numpy()
    order = np.lexsort((row, source))
    bounds = np.searchsorted(source[order], np.arange(len(code.dictionary) + 1))
    found = {}
    for s, name in enumerate(code.dictionary.to_pylist()):
        mine = order[bounds[s] : bounds[s + 1]]
        # A run for each profile of the source and one of zeros behind it, where it does not go on at once.
        start = np.column_stack([place[row[mine]], place[row[mine] + 1]]).ravel()
        count = np.column_stack([n[mine], np.zeros(len(mine), np.int64)]).ravel()
        start, count = np.append(0, start), np.append(0, count)
        last = np.append(start[1:] != start[:-1], True) & (start < place[-1])
        start, count = start[last], count[last]
        new = np.append(True, count[1:] != count[:-1])
        found[name] = (start[new], count[new])
    return int(place[-1]), found


def intersected(size: int, a: tuple, whole_a: int, b: tuple, whole_b: int) -> int:
    """Summed divergence of two run-length columns of ``size`` terms."""
    start = np.union1d(a[0], b[0])
    length = np.diff(np.append(start, size))
    p = shares(a[1], whole_a)[np.searchsorted(a[0], start, "right") - 1]
    q = shares(b[1], whole_b)[np.searchsorted(b[0], start, "right") - 1]
    return int((divergence(p, q) * length).sum())


def pair_sums(kept: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, a, b, value) for a < b with vocabulary; ``groups``: (lang, source, whole)."""
    clusters = kept.groupBy("lang", "profile").agg(F.count(F.lit(1)).alias("terms"), F.first("total").alias("total"))
    # Dealt out by total count, so that the driver samples narrow keys; ordered by profile within.
    clusters = clusters.repartitionByRange("lang", "total", F.xxhash64("profile"))
    ordered = clusters.drop("total").sortWithinPartitions("lang", "profile")
    # The low 33 bits are the place in the partition; a block never leaves its partition.
    ordered = ordered.withColumn("at", F.monotonically_increasing_id())
    first = F.col("at") - F.pmod(F.col("at").bitwiseAND((1 << 33) - 1), F.lit(block))
    ordered = stage(ordered.withColumn("block", first), "vocabulary-blocks")
    heads = ordered.select("lang", "block").distinct().join(groups, "lang").toDF("of", "within", "source", "whole")
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])

    def sums(mine: pa.Table, sources: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return schema.empty_table()
        size, runs = columns(mine.sort_by("at"))
        whole = dict(zip(sources["source"].to_pylist(), sources["whole"].to_pylist()))
        names = sorted(whole, key=str.encode)
        zeros = (np.zeros(1, np.int64), np.zeros(1, np.int64))
        rows = [(a, b, intersected(size, runs.get(a, zeros), whole[a], runs.get(b, zeros), whole[b]))
                for i, a in enumerate(names) for b in names[i + 1 :]]
        a, b, value = zip(*rows) if rows else ((), (), ())
        lang = mine["lang"][0].as_py()
        return pa.table([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(value, pa.int64())], schema=schema)

    each = ordered.groupBy("lang", "block").cogroup(heads.groupBy("of", "within")).applyInArrow(
        sums, "lang string, a string, b string, value long")
    return each.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, least: int = DOCUMENTS, ranks: int = RANKS,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): divergence from every other source, and the terms most over-used."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    docs = docs.select(*named)
    kept = stage(profiles(term_counts(docs), least), "term-profiles")
    each = kept.select("lang", "term", "total", F.explode("profile").alias("p")).select("lang", "term", "total", "p.source", "p.n")
    langs = kept.groupBy("lang").agg((F.sum("total") + 2 * F.count(F.lit(1))).alias("all"), F.count(F.lit(1)).alias("v"))
    langs = stage(langs, "vocabulary-sizes")
    counted = each.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = docs.select("lang", "source").distinct().join(counted, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", (F.coalesce("n", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("whole"), "all")
    groups = stage(groups, "source-groups")

    sums = pair_sums(kept, groups.select("lang", "source", "whole"))
    sums = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    others = groups.select("lang", F.col("source").alias("a")).join(groups.select("lang", F.col("source").alias("b")), "lang").where("a <> b")
    pairs = others.join(sums, ["lang", "a", "b"], "left").select(
        "lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), F.coalesce("value", F.lit(0).cast("long")).alias("value"))

    p, q = share(F.col("n"), F.col("whole")), share(F.col("total"), F.col("all"))
    terms = each.join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= ranks))


def op13_source_divergence(spark, sf_dir):
    """Divergence of all sources of each language in pairs, and each source's ten most over-used terms."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS MATERIALIZED (SELECT doc, lang, source, term, count(*) AS n FROM (SELECT doc, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n) AS total FROM w GROUP BY ALL HAVING count(*) >= 10),
v AS MATERIALIZED (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
m AS MATERIALIZED (SELECT lang, source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v.v, k.total, v.n AS all_n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)::HUGEINT) // (m.n + 2 * v.v)::HUGEINT AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN m USING (lang, source) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
q AS (SELECT lang, source, term, p, 1 + (1000000000::HUGEINT * (total + 2)::HUGEINT) // (all_n + 2 * v)::HUGEINT AS q FROM p WHERE n > 0),
term AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM q WHERE p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
      FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""
