"""I-Match document fingerprints in DataFrame expressions.

Terms are white-space words. Those whose document frequency lies in a band (``LOW`` to ``HIGH`` of all
documents) form the lexicon. A fingerprint has one part for each of several randomised lexicon subsets:
the hash of the document's distinct terms in that subset, sorted. Subsets come in several densities, so
that long and short documents both have parts with few terms. Likeness of two fingerprints is the share
of equal parts among those that are filled in one of them at least.

A term is in the lexicon only if it is in at least ``LOW`` of all documents, so the lexicon has at most
(mean distinct terms of a document) / ``LOW`` terms, whatever the size of the corpus. It is a stored table,
so the planner knows its size.

A document with fewer than ``FEW`` different filled parts, as it has no or few terms of the band (one term
alone fills parts alike), is fingerprinted by its own terms instead: the hash of all of them (marked ``all-``), then one part for each
of ``OWN`` disjoint subsets of all words (equal ranges of their hashes), each the least hash of the document's terms in it.
Equal ones have equal terms, and likeness estimates the share of common terms. Where only one of two
fingerprints is of this kind, the two documents are compared by their own terms both.
Null and empty texts have the fingerprint of no terms. The next document is the one with the next smaller id; rows of one id are
ordered by their text's hash. A null id comes last, as null sorts last in descending order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalytics.session import stage

LOW, HIGH = 0.002, 0.2
# The subsets: each holds one term in so many, at random.
SUBSETS = (8,) * 4 + (32,) * 12 + (128,) * 24 + (512,) * 20
FEW = 4  # different filled parts that a fingerprint of the band has at least
OWN = 8
EMPTY = "----"


def terms(text: Column) -> Column:
    """Hashes of the distinct white-space words."""
    marks = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    found = F.transform(F.array_distinct(F.split(marks, " ")), lambda w: F.xxhash64(w))
    return F.when(marks == "", F.array().cast("array<bigint>")).otherwise(found)


def lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(term, subsets): the terms of the band, and the numbers of the subsets that hold each. ``texts``: (text)."""
    n = texts.count()
    counted = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").count()
    band = counted.where((F.col("count") >= max(2, low * n)) & (F.col("count") <= max(2, high * n)))
    held = [F.when(F.pmod(F.xxhash64("term", F.lit(j)), F.lit(density)) == 0, F.lit(j)) for j, density in enumerate(SUBSETS)]
    return band.select("term", F.array_compact(F.array(*held)).alias("subsets"))


def neighbours(ids: DataFrame) -> DataFrame:
    """``ids`` (null, id, mark, n) in descending order of id, with ``after`` and ``before``; the ends meet.

    Ids are ranged over partitions; each partition is ordered by itself, and one row for each
    partition says where the next one begins.
    """
    order = (F.col("null"), F.col("id").desc(), F.col("mark"))
    parts = stage(ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ordered-ids")
    me = F.struct("id", "mark", "n")
    key = F.struct("null", (-F.col("id")).alias("down"), "mark", "n")
    ends = parts.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    row = lambda c: F.struct((-F.col(c)["down"]).alias("id"), F.col(c)["mark"].alias("mark"), F.col(c)["n"].alias("n"))
    ends = ends.select("part", row("first").alias("first"), row("last").alias("last"))
    along = Window.orderBy("part")  # one row for each partition of ids
    every = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        F.col("part").alias("p"),
        F.coalesce(F.lead("first").over(along), F.first("first").over(every)).alias("x"),
        F.coalesce(F.lag("last").over(along), F.last("last").over(every)).alias("y"))
    inside = Window.partitionBy("part").orderBy(*order)
    parts = parts.withColumns({"l": F.lead(me).over(inside), "b": F.lag(me).over(inside)})
    met = parts.join(ends, parts["part"] == ends["p"])
    return met.withColumns({"after": F.coalesce("l", "x"), "before": F.coalesce("b", "y")}).select(
        *ids.columns, "after", "before")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among those filled in ``a`` or ``b``; 1 for equal fingerprints."""
    pairs = F.arrays_zip(F.split(a, "\\.").alias("a"), F.split(b, "\\.").alias("b"))
    used = F.filter(pairs, lambda p: (p["a"] != EMPTY) | (p["b"] != EMPTY))
    same = F.size(F.filter(used, lambda p: p["a"] == p["b"]))
    return F.when(a == b, 1.0).when(F.size(used) == 0, 0.0).otherwise(same / F.size(used))


def _code(x: Column) -> Column:
    return F.lpad(F.right(F.lower(F.hex(F.xxhash64(x))), F.lit(4)), 4, "0")


def bound(value: Column, then) -> Column:
    """``then`` of ``value``, which is computed once however often ``then`` names it."""
    return F.transform(F.array(value), then)[0]


def own_terms(t: Column) -> Column:
    """The fingerprint by a document's own terms ``t``: subsets are ranges of the hashes, told by their top bits."""
    bits = 64 - (OWN - 1).bit_length()
    top = lambda x: F.shiftright(x, bits)
    place = lambda x: F.pmod(top(x), F.lit(OWN)).cast("int")

    def parts(s: Column) -> Column:
        first = F.filter(s, lambda x, i: (i == 0) | (top(x) != top(F.get(s, i - 1))))
        whole = F.concat(F.lit("all-"), F.lower(F.hex(F.xxhash64(s))))
        codes = lambda m: F.concat_ws(".", whole, *[F.coalesce(F.element_at(m, F.lit(j)), F.lit(EMPTY)) for j in range(OWN)])
        return bound(first, lambda f: bound(F.map_from_arrays(F.transform(f, place), F.transform(f, _code)), codes))

    return bound(F.sort_array(t), parts)


def fingerprint(found: Column, own: Column) -> Column:
    """Parts of the band terms ``found``, an array of (subset, term); ``own`` if fewer than ``FEW`` differ.

    Sorted, the terms of a subset stand together: one pass finds where each subset starts, one hashes.
    """
    def codes(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == 1) | (F.get(s, i - 1)["subset"] != F.get(s, i - 2)["subset"]))

        def hashed(at: Column) -> Column:
            end = lambda i: F.coalesce(F.get(at, i + 1), F.size(s) + 1)
            code = F.transform(at, lambda a, i: _code(F.slice(s, a, end(i) - a)["term"]))
            return F.map_from_arrays(F.transform(at, lambda a: F.get(s, a - 1)["subset"]), code)

        return bound(starts, hashed)

    def whole(m: Column) -> Column:
        enough = F.size(F.array_distinct(F.map_values(m))) >= FEW
        parts = F.concat_ws(".", *[F.coalesce(F.element_at(m, F.lit(j)), F.lit(EMPTY)) for j in range(len(SUBSETS))])
        return F.when(enough, parts).otherwise(own)

    filled = bound(F.sort_array(found), lambda s: bound(codes(s), whole))
    return F.when(F.size(found) == 0, own).otherwise(filled)


def alike(a: Column, own_a: Column, b: Column, own_b: Column) -> Column:
    """Likeness of fingerprints ``a`` and ``b``, by own terms if one of them is."""
    by_own = a.startswith("all-") | b.startswith("all-")
    return F.when(by_own, likeness(own_a, own_b)).otherwise(likeness(a, b))


def with_next(base: DataFrame) -> DataFrame:
    """``base`` (null, id, mark, text) with n, after, copies and ``edited``, dealt out by (id, mark)."""
    ids = base.groupBy("null", "id", "mark").agg(F.max(F.length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    order = stage(neighbours(ids), "neighbours")
    known = base.select("id", "mark", "text").join(order, ["id", "mark"])
    heads = order.select("id", "mark", "before").join(base.select("id", "mark", "text"), ["id", "mark"])
    heads = heads.select(
        F.col("before.id").alias("id"), F.col("before.mark").alias("mark"),
        F.expr("left(text, CAST(before.n DIV 3 AS INT))").alias("head"))
    heads = heads.groupBy("id", "mark").agg(F.max("head").alias("head"))
    edited = F.expr("concat(left(text, CAST(n - n DIV 3 AS INT)), head)")
    return known.join(heads, ["id", "mark"]).withColumn("edited", edited)


def match_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text is the text with its last third replaced by the first characters, as many, of the
    next document. One row for each row of ``docs``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    null = F.col(id_col).isNull()
    base = docs.select(null.alias("null"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(null, text).alias("mark"), text.alias("text"))
    band = stage(lexicon(base.select("text")), "lexicon")

    rows = with_next(base).select(
        "id", "mark", "null", "n", "after", "copies", F.sha2("edited", 256).alias("sha"),
        terms(F.col("text")).alias("t"), terms(F.col("edited")).alias("e"))
    info = F.struct("null", "n", "after", "copies", "sha", own_terms(F.col("t")).alias("t"), own_terms(F.col("e")).alias("e"))
    rows = rows.select("id", "mark", "t", "e", info.alias("info"))
    none = F.lit(None).cast(rows.schema["info"].dataType)  # the terms' rows are narrow: only the first one has the rest
    flag = lambda c, i: F.transform(c, lambda x: F.struct(x.alias("term"), F.lit(i).alias("side"), none.alias("info")))
    self_ = F.array(F.struct(F.lit(None).cast("long").alias("term"), F.lit(0).alias("side"), F.col("info").alias("info")))
    rows = rows.select("id", "mark", F.explode(F.concat(self_, flag("t", 1), flag("e", 2))).alias("p"))
    rows = rows.select("id", "mark", "p.term", "p.side", "p.info").join(band, "term", "left").where("side = 0 OR size(subsets) > 0")
    rows = rows.select("id", "mark", "term", "side", "info", F.explode_outer("subsets").alias("subset"))
    side = lambda i: F.collect_set(F.when(F.col("side") == i, F.struct("subset", "term")))
    found = rows.groupBy("id", "mark").agg(F.first("info", True).alias("i"), side(1).alias("t"), side(2).alias("e"))
    found = stage(found.select(
        "id", "mark", "i.null", "i.n", "i.after", "i.copies", "i.sha",
        fingerprint(F.col("t"), F.col("i.t")).alias("f"), fingerprint(F.col("e"), F.col("i.e")).alias("g"),
        F.col("i.t").alias("own"), F.col("i.e").alias("own_e")), "fingerprints")
    follow = found.select(F.col("id").alias("nid"), F.col("mark").alias("nmark"), F.col("f").alias("nf"), F.col("own").alias("nown"))
    out = found.join(follow, (F.col("after.id") == F.col("nid")) & (F.col("after.mark") == F.col("nmark")))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(
        F.when(~F.col("null"), F.col("id")).alias(id_col), F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        F.col("f").alias("fingerprint"), F.col("g").alias("edited_fingerprint"),
        alike(F.col("f"), F.col("own"), F.col("g"), F.col("own_e")).alias("near_edited"),
        alike(F.col("f"), F.col("own"), F.col("nf"), F.col("nown")).alias("near_next"))


def op2_fingerprints(spark, sf_dir):
    """I-Match fingerprints of every document and of its edited text."""
    return match_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
