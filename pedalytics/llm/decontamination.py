"""Benchmark decontamination by winnowing, in DataFrame expressions.

Windows of ten words are what must be found. Both sides keep the least hash of the five-word grams
in each window (``GRAM`` + reach - 1 = window; of equal ones a document keeps one, the benchmark all),
so a shared window always shares a kept fingerprint at the same place in it. Fingerprints are joined first as hashes and places only; the windows under
a hit are then compared word by word with the document. An item of fewer than ten words is one window of its
own length, found under the hash of all its words; documents are fingerprinted at such a length only
if the benchmark has it.

Null texts have no words. Items without words are in no document. Equal windows of many items are one
window. Repeated rows: a repeated document id with the same text is reported once for each row; a
repeated item id counts once. Columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalytics.llm import repeats
from pedalytics.session import stage

WINDOW = 10
GRAM = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words; an array without empty strings, for a null text an empty one."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)  # there ``lower`` changes A-Z alone, and is faster
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def bound(value: str, name: str, then: str) -> str:
    """SQL: ``then`` with ``value`` as lambda variable ``name``; a plain column in a lambda may be computed for every element."""
    return f"element_at(transform(array({value}), {name} -> {then}), 1)"


def gram_hashes(h: str, k: int) -> str:
    """SQL: hash of every k consecutive words; ``h`` names the array of the words' hashes."""
    return (f"CASE WHEN size({h}) >= {k} THEN transform(sequence(0, size({h}) - {k}), i -> "
            f"xxhash64({k}, {', '.join(f'get({h}, i + {j})' for j in range(k))})) ELSE CAST(array() AS array<bigint>) END")


def kept(g: str, reach: int) -> str:
    """SQL: (hash, place) of the least of each ``reach`` consecutive gram hashes, null where it was the last one's, too.

    The low bits of a hash give way to those of its place, which tell the place inside a window; so
    windows are compared as plain numbers. Of equal hashes any may be kept: the benchmark keeps all.
    """
    modulus = 1 << reach.bit_length()  # more than any two neighbouring windows span
    packed = f"transform({g}, (x, i) -> (x & {-modulus}L) | (i & {modulus - 1}))"
    least = f"transform(sequence(0, size(q) - {reach}), i -> least({', '.join(f'get(q, i + {j})' for j in range(reach))}))"
    new = (f"transform(m, (x, i) -> CASE WHEN i > 0 AND get(m, i - 1) = x THEN NULL ELSE "
           f"struct(x & {-modulus}L AS hash, i + CAST(((x & {modulus - 1}) - (i & {modulus - 1})) & {modulus - 1} AS int) AS place) END)")
    return (f"CASE WHEN size({g}) >= {reach} THEN {bound(packed, 'q', bound(least, 'm', new)) if reach > 1 else bound(packed, 'm', new)} "
            "ELSE CAST(array() AS array<struct<hash: bigint, place: int>>) END")


def fingerprints(df: DataFrame, window: int, k: int, lengths: list[int]) -> DataFrame:
    """``df`` (with ``w``, words) exploded to its kept fingerprints: columns of ``df`` but w, (hash, place)."""
    others = [c for c in df.columns if c != "w"]
    whole = [f"transform({gram_hashes('h', m)}, (x, i) -> struct(x AS hash, i AS place))" for m in lengths]
    full = bound(gram_hashes("h", k), "g", kept("g", window - k + 1))
    marks = F.expr(bound("transform(w, x -> xxhash64(x))", "h", f"concat({', '.join([full, *whole])})"))
    found = df.select(*others, F.explode(marks).alias("p")).where("p IS NOT NULL")
    return found.select(*others, "p.hash", "p.place")


def window_fingerprints(windows: DataFrame, window: int, k: int) -> DataFrame:
    """(hash, wid, inner) of full ``windows`` (w, wid): every place of the least gram hash."""
    low = -(1 << (window - k + 1).bit_length())
    grams = bound("transform(w, x -> xxhash64(x))", "h", gram_hashes("h", k))
    each = windows.select("wid", F.posexplode(F.expr(grams)).alias("inner", "x"))
    each = each.select("wid", "inner", F.expr(f"x & {low}L").alias("hash"))
    least = each.groupBy("wid").agg(F.min("hash").alias("hash"))
    return each.join(least, ["wid", "hash"]).select("hash", "wid", "inner")


def hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = GRAM,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items, contaminated, _mark) for every row of ``docs``.

    ``items`` are the ids, as strings and sorted, of the items with a window in the document.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(item_text)).alias("w"))
    items = items.where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    each = items.withColumn("size", size).withColumn("at", F.explode(F.expr("sequence(0, size(w) - size)")))
    each = each.select("item", F.expr("slice(w, at + 1, size)").alias("w"))
    owners = stage(each.distinct(), "window-items")
    windows = stage(owners.select("w").distinct().withColumn("wid", F.sha2(F.concat_ws(" ", "w"), 256)), "windows")
    sizes = windows.select(F.size("w").alias("n")).distinct().where(f"n < {window}")
    lengths = sorted(r["n"] for r in sizes.collect())  # at most window - 1 numbers

    marks = window_fingerprints(windows.where(F.size("w") == window), window, k)
    for m in lengths:
        part = fingerprints(windows.where(F.size("w") == m), window, k, [m])
        marks = marks.unionByName(part.select("hash", "wid", F.col("place").alias("inner")))
    marks = stage(marks, "window-fingerprints")

    mark = repeats.mark(F.col(text_col))
    base = docs.select(F.col(id_col).cast("long").alias("id"), mark.alias("mark"), F.col(text_col).alias("text"))
    found = fingerprints(base.select("id", "mark", words(F.col("text")).alias("w")), window, k, lengths)
    near = found.join(marks, "hash").select("id", "mark", "wid", (F.col("place") - F.col("inner")).alias("at"))
    near = near.where("at >= 0").distinct().join(windows, "wid")
    by_doc = stage(near.groupBy("id", "mark").agg(F.collect_list(F.struct("at", "w", "wid")).alias("near")), "candidates")

    c = by_doc.withColumnsRenamed({"id": "cid", "mark": "cmark"})
    met = base["id"].eqNullSafe(c["cid"]) & (base["mark"] == c["cmark"])
    compared = F.transform(F.array(words(F.col("text"))), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.filter("near", lambda x: F.slice(w, x["at"] + 1, F.size(x["w"])) == x["w"]).alias("sure")))[0]
    joined = base.join(c, met, "left").select("id", "mark", compared.alias("c")).select("id", "mark", "c.n_words", "c.sure")
    places = F.flatten(F.transform("sure", lambda x: F.sequence(x["at"], x["at"] + F.size(x["w"]) - 1)))
    joined = joined.select(
        "id", "mark", "n_words", F.coalesce(F.size(F.array_distinct(places)), F.lit(0)).cast("long").alias("n_hit"),
        F.array_distinct(F.transform("sure", lambda x: x["wid"])).alias("wids"))
    met_windows = stage(joined, "contamination")
    owned = owners.withColumn("wid", F.sha2(F.concat_ws(" ", "w"), 256)).select("wid", "item")
    named = met_windows.where("n_hit > 0").select("id", "mark", F.explode("wids").alias("wid")).distinct().join(owned, "wid")
    named = named.groupBy("id", "mark").agg(F.sort_array(F.collect_set("item")).alias("items"))
    named = named.withColumnsRenamed({"id": "nid", "mark": "nmark"})
    out = met_windows.join(named, met_windows["id"].eqNullSafe(named["nid"]) & (met_windows["mark"] == named["nmark"]), "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), ids.alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"), F.col("mark").alias("_mark"))


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with all columns."""
    bad = hits(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("bid"), F.col("_mark").alias("bmark")).distinct()
    met = docs["doc_id"].cast("long").eqNullSafe(bad["bid"]) & (repeats.mark(docs["text"]) == bad["bmark"])
    return docs.join(bad, met, "left_anti")


def op5_decontamination(spark, sf_dir):
    """Words of every document under a ten-word window of the benchmark, with the items."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")
