"""Suffix-array dedup: byte strings that occur earlier, by a hash-compared suffix sort.

Suffixes that cannot repeat are left out first: ``repeats`` files every 100-byte string under a seed
and drops seeds that occur once, and stretches equal as a whole are settled by their hash and first
place. The suffixes that remain are dealt out by seed and sorted there: a merge sort whose comparisons
find the common extension of two suffixes by binary search over prefix polynomial hashes, so a
comparison takes logarithmic time. (A suffix whose hash is single in its task is left out of the sort.) Neighbours that agree over the threshold are compared byte by
byte; if a hash ever deceived, the sort is repeated with another base. Stretches of a seed with many
are filed again under longer seeds, which part what differs and keep equal strings together. A seed
with more stretches than one task should sort is settled by 128-bit hashes and a combined minimum, and
each string found so is compared with the bytes of its head.

Nulls are empty texts. Order is by id (null first), then place; repeated rows of one id and text are
one document. Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalytics.llm import repeats, scan
from pedalytics.session import stage

LENGTH = 100
SEED = 28
LONGER = 88  # seed of stretches whose first seed has more than CROWD kinds
CROWD = 256
MOST = 30_000  # kinds of a seed that one task sorts
BATCH = 60_000


def common_extension(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int, lane: int) -> np.ndarray:
    """Length of the longest common prefix of suffixes ``a`` and ``b``, at most ``limit``."""
    inverse = scan.powers(len(prefix), lane, True)
    low, high = np.zeros(len(a), np.int64), np.full(len(a), limit)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) >> 1
        same = (prefix[a + mid] - prefix[a]) * inverse[a] == (prefix[b + mid] - prefix[b]) * inverse[b]
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)


def merge_sort(data: np.ndarray, at: np.ndarray, group: np.ndarray, limit: int, lane: int) -> np.ndarray:
    """Order of the suffixes at ``at`` by their first ``limit`` bytes within each (consecutive) group."""
    n = len(at)
    prefix = scan.prefix_hashes(scan.BYTE_VALUES[data], lane)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(first, n))
    base, length = np.repeat(first, size), np.repeat(size, size)
    order, width = np.arange(n), 1

    def before(x, y):
        """-1, 0 or 1 as suffix x stands before, equal to or after suffix y."""
        p, q = at[x], at[y]
        common = common_extension(prefix, p, q, limit, lane)
        step = np.minimum(common, limit - 1)
        return np.where(common == limit, 0, np.sign(data[p + step].astype(np.int64) - data[q + step]))

    while width < (size.max() if n else 0):
        move = np.flatnonzero(length > width)
        inner = move - base[move]
        run = inner // width
        other = (run ^ 1) * width
        low = np.minimum(other, length[move])
        start, high = low.copy(), np.minimum(other + width, length[move])
        right = (run & 1).astype(bool)
        mine = order[move]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            sign = before(order[base[move[open_]] + mid], mine[open_])
            below = (sign < 0) | (right[open_] & (sign == 0))
            low[open_[below]] = mid[below] + 1
            high[open_[~below]] = mid[~below]
        place = base[move] + np.minimum(run, run ^ 1) * width + (inner - run * width) + (low - start)
        merged = order.copy()
        merged[place] = mine
        order, width = merged, width * 2
    return order


def repeated(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Indices of the suffixes whose hash of ``length`` bytes occurs twice in their group; no other can repeat."""
    hashes = scan.stretch_hashes(scan.prefix_hashes(scan.BYTE_VALUES[data]), at, at + length) ^ scan.mix(group.astype(np.uint64))
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return np.flatnonzero(twice)


def equal_strings(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """A number for each suffix; two have the same one if group and first ``length`` bytes agree."""
    if not len(at):
        return np.zeros(0, np.int64)
    for lane in (0, 1, 2):
        order = merge_sort(data, at, group, length, lane)
        a, b = order[:-1], order[1:]
        prefix = scan.prefix_hashes(scan.BYTE_VALUES[data], lane)
        same = (group[a] == group[b]) & (common_extension(prefix, at[a], at[b], length, lane) == length)
        pairs = np.flatnonzero(same)
        reach = np.arange(length)
        sure = all(
            (data[at[a[p]][:, None] + reach] == data[at[b[p]][:, None] + reach]).all()
            for p in np.array_split(pairs, max(1, len(pairs) // 20_000))
        )
        if sure:
            number = np.empty(len(at), np.int64)
            number[order] = np.cumsum(np.append(0, ~same))
            return number
    raise RuntimeError("three hash bases collided")


_SPAN = pa.schema([("seed", pa.int64()), ("_id", pa.int64()), ("_mark", pa.int64()), ("start", pa.int64()),
                   ("bytes", pa.binary())])


def _spans(length: int, longer: int, crowd: int):
    """Stretches of texts with their bytes; those of crowded seeds are parted by longer seeds."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.slices(batches):
            ids, marks, open_runs = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            rows: list[tuple] = []
            for texts in scan.chunks(batch.column(2)):
                crowded, owners = [], []
                for i in range(len(texts)):
                    row = texts.first + i
                    for run in open_runs[row].as_py():
                        at, n = int(texts.bounds[i]) + run["start"], run["n"]
                        piece = texts.data[at : at + n - 1 + length]
                        owner = (run["seed"], ids[row], marks[row], run["start"])
                        if run["kinds"] <= crowd:
                            rows.append((*owner, piece.tobytes()))
                        else:
                            crowded.append(piece)
                            owners.append(owner)
                if crowded:
                    bounds = np.append(0, np.cumsum([len(p) for p in crowded]))
                    parts = scan.Texts(0, np.concatenate(crowded), bounds)
                    found = scan.winnow(scan.byte_tokens(parts), length, longer)
                    for seed, text, start, n in zip(found.seed.view(np.int64).tolist(), found.text.tolist(),
                                                    found.start.tolist(), found.count.tolist()):
                        first, i, mark, at = owners[text]
                        rows.append((first ^ seed, i, mark, at + start, crowded[text][start : start + n - 1 + length].tobytes()))
            for at in range(0, len(rows), 20_000):
                part = zip(zip(*rows[at : at + 20_000]), _SPAN.types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in part], schema=_SPAN)

    return spans


def _windows(length: int):
    """128-bit hashes of the windows of stretches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("_id", pa.int64()), ("_mark", pa.int64()), ("start", pa.int64())])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.slices(batches):
            for texts in scan.chunks(batch.column(2)):
                runs = [(i, int(texts.bounds[i]), r["start"], r["n"]) for i in range(len(texts))
                        for r in batch.column(3)[texts.first + i].as_py()]
                row = np.concatenate([np.full(n, i) for i, _, _, n in runs])
                start = np.concatenate([np.arange(s, s + n) for _, _, s, n in runs])
                at = start + texts.bounds[row]
                values = scan.BYTE_VALUES[texts.data]
                lanes = [scan.stretch_hashes(scan.prefix_hashes(values, lane), at, at + length, lane) for lane in (0, 2)]
                take = pa.array(row + texts.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in lanes]
                    + [batch.column(0).take(take), batch.column(1).take(take), pa.array(start)], schema=schema)

    return windows


def _later(length: int):
    """Of equal strings within a seed all but the first, as stretches."""
    schema = pa.schema([("_id", pa.int64()), ("_mark", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        column = {c: table[c].combine_chunks() for c in table.column_names}
        column = {c: v.chunk(0) if isinstance(v, pa.ChunkedArray) else v for c, v in column.items()}
        seeds = column["seed"].to_numpy()
        group = np.cumsum(np.append(0, seeds[1:] != seeds[:-1]))
        shared = pa.array(np.bincount(group)[group] > 1)  # a stretch alone under its seed repeats nothing
        group = group[np.asarray(shared)]
        column = {c: v.filter(shared) for c, v in column.items()}
        pieces = column["bytes"].cast(pa.large_binary())
        bounds = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        count = np.diff(bounds) - length + 1
        piece = np.repeat(np.arange(len(count)), count)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        again = repeated(data, bounds[piece] + inner, group[piece], length)
        piece, inner = piece[again], inner[again]
        number = equal_strings(data, bounds[piece] + inner, group[piece], length)
        null = np.asarray(column["_id"].is_valid())[piece]
        ids = column["_id"].fill_null(0).to_numpy()[piece]
        start = column["start"].to_numpy()[piece] + inner
        order = np.lexsort((start, ids, null, number))
        first = np.append(True, number[order[1:]] != number[order[:-1]])
        lead = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        later = order[(start[order] != start[lead]) | (ids[order] != ids[lead]) | (null[order] != null[lead])]
        take = pa.array(piece[later])
        return pa.RecordBatch.from_arrays(
            [column["_id"].take(take), column["_mark"].take(take), pa.array(start[later]),
             pa.array(np.full(len(later), length))], schema=schema)

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, 400)
                at += piece.num_rows
                held.append(piece)
                if sum(b.num_rows for b in held) * 35 < BATCH:
                    continue
                table = pa.Table.from_batches(held)
                seeds = table["seed"].to_numpy()
                last = np.flatnonzero(seeds[1:] != seeds[:-1])
                if len(last):  # groups that have ended; the last one may go on
                    yield settle(table.slice(0, last[-1] + 1).to_batches())
                    held = table.slice(last[-1] + 1).to_batches()
        if held:
            yield settle(held)

    return later


def earlier_stretches(
    docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
    most: int = MOST,
) -> DataFrame:
    """(_id, _mark, start, length): stretches whose strings of ``length`` bytes also start earlier.

    Texts shorter than ``length`` bytes have none; an empty table gives no rows.
    """
    texts = repeats.keyed(docs, id_col, text_col)
    again, classes, mixed = repeats.repeated_runs(texts, scan.byte_tokens, length, seed)
    copies = classes.where("copies > 1").select("seed", "span", "first")
    place = F.struct("_id", F.shiftright("place", 8).alias("start"))
    head = F.struct("first._id", F.shiftright(F.col("first.place"), 8).alias("start"))
    whole = repeats.unpack(again.join(copies, ["seed", "span"]).where(place != head)).select(
        "_id", "_mark", F.col("start").cast("long"), (F.col("n") + length - 1).cast("long").alias("length")
    )
    out = "_id long, _mark long, start long, length long"
    open_ = repeats.unpack(mixed.select("seed", "kinds", "first._id", "first._mark", "first.place"))

    def stretches(which: str) -> DataFrame:
        rows = open_.where(which).groupBy("_id", "_mark")
        rows = rows.agg(F.collect_list(F.struct("seed", "kinds", "start", "n")).alias("open"))
        return repeats.with_texts(texts, rows).select("_id", "_mark", "_text", "open")

    pieces = stretches(f"kinds <= {most}").mapInArrow(
        _spans(length, max(seed, length * LONGER // 100), CROWD), "seed long, _id long, _mark long, start long, bytes binary"
    )
    sorted_ = pieces.repartition("seed").sortWithinPartitions("seed").mapInArrow(_later(length), out)
    if open_.where(f"kinds > {most}").isEmpty():
        return whole.unionByName(sorted_)
    each = stage(
        stretches(f"kinds > {most}").mapInArrow(_windows(length), "a long, b long, _id long, _mark long, start long"),
        "crowded-windows",
    )
    heads = stage(each.groupBy("a", "b").agg(F.min(F.struct("_id", "start", "_mark")).alias("head"), F.count(F.lit(1)).alias("n")).where(
        "n > 1").drop("n"), "crowded-heads")
    later = each.join(heads, ["a", "b"]).where(F.struct("_id", "start") != F.struct("head._id", "head.start"))
    return whole.unionByName(sorted_).unionByName(_verified(later, texts, length))


def _verified(later: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Strings of ``later`` (_id, _mark, start, head), each compared with the bytes of its head."""
    pairs = later.groupBy("_id", "_mark", F.col("head._id").alias("hid"), F.col("head._mark").alias("hmark")).agg(
        F.collect_list(F.struct("start", F.col("head.start").alias("at"))).alias("places"))  # of two texts, so at most their length
    mine = repeats.with_texts(texts, pairs).select(
        F.col("_id").alias("id"), F.col("_mark").alias("mark"), F.col("_text").alias("text"), "places",
        F.col("hid").alias("_id"), F.col("hmark").alias("_mark"))
    both = repeats.with_texts(texts, mine).select("id", "mark", "text", "_text", "places")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = row["text"].encode(), row["_text"].encode()
                start = [p["start"] for p in row["places"]]
                if any(a[p["start"] : p["start"] + length] != b[p["at"] : p["at"] + length] for p in row["places"]):
                    raise RuntimeError("a 128-bit hash collided")
                n = len(start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["id"]] * n, pa.int64()), pa.array([row["mark"]] * n, pa.int64()), pa.array(start, pa.int64()),
                     pa.array([length] * n, pa.int64())], names=["_id", "_mark", "start", "length"])

    return both.mapInArrow(compare, "_id long, _mark long, start long, length long")


def remove_earlier(
    docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, mark, n_bytes, n_removed, n_spans, kept binary) for each row of ``docs``.

    ``n_spans`` counts maximal removed runs; ``kept`` are the bytes that remain, which may cut a code
    point (``without_repeats`` gives whole ones).
    """
    texts = repeats.keyed(docs, id_col, text_col)
    found = repeats.intervals(earlier_stretches(docs, length, seed, id_col, text_col))
    joined = repeats.with_texts(texts, found, "left").select("_id", "_text", "starts", "lengths")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.slices(batches):
            texts = batch.column(1).cast(pa.large_binary())
            n_bytes, removed, spans, kept = [], [], [], []
            for i in range(batch.num_rows):
                raw = texts[i].as_py() or b""
                starts = batch.column(2)[i].as_py()
                n_bytes.append(len(raw))
                if starts:
                    gone = scan.covered(np.array(starts), np.array(batch.column(3)[i].as_py()), len(raw))
                    spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                    removed.append(int(gone.sum()))
                    raw = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                else:
                    spans.append(0)
                    removed.append(0)
                kept.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(cut, f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, their texts without what occurs earlier.

    Only whole code points go, so a removed stretch may be shorter at its ends. A column ``n_chars`` is
    set anew. A text of which only white space is left is dropped; others that had none stay.
    """
    found = repeats.intervals(earlier_stretches(docs, length, SEED, id_col, text_col)).toDF("fid", "fmark", "starts", "lengths")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"),
        repeats.mark(F.col(text_col)).alias("mark"))
    met = rows["id"].eqNullSafe(found["fid"]) & (rows["mark"] == found["fmark"])
    joined = rows.join(found, met, "left").select("row", "starts", "lengths")
    docs_columns = docs.columns
    at = docs_columns.index(text_col)
    count = docs_columns.index("n_chars") if "n_chars" in docs_columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan.slices(batches):
            texts, keep = [], []
            columns = batch.column(0).flatten()
            for text, starts, lengths in zip(columns[at], batch.column(1), batch.column(2)):
                text, starts = text.as_py(), starts.as_py()
                if starts:
                    raw = np.frombuffer(text.encode(), np.uint8)
                    gone = scan.covered(np.array(starts), np.array(lengths.as_py()), len(raw))
                    point = np.cumsum((raw & 0xC0) != 0x80) - 1
                    whole = np.bincount(point, gone) == np.bincount(point)
                    text = raw[~whole[point]].tobytes().decode()
                texts.append(text)
                keep.append(not starts or bool(text.strip()))
            columns[at] = pa.array(texts, pa.string())
            if count is not None:
                columns[count] = pa.array([len(t) if t is not None else None for t in texts]).cast(columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(cut, docs.schema)


def op10_suffix_dedup(spark, sf_dir):
    """Bytes of every document that no earlier 100-byte string covers, as a digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = remove_earlier(docs)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
