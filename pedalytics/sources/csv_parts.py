"""Compressed CSV parts of a known layout: positional scan, lineage, null tokens, typed columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalytics.functions import text, time
from pedalytics.schemas import LAYOUT_SCHEMA
from pedalytics.session import one_file_per_task
from pedalytics.sources.files import file_key, file_keys

ROW_BITS = 33  # monotonically_increasing_id: partition above, position in the partition below


_FOLDERS = r"region=([^/]+)/schema_key=([^/]+)/part="


def source_label(path: Column) -> Column:
    """Lineage name of a part: its file name, led by region and key when it lies in their folders.

    It is made for every row, so the pattern looks at the last folders alone where they are these.
    """
    tail = F.substring_index(path, "/", -4)
    folders = F.when(tail.rlike("^" + _FOLDERS), tail).otherwise(path)
    in_folders = F.replace(F.regexp_replace(folders, "^.*" + _FOLDERS, "$1_$2_part"), F.lit("/"), F.lit("-"))
    return F.when(path.contains("/schema_key="), in_folders).otherwise(text.basename(path))


# ``source_label`` of the column output_file, in SQL.
LABEL_SQL = r"""CASE WHEN concat('/', output_file) LIKE '%/schema_key=%' THEN replace(regexp_replace(concat('/', output_file),
  r'^.*region=([^/]+)/schema_key=([^/]+)/part=', '$1_$2_part'), '/', '-')
  ELSE element_at(split(output_file, '/'), -1) END"""


def _numbered(spark: SparkSession, paths: str | Sequence[str], layout: str) -> tuple[DataFrame, DataFrame]:
    """Rows of parts as they are read, with ``_file``, the key of their file, and their number; the label of each key.

    Every file is one task (compressed CSV cannot be split, and multi-line parsing keeps plain CSV
    whole too), so a row's position in its partition is its position in the file: numbering needs
    no shuffle. It is assigned before any row is dropped. Labels are made once a file, from the scan's own listing.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in LAYOUT_SCHEMA[layout].fieldNames()])
    scan = (
        one_file_per_task(spark)
        .read.schema(schema)
        .options(header=True, enforceSchema=True, multiLine=True, quote='"', escape='"')
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    position = F.monotonically_increasing_id().bitwiseAND((1 << ROW_BITS) - 1) + 1
    rows = scan.select("*", file_key().alias("_file"), position.alias("_source_row_number"))
    return rows, file_keys(spark, scan).select("_file", source_label(F.col("path")).alias("_label"))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the label of their file as ``_source_file`` in place of its key."""
    unknown = F.raise_error(F.lit("a row comes from a file that the scan did not list"))
    label = F.coalesce("_label", unknown).alias("_source_file")
    columns = [label if c == "_file" else F.col(c) for c in rows.columns]
    return rows.join(F.broadcast(labels), "_file", "left").select(*columns)


def raw_parts(spark: SparkSession, paths: str | Sequence[str], layout: str) -> DataFrame:
    """Parts as text columns bound by position, with null tokens removed and lineage added."""
    rows, labels = _numbered(spark, paths, layout)
    names = LAYOUT_SCHEMA[layout].fieldNames()
    return _labelled(rows.select(*[text.null_if_token(F.col(n)).alias(n) for n in names], "_file", "_source_row_number"), labels)


def raw_schema(layout: str) -> T.StructType:
    """Columns of ``raw_parts``: the layout's fields as text, file name and row number."""
    names = [*LAYOUT_SCHEMA[layout].fieldNames(), "_source_file"]
    fields = [T.StructField(n, T.StringType()) for n in names]
    return T.StructType([*fields, T.StructField("_source_row_number", T.LongType())])


def typed_column(raw: Column, dtype: T.DataType) -> Column:
    """Text as ``dtype``; null when it does not read as one. Whole numbers may carry decimals."""
    if isinstance(dtype, T.TimestampNTZType):
        return time.parse_timestamp(raw)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.coalesce(
            raw.try_cast(dtype), F.round(raw.try_cast("decimal(38,6)")).try_cast(dtype)
        )
    return raw.try_cast(dtype)


def typed_parts(raw: DataFrame, layout: str) -> DataFrame:
    """Typed columns, load time, and ``_error``: the fields that did not read, null for good rows."""
    fields = LAYOUT_SCHEMA[layout].fields
    return _with_error(_typed(raw, layout, lambda c: c, "_source_file"), layout).select(
        *[f.name for f in fields], "_source_file", "_source_row_number", "_loaded_at", "_error")


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _typed(raw: DataFrame, layout: str, known: Callable[[Column], Column], *lineage: str) -> DataFrame:
    """Typed columns and ``_unread``, a bit for each field that has a text which does not read as its type.

    ``known`` makes null of a text that stands for it. No such text reads as a number or time, so it is looked at
    only where a field did not read. One projection, in which the value and the check share the parse.
    """
    fields = LAYOUT_SCHEMA[layout].fields
    values = {f.name: known(F.col(f.name)) if _is_text(f) else typed_column(F.col(f.name), f.dataType) for f in fields}
    parsed = [f.name for f in fields if not _is_text(f)]
    bits = [
        F.when(values[n].isNull() & known(F.col(n)).isNotNull(), 1 << at).otherwise(0) for at, n in enumerate(parsed)
    ]
    unread = reduce(Column.bitwiseOR, bits).alias("_unread")
    return raw.select(*[c.alias(n) for n, c in values.items()], *lineage, "_source_row_number", unread)


def _with_error(typed: DataFrame, layout: str) -> DataFrame:
    """``typed`` with the load time, and the names of unread fields in ``_error`` in place of their bits."""
    parsed = [f.name for f in LAYOUT_SCHEMA[layout].fields if not _is_text(f)]
    names = [F.when(F.col("_unread").bitwiseAND(1 << at) != 0, n) for at, n in enumerate(parsed)]
    error = F.when(F.col("_unread") != 0, F.concat_ws(",", *names))
    columns = [c for c in typed.columns if c != "_unread"]
    return typed.select(*columns, time.now().alias("_loaded_at"), error.alias("_error"))


def read_parts(spark: SparkSession, paths: str | Sequence[str], layout: str) -> DataFrame:
    """Typed rows of parts; they meet the name of their file when most columns are a few bytes wide."""
    rows, labels = _numbered(spark, paths, layout)
    return _with_error(_labelled(_typed(rows, layout, text.null_if_token, "_file"), labels), layout)


def good_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("_error").isNull()).drop("_error")


def load_counts(typed: DataFrame) -> DataFrame:
    """Rows loaded and rejected per file, and whether numbering started at 1 as it must."""
    return typed.groupBy("_source_file").agg(
        F.count_if(F.col("_error").isNull()).alias("rows_loaded"),
        F.count_if(F.col("_error").isNotNull()).alias("errors_seen"),
        (F.min("_source_row_number") == 1).alias("numbered"),
    )
