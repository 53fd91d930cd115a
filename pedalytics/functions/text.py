"""Column expressions on names, paths, headers and free-text codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from pedalytics import config

NULL_TOKENS = ("", "NULL", "null")


def null_if_token(c: Column) -> Column:
    """Empty and spelled-out nulls of a raw field become null."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def canonical_name(c: Column) -> Column:
    return F.trim(F.upper(c))


def clean_code(c: Column) -> Column:
    return F.lower(F.trim(c))


def rider_type(c: Column) -> Column:
    return F.coalesce(clean_code(c), F.lit("unknown"))


def rider_type_of_user_type(c: Column) -> Column:
    """Legacy user types in terms of the modern rider types; other values just lower-cased."""
    lowered = F.lower(c)
    return (
        F.when(lowered == "subscriber", "member")
        .when(lowered == "customer", "casual")
        .otherwise(lowered)
    )


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def below(path: Column, folder: str) -> Column:
    """Path relative to a folder that it contains."""
    base = folder.rstrip("/") + "/"
    return F.substr(path, F.instr(path, F.lit(base)) + len(base))


def decoded(uri: Column) -> Column:
    """Percent-encoded file address as a plain path; a plus sign stands for itself."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def extension(name: Column) -> Column:
    dotted = F.lower(F.element_at(F.split(name, r"\."), -1))
    return F.when(name.contains("."), dotted).otherwise("unknown")


def megabytes(size: Column) -> Column:
    return F.round(size / F.lit(1024.0 * 1024.0), 2)


def layout_key(source_file: Column, by_split: bool = False) -> Column:
    """The layout fingerprint in a part's name ``<region>_<key>_part<n>.csv.gz``."""
    if by_split:
        return F.split_part(source_file, F.lit("_"), F.lit(2))
    return F.regexp_extract(source_file, "_([0-9a-f]{12})_part", 1)


def layout_label(
    source_file: Column,
    layout_of_key: Mapping[str, str] = config.LAYOUT_OF_KEY,
    by_split: bool = False,
) -> Column:
    """Layout name of a source file; unknown keys count as the second legacy layout."""
    label = lookup(layout_key(source_file, by_split), layout_of_key)
    return F.coalesce(label, F.lit(config.LEGACY_V2))


def region_of_path(relative_path: Column) -> Column:
    """Region by the ``JC-`` prefix of the file name, of the first folder or of any folder."""
    path = F.replace(relative_path, F.lit("\\"), F.lit("/"))
    marked = (
        F.upper(basename(path)).startswith("JC-")
        | F.upper(path).startswith("JC-")
        | path.contains("/JC-")
    )
    return F.when(marked, config.JERSEY_CITY.name).otherwise(config.NYC.name)


def header_columns(line: Column) -> Column:
    """Split a CSV header line on the commas outside quotes."""
    parts = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(parts, lambda c: F.regexp_replace(F.trim(c), r'^"|"$', ""))


def normalized_header(columns: Column) -> Column:
    """Lower-cased, trimmed column names joined by '|'; null where there is no header."""
    return F.array_join(F.transform(columns, lambda c: F.lower(F.trim(c))), "|")


def header_fingerprint(columns: Column) -> Column:
    return F.substring(F.md5(normalized_header(columns)), 1, 12)


def lookup(key: Column, mapping: Mapping[str, str]) -> Column:
    """Constant lookup for a small fixed mapping; null when the key is unknown.

    A literal map rather than a chain of conditions: the key expression is evaluated once.
    """
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)
