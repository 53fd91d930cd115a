import datetime as dt

import pytest

from pedalytics.config import LAYOUT_OF_KEY_BY_HEADER
from pedalytics.plans import audit
from pedalytics.schemas import INGEST_LOG, MANIFEST_FILE, STAGE_MANIFEST
from pedalytics.sources.files import describe_files


def manifest(spark, *files):
    rows = [(f, "nyc", "dc497b4333c4", "STAGING_NYC", "TRIPS_MODERN", 10, 1, None) for f in files]
    return spark.createDataFrame(rows, STAGE_MANIFEST)


def log(spark, *entries):
    names = INGEST_LOG.fieldNames()
    rows = []
    for n, entry in enumerate(entries, 1):
        base = dict.fromkeys(names) | {
            "log_id": n, "attempt": 1, "status": "SUCCESS", "region": "nyc",
            "sf_schema": "STAGING_NYC", "sf_table": "TRIPS_MODERN", "rows_loaded": 5,
            "errors_seen": 0, "ended_at_utc": dt.datetime(2024, 1, n),
        }
        rows.append(tuple((base | entry)[name] for name in names))
    return spark.createDataFrame(rows, INGEST_LOG)


@pytest.fixture(scope="module")
def history(spark):
    return log(
        spark,
        dict(output_file="redone", status="FAILED", error_message="x"),
        dict(output_file="redone", attempt=2),
        dict(output_file="broken"),
        dict(output_file="broken", status="FAILED", attempt=2, error_message="y", rows_loaded=0),
        dict(output_file="partial", errors_seen=3),
        dict(output_file="hopeless", status="FAILED", attempt=3),
        dict(output_file="dry", status="DRY_RUN"),
    )


def test_pending_files(spark, history):
    files = manifest(spark, "redone", "broken", "partial", "hopeless", "dry", "new")
    rows = {r["output_file"]: r for r in audit.pending_files(files, history).collect()}
    assert list(rows) == ["broken", "dry", "hopeless", "new"]
    assert rows["broken"]["last_error"] == "y" and rows["new"]["last_status"] is None
    queue = {r["output_file"]: r["attempt"] for r in audit.work_queue(files, history).collect()}
    assert queue == {"broken": 3, "dry": 2, "hopeless": 4, "new": 1}
    assert audit.pending_files(files, history, "jersey_city").count() == 0


def decisions(files, latest, **options):
    rows = audit.retry_queue(files, latest, **options).collect()
    return {r["output_file"]: r["decision"] for r in rows}


def test_retry_rule(spark, history):
    files, latest = manifest(spark, "redone", "broken", "hopeless", "dry", "new"), audit.latest_status(history)
    base = {"redone": "DONE", "broken": "RUN", "hopeless": "GIVEN_UP", "dry": "RUN", "new": "RUN"}
    assert decisions(files, latest) == base
    assert decisions(files, latest, reset_failed=True) == base | {"hopeless": "RUN"}
    assert set(decisions(files, latest, force=True).values()) == {"RUN"}


def test_uploads_are_done_only_when_verified(spark):
    files = manifest(spark, "ok", "unverified", "missing")
    latest = spark.createDataFrame(
        [("ok", "SUCCESS", 1, True), ("unverified", "SUCCESS", 1, None), ("missing", "MISSING", 3, False)],
        "output_file string, status string, attempt int, stage_verified boolean",
    )
    assert decisions(files, latest, uploads=True) == {
        "ok": "DONE", "unverified": "RUN", "missing": "GIVEN_UP",
    }


def test_log_reports(history):
    assert [r[0] for r in audit.failed_files(history).collect()] == ["hopeless", "broken"]
    assert [tuple(r)[:4] for r in audit.partial_loads(history).collect()] == [("partial", "TRIPS_MODERN", 5, 3)]
    overview = {r["status"]: (r["file_count"], r["total_rows"]) for r in audit.run_overview(history).collect()}
    assert overview == {"SUCCESS": (3, 15), "FAILED": (3, 10), "DRY_RUN": (1, 5)}
    joined = {r["output_file"]: r["copy_status_raw"] for r in audit.statuses_by_file(history).collect()}
    assert joined["redone"] == "FAILED|SUCCESS"


def test_row_count_check(spark, history):
    tables = {("STAGING_NYC", "TRIPS_MODERN"): spark.range(12), ("STAGING_JC", "TRIPS_MODERN"): spark.range(3)}
    [row] = audit.row_count_check(history, audit.actual_counts(tables)).collect()
    assert (row["log_rows_loaded"], row["files_loaded"], row["actual_row_count"], row["discrepancy"]) == (
        15, 3, 12, 3,
    )


def test_routing(spark):
    rows = [
        ("a", "nyc", None, "473144999085", None, ["x", "y"], None),
        ("b", "jersey_city", None, "dc497b4333c4", 7, None, None),
        ("c", "mars", None, "nokey", 7, [], None),
        ("d", "nyc", None, "nokey", 7, [], None),
        ("e", None, None, None, 7, [], None),
    ]
    parts = spark.createDataFrame(rows, MANIFEST_FILE)
    routed = audit.routed(parts)
    got = {r["output_file"]: r for r in audit.manifest_rows(routed).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["sf_schema"], got["a"]["sf_table"]) == ("STAGING_NYC", "TRIPS_LEGACY_V1")
    assert (got["a"]["gzip_size_bytes"], got["a"]["source_file_count"]) == (0, 2)
    assert (got["b"]["sf_schema"], got["b"]["source_file_count"]) == ("STAGING_JC", 0)
    reasons = {r["output_file"]: r["reason"] for r in audit.skipped_entries(routed).collect()}
    assert reasons == {
        "c": "no schema for region mars", "d": "no table for key nokey", "e": "no schema for region ",
    }
    other = audit.manifest_rows(audit.routed(parts, LAYOUT_OF_KEY_BY_HEADER))
    assert other.filter("output_file = 'a'").first()["sf_table"] == "TRIPS_LEGACY_V2"
    assert [r[0] for r in audit.new_manifest_rows(audit.manifest_rows(routed), parts.limit(1)).collect()] == ["b"]


def test_schema_and_bundle_reports(spark):
    files = [(f"B1/f{n}.csv", 10, ["a", " b"]) for n in range(7)]
    files += [("B2/x/y.csv", 5, ["c"]), ("B2/in.zip", 5, None), ("B3/only.ZIP", 5, None), ("B4/t.txt", 1, None)]
    inventory = describe_files(
        spark.createDataFrame(files, "relative_path string, size_bytes long, columns array<string>")
    )
    first, second = audit.schema_signatures(inventory).orderBy("schema_signature").collect()
    assert tuple(first) == ("schema_1", 7, 2, "a|b", " ; ".join(f"B1/f{n}.csv" for n in range(5)))
    assert tuple(second)[:3] == ("schema_2", 1, 1)
    kinds = {r["bundle_name"]: r["structure_type"] for r in audit.bundle_structure(inventory).collect()}
    assert kinds == {
        "B1": "csv_present", "B2": "mixed_csv_and_nested_zip", "B3": "nested_zip_only", "B4": "empty_or_other",
    }
    [top] = audit.most_common_schemas(audit.schema_signatures(inventory), 1).collect()
    assert top["schema_signature"] == "schema_1"


def test_sizes_and_members(spark):
    index = spark.createDataFrame([(n, 100) for n in "abcdefg"], "file_name string, file_size_bytes long")
    local = spark.createDataFrame(
        [(n, 100) for n in "acdefg"] + [("b", 2000)], "file_name string, local_size long"
    ).filter("file_name <> 'a'")
    entries = spark.createDataFrame(
        [("b", "SUCCESS", 100), ("d", "FAILED", 100), ("e", "SUCCESS", None), ("f", "SUCCESS", 99), ("g", "SUCCESS", 100)],
        "file_name string, download_status string, file_size_bytes long",
    )
    reasons = {r["file_name"]: r["reason"] for r in audit.size_audit(index, local, entries).collect()}
    assert reasons == {
        "a": "missing_local_file", "b": "size_mismatch (local=2000, expected=100)", "c": "no_log_entry",
        "d": "log_status=FAILED", "e": "log_missing_size",
        "f": "log_size_mismatch (logged=99, expected=100)", "g": "complete",
    }
    assert [r["file_name"] for r in audit.missing_members(index, local, "file_name").collect()] == ["a"]
