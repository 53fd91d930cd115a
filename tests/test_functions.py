import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalytics.functions import ride, text, time
from pedalytics.schemas import RAW_HEADER
from pedalytics.sources import csv_parts
from pedalytics.sources.files import index_entry


def column(spark, values, dtype, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_rider_types(spark):
    users = ["Subscriber", "CUSTOMER", "Dependent", None]
    assert column(spark, users, "string", text.rider_type_of_user_type) == [
        "member", "casual", "dependent", None,
    ]
    assert column(spark, [" Member ", None, ""], "string", text.rider_type) == ["member", "unknown", ""]


def test_null_tokens_and_names(spark):
    assert column(spark, ["", "NULL", "null", "Null", "x", None], "string", text.null_if_token) == [
        None, None, None, "Null", "x", None,
    ]
    assert column(spark, [" w 21 st ", "W 21 ST"], "string", text.canonical_name) == ["W 21 ST"] * 2


def test_layout_label(spark):
    names = [
        "nyc_dc497b4333c4_part0001.csv.gz",
        "jersey_city_dc497b4333c4_part0001.csv.gz",
        "nyc_473144999085_part0001.csv.gz",
        "nyc_e24ee8457e0e_part0001.csv.gz",
        "other.csv",
    ]
    assert column(spark, names, "string", text.layout_label) == [
        "MODERN", "MODERN", "LEGACY_V1", "LEGACY_V2", "LEGACY_V2",
    ]
    by_split = column(spark, names, "string", lambda c: text.layout_label(c, by_split=True))
    assert by_split == ["MODERN", "LEGACY_V2", "LEGACY_V1", "LEGACY_V2", "LEGACY_V2"]


def test_region_of_path(spark):
    paths = ["x/JC-201509.csv", "x/jc-1.csv", "JC-2015/x.csv", "a/JC-b/x.csv", "a/jc-b/x.csv", "x/y.csv"]
    jc, nyc = "jersey_city", "nyc"
    assert column(spark, paths, "string", text.region_of_path) == [jc, jc, jc, jc, nyc, nyc]


def test_fingerprints_of_the_known_headers(spark):
    keys = {}
    for layout, header in RAW_HEADER.items():
        line = ",".join(f'"{c}"' for c in header)
        [keys[layout]] = column(
            spark, [line], "string", lambda c: text.header_fingerprint(text.header_columns(c))
        )
    assert keys == {
        "MODERN": "dc497b4333c4", "LEGACY_V1": "e24ee8457e0e", "LEGACY_V2": "473144999085",
    }


def test_fingerprint_ignores_case_and_spaces_and_keeps_null(spark):
    df = spark.createDataFrame([([" A", "b "],), (["a", "B"],), (None,)], "x array<string>")
    one, two, none = [r[0] for r in df.select(text.header_fingerprint(F.col("x"))).collect()]
    assert one == two and len(one) == 12 and none is None


def test_file_names(spark):
    assert column(spark, ["a/b.CSV", "noext", "x.tar.gz"], "string", text.extension) == [
        "csv", "unknown", "gz",
    ]
    df = spark.createDataFrame([("k/2013-x.ZIP", 5)], "key string, size long")
    entry = df.select(*index_entry(F.col("key"), F.col("size"), F.lit(None), "https://h/")).first()
    assert (entry["file_name"], entry["file_format"], entry["file_url"]) == (
        "2013-x.ZIP", "zip", "https://h/k/2013-x.ZIP",
    )
    assert column(spark, [1024 * 1024 * 3 // 2], "long", text.megabytes) == [1.5]


def test_source_label(spark):
    paths = [
        "file:/in/nyc_dc497b4333c4_part0001.csv.gz",
        "file:/out/region=nyc/schema_key=dc497b4333c4/part=0002/part-1.csv.gz",
    ]
    assert column(spark, paths, "string", csv_parts.source_label) == [
        "nyc_dc497b4333c4_part0001.csv.gz", "nyc_dc497b4333c4_part0002-part-1.csv.gz",
    ]


def test_seconds_count_boundaries(spark):
    start = dt.datetime(2024, 1, 1, 0, 0, 0, 900_000)
    ends = [dt.datetime(2024, 1, 1, 0, 0, 2, 100_000), dt.datetime(2024, 1, 2), start, None]
    df = spark.createDataFrame([(start, e) for e in ends], "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(time.seconds_between(F.col("a"), F.col("b"))).collect()]
    assert got == [2, 86_400, 0, None]


def test_seconds_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame(
        [(dt.datetime(2024, 3, 10, 1, 59), dt.datetime(2024, 3, 10, 3, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(time.seconds_between(F.col("a"), F.col("b"))).first()[0] == 3720
        parsed = spark.createDataFrame([("2024-03-10 02:30:00",)], "x string")
        got = parsed.select(time.parse_timestamp(F.col("x"))).first()[0]
        assert got == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_timestamp_spellings(spark):
    texts = [
        "2015-06-01 00:00:00", "2015-06-01 00:00:00.9", "2015-06-01T07:08:09.123456", "2015-06-01",
        "6/1/2015 0:00", "6/1/2015 13:05:09", "12/31/2015", "soon", "13/1/2015 0:00", None,
    ]
    day = dt.datetime(2015, 6, 1)
    assert column(spark, texts, "string", time.parse_timestamp) == [
        day, day.replace(microsecond=900_000), dt.datetime(2015, 6, 1, 7, 8, 9, 123456), day,
        day, day.replace(hour=13, minute=5, second=9), dt.datetime(2015, 12, 31), None, None, None,
    ]


def test_numbers_from_text(spark):
    def as_int(c):
        return csv_parts.typed_column(c, T.IntegerType())

    assert column(spark, ["1985", "1985.0", "1985.6", "abc", "99999999999", None], "string", as_int) == [
        1985, 1985, 1986, None, None, None,
    ]


@pytest.mark.parametrize(
    ("born", "age", "band"),
    [
        (None, None, None), (1885, None, "65+"), (1900, 116, "65+"), (2010, 6, "<18"),
        (2015, None, "<18"), (1999, 17, "<18"), (1998, 18, "18-24"), (1992, 24, "18-24"),
        (1991, 25, "25-34"), (1982, 34, "25-34"), (1981, 35, "35-44"), (1972, 44, "35-44"),
        (1971, 45, "45-54"), (1962, 54, "45-54"), (1961, 55, "55-64"), (1952, 64, "55-64"),
        (1951, 65, "65+"),
    ],
)
def test_ages(spark, born, age, band):
    df = spark.createDataFrame([(dt.datetime(2016, 7, 1), born)], "t timestamp_ntz, b int")
    got = df.select(ride.age_at(F.col("t"), F.col("b")), ride.age_band(F.col("t"), F.col("b"))).first()
    assert tuple(got) == (age, band)


def test_decimal_figures(spark):
    d = decimal.Decimal
    assert column(spark, [600, 61, 86_400], "long", ride.minutes) == [d("10.00"), d("1.02"), d("1440.00")]
    df = spark.createDataFrame([(d("2.01"), 2), (d("0.00"), 0), (None, None)], "s decimal(20,2), n long")
    assert [r[0] for r in df.select(ride.mean(F.col("s"), F.col("n"))).collect()] == [d("1.01"), None, None]
    df = spark.createDataFrame([(10, 8), (5, 0), (5, None), (1, 3), (3, 800)], "x long, p long")
    growth = [r[0] for r in df.select(ride.growth_pct(F.col("x"), F.col("p"))).collect()]
    assert growth == [d("25.00"), None, None, d("-66.67"), d("-99.63")]
