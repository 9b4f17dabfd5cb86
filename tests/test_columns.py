"""Edge rows for the column functions (expected values from the reference's rules)."""

import datetime as dt

from pyspark.sql import functions as F

from quakehouse.functions import columns as C
from quakehouse.operators import ingest as I
from quakehouse.operators.facts import casualty_split
from quakehouse.operators.quality import bucket_label


def _one(spark, values, ddl, expr):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(expr).collect()]


def test_int_or_null(spark):
    got = _one(spark, ["12.9", "-0.5", "-3", "nan", "inf", "", None, "abc"], "s string",
               C.int_or_null("s"))
    assert got == [12, 0, None, None, None, None, None, None]


def test_bigint_or_null_bankers_rounding(spark):
    assert _one(spark, ["2.5", "3.5", "-1"], "s string", C.bigint_or_null("s")) == [2, 4, None]


def test_float_or_null(spark):
    got = _one(spark, ["1.5", "nan", "x", " 7 ", "1_000"], "s string", C.float_or_null("s"))
    assert got == [1.5, None, None, 7.0, 1000.0]


def test_clean_and_cut_strings(spark):
    assert _one(spark, [" abcd ", "", "  "], "s string", C.clean_str("s", 3)) == ["abc", None, ""]
    assert _one(spark, [None, "abcdef"], "s string", C.cut_str("s", 3)) == ["", "abc"]


def test_contains_flag(spark):
    assert _one(spark, ["Tsunami/Slide", None, "fire"], "s string",
                C.contains_flag("s", "tsunami")) == [1, 0, 0]


def test_prefix_date(spark):
    got = _one(spark, ["2024-01-15T06:42:11.340Z", "None", "2024-13-01"], "s string",
               C.prefix_date("s"))
    assert got == [dt.date(2024, 1, 15), None, None]


def test_partial_dates(spark):
    df = spark.createDataFrame(
        [(2004, 12, 26, 2005, None, None), (2004, 1, 31, 2004, 2, None)],
        "sy int, sm int, sd int, ey int, em int, ed int")
    rows = df.select(C.partial_start("sy", "sm", "sd").alias("s"),
                     C.partial_end("ey", "em", "ed", "sy", "sm", "sd").alias("e")).collect()
    assert rows[0]["s"] == dt.date(2004, 12, 26) and rows[0]["e"] == dt.date(2005, 12, 26)
    assert rows[1]["e"] is None  # Feb 31 -> NULL (rejected), not a failure


def test_dates_are_made_from_numbers_not_from_text(spark):
    rows = [(2000, 2, 29), (1900, 2, 29), (2001, 13, 1), (2001, 0, 1), (2001, 4, 31), (1, 1, 1), (9999, 12, 31), (0, 1, 1),
            (10000, 1, 1), (None, 1, 1), (2001, None, 1), (2001, 1, None), (-5, 1, 1), (2001, -1, 1), (1582, 10, 10), (2001, 100, 1)]
    df = spark.createDataFrame(rows, "y int, m int, d int").select("*", C.safe_make_date("y", "m", "d").alias("made"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "format_string" not in text and "gettimestamp" not in text
    assert [r.made for r in df.collect()] == [dt.date(2000, 2, 29), None, None, None, None, dt.date(1, 1, 1), dt.date(9999, 12, 31),
                                              None, None, None, None, None, None, None, dt.date(1582, 10, 10), None]


def test_casualty_split(spark):
    df = spark.createDataFrame([(100, 30, 50, 40), (None, 5, None, None)],
                               "total int, inj int, aff int, hom int")
    s = casualty_split("total", "inj", "aff", "hom")
    rows = df.select(*[v.alias(k) for k, v in s.items()]).collect()
    assert (rows[0]["NumInjuries"], rows[0]["NumOtherAffected"], rows[0]["NumHomeless"]) == (30, -20, 40)
    assert (rows[1]["NumInjuries"], rows[1]["NumOtherAffected"], rows[1]["NumHomeless"]) == (None, None, None)


def test_split_valid(spark):
    df = spark.createDataFrame(
        [(1, 90.0, 0.0, 5.0, 1.0), (2, 90.01, 0.0, 5.0, 1.0), (3, None, 0.0, 5.0, 1.0),
         (4, 0.0, -180.0, 5.0, 1.0), (5, 0.0, 180.5, 5.0, 1.0), (6, 0.0, 0.0, None, 1.0)],
        "id int, Latitude double, Longitude double, Mag double, Depth double")
    good, bad = I.split_valid(df)
    assert sorted(r.id for r in good.collect()) == [1, 4]
    assert sorted(r.id for r in bad.collect()) == [2, 3, 5, 6]


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 0.0, 180.0),
                                (None, 0.0, 1.0, 1.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(C.haversine_km("a", "b", "c", "d")).collect()]
    assert got == [0.0, 111.195, 20015.087, None]


def test_haversine_parts_equal_plain(spark):
    df = spark.createDataFrame([(12.34567, -45.6, -3.2, 170.1), (-89.9, 179.9, 89.9, -179.9)],
                               "a double, b double, c double, d double")
    plain = df.select(C.haversine_km("a", "b", "c", "d").alias("x"))
    parts = df.select(C.haversine_parts_km(C.coord("a"), C.coord("b"), C.cos_lat(C.coord("a")),
                                           C.coord("c"), C.coord("d"), C.cos_lat(C.coord("c"))).alias("x"))
    assert [r.x for r in plain.collect()] == [r.x for r in parts.collect()]


def test_status_band(spark):
    got = _one(spark, [95.0, 94.9, 50.0, 49.9], "p double", C.status_band("p"))
    assert got == ["green", "amber", "amber", "red"]


def test_bucket_labels(spark):
    got = _one(spark, [0, 1, 2, 5, 6, 10, 11], "n int", bucket_label(F.col("n")))
    assert got == ["0", "1", "2-5", "2-5", "6-10", "6-10", ">10"]


def test_date_key_roundtrip(spark):
    df = spark.createDataFrame([(dt.date(2004, 12, 26),)], "d date")
    r = df.select(C.date_key("d").alias("k")).select("k", C.key_to_date("k").alias("d")).first()
    assert r.k == 20041226 and r.d == dt.date(2004, 12, 26)


def test_epoch_ms_iso_ignores_session_clock(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(1705300931340,)], "ms long")
        assert df.select(C.epoch_ms_iso("ms")).first()[0] == "2024-01-15T06:42:11.340000+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_ms_iso(spark):
    df = spark.createDataFrame([(1705300931340,), (1705276800000,), (None,)], "ms long")
    got = [r[0] for r in df.select(C.epoch_ms_iso("ms")).collect()]
    assert got == ["2024-01-15T06:42:11.340000+00:00", "2024-01-15T00:00:00+00:00", None]
