"""Bands, SCD2, dense keys and idempotent promotion."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from quakehouse.operators import dims as D
from quakehouse.operators import facts as FA
from quakehouse.operators import lookups as L
from quakehouse.operators.keys import assign_keys


def test_magnitude_band_gaps(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(
        ["1.98", "1.99", "2.00", "7.99", "8.00", "9.99", "10.00"])], "i int, m string")
    out = L.band_join(df, F.col("m").cast("decimal(4,2)"), D.magnitude_bands(spark),
                      "LowerBound", "UpperBound", "MagnitudeKey")
    got = {r.i: r.MagnitudeKey for r in out.collect()}
    assert [got.get(i) for i in range(7)] == [1, None, 2, None, 8, 8, None]


def test_depth_band(spark):
    vals = [-0.1, None, 0.0, 69.99, 70.0, 300.0, 700.0, 9999.0]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, d double")
    out = L.band_join(df, F.coalesce("d", F.lit(0.0)), D.depth_bands(spark),
                      "LowerBoundKM", "UpperBoundKM", "SeismicDepthKey")
    got = {r.i: r.SeismicDepthKey for r in out.collect()}
    assert [got.get(i) for i in range(8)] == [None, 1, 1, 1, 2, 3, 4, None]


def test_severity_bands_closed_with_default(spark):
    df = spark.createDataFrame(list(enumerate([None, 9, 10, 999, 1000, 2147483647])), "i int, v int")
    out = L.band_join(df, F.coalesce("v", F.lit(0)), D.deaths_bands(spark), "LowerBound",
                      "UpperBound", "SeverityDeathsKey", closed=True, how="left")
    got = {r.i: r.SeverityDeathsKey for r in out.collect()}
    assert [got[i] for i in range(6)] == [1, 1, 2, 3, 4, 4]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_band_lookup_expression_and_overlap_fallback(spark):
    df = spark.createDataFrame([(1, 7.0), (2, 12.0), (3, 20.0)], "i int, v double")
    plain = spark.createDataFrame([(1, 0, 10), (2, 10, 15)], "k int, lo int, hi int")
    out = L.band_join(df, F.col("v"), plain, "lo", "hi", "k")
    assert sorted((r.i, r.k) for r in out.collect()) == [(1, 1), (2, 2)]
    assert "NestedLoopJoin" not in out._jdf.queryExecution().executedPlan().toString()
    overlap = spark.createDataFrame([(1, 0, 10), (2, 5, 15)], "k int, lo int, hi int")
    out = L.band_join(df, F.col("v"), overlap, "lo", "hi", "k")
    assert sorted((r.i, r.k) for r in out.collect()) == [(1, 1), (1, 2), (2, 2)]


def test_assign_keys_matches_row_number(spark):
    random.seed(3)
    rows = [(random.randint(0, 50), random.choice([None, "a", "b", "c"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    got = assign_keys(df, ["a", "b", "c"], name="k", start=100, buckets=7)
    w = Window.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first(), "c")
    exp = df.withColumn("k", F.row_number().over(w) + 100)
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
    assert got.select("k").distinct().count() == 3000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_assign_keys_of_whole_rows_equals_the_join(spark):
    rows = [(i % 40, None if i % 9 == 0 else f"b{i % 7}", float(i)) for i in range(600)] + [(None, None, -1.0), (None, None, -2.0)]
    df = spark.createDataFrame(rows, "a int, b string, v double")
    whole = assign_keys(df, ["a", "b"], name="k", start=5, buckets=7, whole=True)
    joined = assign_keys(df, ["a", "b"], name="k", start=5, buckets=7)
    assert whole.columns == joined.columns
    assert sorted(map(str, whole.collect())) == sorted(map(str, joined.collect()))
    assert whole.agg(F.max("k"), F.min("k")).first()[:] == (607, 6)


def test_event_stage_numbers_its_rows_without_a_join_back(spark):
    from quakehouse.plans import fixtures as FX
    stage = FX.event_stage(spark, "/root/testdata/sf0.001")
    plan = stage._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan  # the offsets, one row per range
    assert stage.count() == FX.table(spark, "/root/testdata/sf0.001", "lineitem").count() == stage.agg(F.max("StgId")).first()[0]


def test_calendar(spark):
    cal = D.dim_date(spark)
    assert cal.count() == 14975
    r = cal.filter(F.col("DateKey") == 20041226).first()
    assert (r.MonthName, r.MonthNameShort, r.DayWeek, r.DayWeekName, r.Quarter) == \
        ("December", "Dec", 1, "Sunday", 4)
    assert cal.filter(F.col("DateKey") == 20210103).first().WeekYear == 53


def _master(spark, names):
    return spark.createDataFrame(
        [(k, iso, n, "R", "R", 0.1, "Low") for k, iso, n in names],
        "CountryDurableKey int, ISO3 string, CountryName string, SubRegion string, Region string, "
        "GEM_PGA_g double, GeoSeismicZone string")


def test_scd2_new_rename_unchanged_attribute_only(spark):
    m1 = _master(spark, [(1, "XIN", "Waters"), (2, "AAA", "Alpha"), (3, "BBB", "Beta")])
    d1 = D.scd2_apply(D.empty_geography(spark), m1, dt.date(2024, 1, 1))
    assert d1.count() == 3 and d1.filter("IsCurrent = 1").count() == 3
    # rename Beta, change an untracked attribute of Alpha, add Gamma
    m2 = _master(spark, [(1, "XIN", "Waters"), (2, "AAA", "Alpha"), (3, "BBB", "Beta Republic"),
                         (4, "CCC", "Gamma")]).withColumn(
        "GeoSeismicZone", F.when(F.col("ISO3") == "AAA", "High").otherwise(F.col("GeoSeismicZone")))
    d2 = D.scd2_apply(d1, m2, dt.date(2024, 6, 1)).cache()
    rows = {(r.CountryDurableKey, r.IsCurrent): r for r in d2.collect()}
    assert rows[(3, 0)].ValidTo == dt.date(2024, 5, 31) and rows[(3, 0)].CountryName == "Beta"
    assert rows[(3, 1)].CountryName == "Beta Republic" and rows[(3, 1)].ValidFrom == dt.date(2024, 6, 1)
    assert rows[(2, 1)].GeoSeismicZone == "Low"  # attribute-only change: no-op
    assert rows[(4, 1)].ValidFrom == dt.date(2024, 6, 1)
    assert sorted(r.GeographyKey for r in d2.collect()) == [1, 2, 3, 4, 5]
    # at most one current row per durable key; re-applying is a no-op
    assert d2.groupBy("CountryDurableKey").agg(F.sum("IsCurrent").alias("c")).filter("c > 1").count() == 0
    d3 = D.scd2_apply(d2, m2, dt.date(2024, 6, 1))
    assert d3.exceptAll(d2).count() == 0 and d2.exceptAll(d3).count() == 0


def test_expected_figures_sf0001(spark):
    """The survey's independently computed figures (FIXTURES B5, sf0.001)."""
    from quakehouse.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    assert w.event_stage.count() == 6000
    s = w.seismic
    assert (s.marks.count(), s.fact.count(), s.dropped.count()) == (5939, 5701, 238)
    assert s.fact.filter(F.col("GeographyKey") == 1).count() == 923
    mags = {r.MagnitudeKey: r["count"] for r in s.fact.groupBy("MagnitudeKey").count().collect()}
    assert [mags[k] for k in range(1, 9)] == [1080, 581, 563, 560, 559, 594, 586, 1178]
    depths = {r.SeismicDepthKey: r["count"] for r in s.fact.groupBy("SeismicDepthKey").count().collect()}
    assert [depths[k] for k in range(1, 5)] == [591, 1558, 2888, 664]
    d = w.disaster
    f = d.fact
    assert (d.marks.count(), f.count()) == (1485, 1471)
    agg = f.agg(F.count_if(F.col("EndDate").isNull()).alias("null_end"),
                F.count_if(F.col("EndDate") < F.col("StartDate")).alias("end_before"),
                F.sum("DurationDays").alias("dur"), F.count_if(F.col("NumOtherAffected") < 0).alias("neg"),
                F.sum("TotalDamageAdj").alias("dmg")).first()
    assert (agg.null_end, agg.end_before, agg.dur, agg.neg, agg.dmg) == (1, 57, 36807, 603, 18393593000)


def test_second_rename_same_day_is_flagged(spark):
    from quakehouse.operators.quality import scd2_checks
    day = dt.date(2024, 6, 1)
    d1 = D.scd2_apply(D.empty_geography(spark), _master(spark, [(2, "AAA", "Alpha")]), day)
    d2 = D.scd2_apply(d1, _master(spark, [(2, "AAA", "Alpha Two")]), day)
    d3 = D.scd2_apply(d2, _master(spark, [(2, "AAA", "Alpha Three")]), day)
    cur = d3.filter("IsCurrent = 1").collect()
    assert len(cur) == 1 and cur[0].CountryName == "Alpha Three"
    checks = {r.check_name: r.value for r in scd2_checks(d3).collect()}
    # Q-16 kept: the version opened and closed on the same day has ValidTo < ValidFrom
    assert checks == {"scd2_multiple_current": 0.0, "scd2_valid_to_before_from": 2.0}


def test_promotion_twice_is_once(spark):
    stage = spark.createDataFrame(
        [(1, "2024-01-15T00:00:00", "AAA", "4.50", 10.0), (2, "None", "AAA", "5.00", 10.0),
         (3, "2024-01-16T00:00:00", "ZZZ", "1.99", 10.0), (4, "2024-01-17T00:00:00", "AAA", "6.1", -3.0)],
        "StgId long, SrcTime string, ISO3 string, Mag string, Depth double")
    stage = stage.select("*", F.lit(1.0).alias("Latitude"), F.lit(2.0).alias("Longitude"),
                         F.lit(None).cast("double").alias("Mmi"), F.lit(1).alias("Sig"),
                         F.lit(None).cast("double").alias("Cdi"))
    geo = D.scd2_apply(D.empty_geography(spark),
                       _master(spark, [(1, "XIN", "Waters"), (2, "AAA", "Alpha")]), dt.date(2024, 1, 1))
    p1 = FA.fact_seismic(stage, geo, D.magnitude_bands(spark), D.depth_bands(spark))
    assert sorted(r.StgId for r in p1.marks.collect()) == [1, 3, 4]       # 'None' date never marked
    assert [r.StgId for r in p1.fact.collect()] == [1]                    # 1.99 gap, negative depth
    assert sorted(r.StgId for r in p1.dropped.collect()) == [3, 4]
    p2 = FA.fact_seismic(stage, geo, D.magnitude_bands(spark), D.depth_bands(spark), tracker=p1.marks)
    assert p2.marks.count() == 0 and p2.fact.count() == 0


def test_band_join_of_many_overlapping_bands_is_an_equi_join(spark):
    import random
    rnd = random.Random(6)
    bands = [(i, float(a), float(a + rnd.choice([0, 0.5, 1, 3, 50, 4000]))) for i, a in enumerate(rnd.uniform(-1000, 1000) for _ in range(700))]
    bands += [(900, float("-inf"), -999.0), (901, 998.0, float("inf")), (902, None, 3.0), (903, 5.0, 4.0), (904, 7.0, 7.0), (905, 0.0, 2147483647.0), (906, 1e18, 1e18 + 4096)]
    values = [(i, v) for i, v in enumerate([rnd.uniform(-1100, 1100) for _ in range(300)] + [7.0, 0.0, -0.0, None, 1e18, 1e18 + 2048, 1e300, -1e300, 5e9, bands[3][1], bands[3][2]])]
    b = spark.createDataFrame(bands, "key int, lo double, hi double")
    v = spark.createDataFrame(values, "id int, v double")
    for closed in (False, True):
        inside = lambda x, lo, hi: lo is not None and x is not None and lo <= x and (x <= hi if closed else x < hi)
        want = {i: sorted(k for k, lo, hi in bands if inside(x, lo, hi)) for i, x in values}
        got = {}
        for r in L.band_join(v, F.col("v"), b, "lo", "hi", "key", closed=closed, form="binned").collect():
            got.setdefault(r.id, []).append(r.key)
        assert {i: sorted(k) for i, k in got.items()} == {i: k for i, k in want.items() if k}
        left = {}
        for r in L.band_join(v, F.col("v"), b, "lo", "hi", "key", closed=closed, how="left", form="binned").collect():
            left.setdefault(r.id, []).append(r.key)
        assert {i: sorted(k) for i, k in left.items() if k != [None]} == {i: k for i, k in want.items() if k}
        assert set(left) == set(want)
    import pytest
    with pytest.raises(ValueError):
        L.band_join(v, F.col("v"), b, "lo", "hi", "key", form="case")


def test_band_join_of_a_hundred_thousand_bands(spark):
    bands = spark.range(100_000).select(F.col("id").alias("key"), F.col("id").cast("double").alias("lo"), (F.col("id") + 1).cast("double").alias("hi"))
    values = spark.range(200_000).select("id", (F.col("id") / 2).alias("v"))
    out = L.band_join(values, F.col("v"), bands, "lo", "hi", "key")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert out.filter(F.col("key") == F.floor("v")).count() == out.count() == 200_000


def test_codes_staged_in_lower_case_enter_the_dimension(spark):
    codes = D.staged_codes(spark.createDataFrame([("n01 ",), ("N02",), (None,)], "c string"), spark.createDataFrame([("N01",)], "c string"))
    assert sorted(r.ISO3 for r in codes.collect()) == ["N01", "N02"]
    master = spark.createDataFrame([(1, "XIN", "Waters", "O", "O", None, "L"), (2, "N01", "One", "A", "A", 0.1, "L"), (3, "N03", "Three", "A", "A", 0.1, "L")],
                                   "CountryDurableKey int, ISO3 string, CountryName string, SubRegion string, Region string, GEM_PGA_g double, GeoSeismicZone string")
    dim = D.scd2_apply(D.empty_geography(spark), D.incoming_countries(codes, master), dt.date(2024, 1, 1))
    assert {(r.GeographyKey, r.ISO) for r in dim.collect()} == {(1, "XIN"), (2, "N01")}
    got = L.lookup_current(spark.createDataFrame([("n01 ",)], "c string"), dim, on="c").first()
    assert got.GeographyKey == 2
    # a dimension is numbered without a window over all of its rows
    assert "Window" not in dim._jdf.queryExecution().executedPlan().toString()


def test_disaster_years_are_arguments(spark):
    from quakehouse.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    few = FA.fact_disaster(w.disaster_stage, w.dim_geo, w.deaths_bands, w.affected_bands, w.dim_date, min_year=1995, max_year=1996)
    assert few.marks.count() == w.disaster_stage.filter("StartYear BETWEEN 1995 AND 1996").count() > 0
