"""Spatio-temporal bridge edge rows and the exact nearest-place join."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from quakehouse.functions.columns import haversine_km, round_km
from quakehouse.operators import bridge as B
from quakehouse.operators import geo as G
from quakehouse.session import materialize
from tests.conftest import SF_SMALL


def _facts(spark, disasters, events):
    d = spark.createDataFrame(disasters, "DisasterKey long, StartDate int, GeographyKey long, "
                                         "Latitude double, Longitude double")
    s = spark.createDataFrame(events, "SeismicKey long, DateKey int, GeographyKey long, "
                                      "Latitude double, Longitude double")
    return d, s


def test_bridge_window_edges(spark):
    d, s = _facts(spark, [(1, 20040110, 7, 10.0, 10.0)],
                  [(1, 20040110, 7, 10.0, 10.0), (2, 20040107, 7, 10.0, 10.0),
                   (3, 20040106, 7, 10.0, 10.0), (4, 20040111, 7, 10.0, 10.0),
                   (5, 20040110, 8, 10.0, 10.0)])
    got = {r.SeismicKey: r.TimeLagDays for r in B.build_bridge(d, s).collect()}
    assert got == {1: 0, 2: 3}


def _hv(a, b, c, d):
    k = math.pi / 180
    x = math.sin((c - a) * k / 2) ** 2 + math.cos(a * k) * math.cos(c * k) * math.sin((d - b) * k / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(x), math.sqrt(1 - x))


def test_bridge_radius_boundary(spark):
    # the radius is tested on the distance rounded to 3 decimals (HALF_UP):
    # raw 100.0004.. -> 100.000 links; raw 100.0005.. -> 100.001 does not
    inside = outside = None
    for i in range(85000, 95000):
        for j in range(0, 200):
            lat, lon = j / 100000, i / 100000
            dd = _hv(0.0, 0.0, lat, lon)
            if inside is None and 100.00001 < dd < 100.00049:
                inside = (lat, lon)
            if outside is None and 100.00051 < dd < 100.00099:
                outside = (lat, lon)
        if inside and outside:
            break
    d, s = _facts(spark, [(1, 20040110, 7, 0.0, 0.0)],
                  [(1, 20040110, 7, inside[0], inside[1]), (2, 20040110, 7, outside[0], outside[1])])
    got = {r.SeismicKey: r.DistanceKM for r in B.build_bridge(d, s).collect()}
    assert got == {1: 100.0}


def test_bridge_missing_coordinates(spark):
    d, s = _facts(spark, [(1, 20040110, 7, None, None), (2, 20040110, 7, 10.0, None)],
                  [(1, 20040110, 7, 50.0, 50.0), (2, 20040109, 7, -50.0, -50.0)])
    rows = B.build_bridge(d, s).collect()
    assert sorted((r.DisasterKey, r.SeismicKey) for r in rows) == [(1, 1), (1, 2)]
    assert all(r.DistanceKM is None for r in rows)


def test_bridge_skips_linked_and_plan_has_no_cartesian(spark):
    d, s = _facts(spark, [(1, 20040110, 7, 10.0, 10.0), (2, 20040110, 7, 10.0, 10.0)],
                  [(1, 20040110, 7, 10.0, 10.0)])
    existing = spark.createDataFrame([(1, 1)], "DisasterKey long, SeismicKey long")
    out = B.build_bridge(d, s, existing=existing)
    assert [r.DisasterKey for r in out.collect()] == [2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    assert "NestedLoopJoin" not in plan


def test_bridge_prunes_event_years(spark, tmpdir_path):
    import os
    d, s = _facts(spark, [(1, 20040110, 7, 10.0, 10.0)],
                  [(1, 20040110, 7, 10.0, 10.0), (2, 19990110, 7, 10.0, 10.0),
                   (3, 20040109, 7, 10.0, 10.0)])
    path = os.path.join(tmpdir_path, "fact_seismic")
    B.with_event_year(s).write.partitionBy(B.YEAR_COLUMN).parquet(path)
    out = B.build_bridge(d, spark.read.parquet(path))
    assert sorted(r.SeismicKey for r in out.collect()) == [1, 3]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_bridge_invariants_on_the_warehouse(spark):
    from pyspark.sql import functions as F

    from quakehouse.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    b = w.bridge_plan
    bad = b.filter(~(F.col("DistanceKM").isNull() | (F.col("DistanceKM") <= B.RADIUS_KM))
                   | ~F.col("TimeLagDays").between(0, B.WINDOW_DAYS))
    assert bad.count() == 0
    assert b.count() == b.select("DisasterKey", "SeismicKey").distinct().count()
    r = b.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("DistanceKM").isNull()).alias("nulls"),
              F.round(F.sum("DistanceKM"), 2).alias("dist"), F.sum("TimeLagDays").alias("lag"),
              F.sum(F.col("SeismicKey") * 31 + F.col("DisasterKey")).alias("chk"),
              F.countDistinct("DisasterKey").alias("linked")).first()
    # FIXTURES B5 (computed independently in two engines)
    assert (r.n, r.nulls, float(r.dist), r.lag, r.chk, r.linked) == (282, 19, 15260.59, 448, 26345150, 220)


def test_bridge_hot_key_split_is_exact(spark):
    from quakehouse.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    plain = B.build_bridge(w.fact_disaster, w.fact_seismic)
    salted = B.build_bridge(w.fact_disaster, w.fact_seismic, hot_key_rows=1, salts=4, pairs_per_row=0)
    assert salted.count() == plain.count() == 282
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def _hv_links(disasters, events, radius=100.0, window=3):
    import datetime
    day = lambda k: datetime.date(k // 10000, k // 100 % 100, k % 100)
    out = set()
    for d, dk, dg, dla, dlo in disasters:
        for e, ek, eg, ela, elo in events:
            if dg == eg and 0 <= (day(dk) - day(ek)).days <= window:
                if dla is None or (ela is not None and dlo is not None and elo is not None
                                   and round(_hv(dla, dlo, ela, elo), 3) <= radius):
                    out.add((d, e))
    return out


def test_bridge_cells_match_brute_force_at_poles_date_line_and_beyond(spark):
    rnd = random.Random(3)
    spots = [(89.99, 0.0), (-89.99, 77.0), (0.0, 179.99), (0.0, -179.99), (45.0, 45.0), (95.0, 10.0), (85.0, -170.0), (0.0, 0.0)]
    near = lambda: (lambda s: (s[0] + rnd.uniform(-1, 1), s[1] + rnd.uniform(-1.5, 1.5)))(rnd.choice(spots))
    events = [(i, 20040100 + rnd.randrange(1, 9), 7, *near()) for i in range(900)] + [(2000, 20040105, 7, None, None)]
    disasters = [(i, 20040100 + rnd.randrange(1, 12), 7, *near()) for i in range(120)]
    disasters += [(500, 20040106, 7, None, None), (501, 20040106, 7, 45.0, None), (502, 20040106, 8, 45.0, 45.0)]
    events = [tuple(round(x, 5) if isinstance(x, float) else x for x in e) for e in events]
    disasters = [tuple(round(x, 5) if isinstance(x, float) else x for x in d) for d in disasters]
    d, s = _facts(spark, disasters, events)
    # every key divided into cells, the busier half of them, none
    for radius, per_row in ((100.0, 0), (5.0, 0), (30_000.0, 0), (100.0, 10), (100.0, 10**6)):
        got = [(r.DisasterKey, r.SeismicKey) for r in B.build_bridge(d, s, radius_km=radius, pairs_per_row=per_row).collect()]
        assert len(got) == len(set(got)) and set(got) == _hv_links(disasters, events, radius)


def test_bridge_candidates_stay_near_the_links_on_spread_points(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(8)
    def spread():
        return math.degrees(math.asin(rnd.uniform(-1, 1))), rnd.uniform(-180, 180)
    events = [(i, 20040110, 7, *spread()) for i in range(60_000)]
    disasters = [(i, 20040110, 7, *spread()) for i in range(600)]
    d, s = _facts(spark, disasters, events)
    links = B.build_bridge(d, s, radius_km=300).count()
    cell = ["__cx", "__cy", "__cz"]
    pairs = B.candidate_pairs(B.with_cells_within(d, 300, F.lit(True), "Latitude", "Longitude").select(cell),
                              B.with_cell(s, 300, F.lit(True), "Latitude", "Longitude").select(cell), cell).agg(F.sum("__pairs")).first()[0]
    assert links > 10_000 and pairs < 6 * links  # all pairs of the day: 36,000,000
    salted = B.build_bridge(d, s, radius_km=300, hot_key_rows=200)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert salted.count() == links and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def _brute(points, places):
    def hv(a, b, c, d):
        k = math.pi / 180
        x = math.sin((c - a) * k / 2) ** 2 + math.cos(a * k) * math.cos(c * k) * math.sin((d - b) * k / 2) ** 2
        return 2 * 6371.0 * math.atan2(math.sqrt(min(x, 1)), math.sqrt(1 - min(x, 1)))
    out = {}
    for pid, la, lo in points:
        best = min((hv(la, lo, pla, plo), qid) for qid, pla, plo in places)
        out[pid] = best[1]
    return out


def test_nearest_place_matches_brute_force(spark):
    random.seed(11)
    places = [(i, random.uniform(-90, 90), random.uniform(-180, 180)) for i in range(60)]
    places += [(100, 89.9, 0.0), (101, -89.95, 120.0), (102, 0.0, 179.99), (103, 0.0, -179.99)]
    points = [(i, random.uniform(-90, 90), random.uniform(-180, 180)) for i in range(400)]
    points += [(1000, 90.0, 45.0), (1001, -90.0, 0.0), (1002, 0.5, 180.0), (1003, -0.5, -180.0)]
    pdf = spark.createDataFrame(points, "id int, lat double, lon double")
    ldf = spark.createDataFrame(places, "place_id int, lat double, lon double")
    got = {r.id: r.place_id for r in G.nearest_place(pdf, ldf).collect()}
    assert got == _brute(points, places)


def test_nearest_place_beside_dense_clusters(spark):
    rnd = random.Random(12)
    # two cities of places, one of them in ever smaller quarters, copies at one spot, and a few lone ones
    places = [(i, 10 + rnd.gauss(0, 0.01), 20 + rnd.gauss(0, 0.01)) for i in range(400)]
    places += [(1000 + i, -45 + 10 ** -(i % 7) * rnd.random(), 179.9999 + 10 ** -(i % 7) * rnd.random()) for i in range(300)]
    places += [(5000 - i, 60.0, -60.0) for i in range(50)] + [(6000, 89.0, 0.0), (6001, None, 1.0), (6002, float("nan"), 0.0)]
    points = [(i, 10 + rnd.gauss(0, 0.02), 20 + rnd.gauss(0, 0.02)) for i in range(200)]
    points += [(300 + i, -45 + 10 ** -(i % 8) * rnd.random(), 179.9999 + 10 ** -(i % 8) * rnd.random()) for i in range(200)]
    points += [(600 + i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(200)]  # far from both
    points += [(900, 60.0, -60.0), (901, None, 5.0), (902, float("nan"), 5.0)]
    pdf = spark.createDataFrame(points, "id int, lat double, lon double")
    ldf = spark.createDataFrame(places, "place_id int, lat double, lon double")
    want = _brute([p for p in points if p[0] < 901], [p for p in places if p[0] < 6001])
    for few in (16,):
        out = G.nearest_place(pdf, ldf, few=few)
        assert {r.id: r.place_id for r in out.collect()} == want
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert G.nearest_place(pdf, ldf.limit(0)).count() == 0 and G.nearest_place(pdf.limit(0), ldf).count() == 0


def test_nearest_place_sends_a_point_once_however_many_levels(spark):
    rng = random.Random(5)
    places = [(i, rng.uniform(-85, 85), rng.uniform(-180, 180)) for i in range(300)] + \
             [(1000 + i, 40 + rng.uniform(-2, 2), 20 + rng.uniform(-2, 2)) for i in range(300)]
    points = [(i, rng.uniform(-89, 89), rng.uniform(-180, 180)) for i in range(200)] + \
             [(1000 + i, 40 + rng.uniform(-2, 2), 20 + rng.uniform(-2, 2)) for i in range(200)]
    pdf, ldf = spark.createDataFrame(points, "id int, lat double, lon double"), spark.createDataFrame(places, "place_id int, lat double, lon double")
    pts = materialize(G._located(pdf, "id", "__qid", "lat", "lon"), "pts")
    spots = materialize(G._located(ldf, "place_id", "__pid", "lat", "lon"), "spots")
    found, levels, summary = G._finished_cubes(pts, spots, None, G.FEW_PLACES)
    assert len(levels) > 2 and max(levels) <= G.SUMMARY_LEVEL
    finished = found.select("level", "qx", "qy", "qz").distinct()
    sent = G._in_finished(pts, summary, finished, levels)
    assert sent.count() == sent.join(finished, ["level", "qx", "qy", "qz"], "left_semi").count() == len(points)
    got = {r.id: r.place_id for r in G.nearest_place(pdf, ldf).collect()}
    assert got == _brute(points, places)


def test_nearest_place_max_km(spark):
    places = spark.createDataFrame([(1, 0.0, 0.0), (2, 40.0, 40.0)], "place_id int, lat double, lon double")
    pts = spark.createDataFrame([(10, 0.5, 0.5), (11, -60.0, -150.0)], "id int, lat double, lon double")
    got = {r.id: r.place_id for r in G.nearest_place(pts, places).collect()}
    assert got == {10: 1, 11: 1}
    near = {r.id: r.place_id for r in G.nearest_place(pts, places, max_km=500).collect()}
    assert near == {10: 1}  # the far point keeps no place (sentinel country downstream)


def test_to_iso3(spark):
    codes = spark.createDataFrame([("JP", "JPN"), (None, "XIN")], "ISO2 string, ISO3 string")
    df = spark.createDataFrame([(1, "JP"), (2, ""), (3, "ZZ"), (4, None)], "i int, cc string")
    got = {r.i: r.ISO3 for r in G.to_iso3(df, codes).collect()}
    assert got == {1: "JPN", 2: "XIN", 3: "XIN", 4: "XIN"}


def test_cubes_around_a_stored_point_repeat_no_sine(spark):
    """The test of the cubes reads the stored unit vector instead of working it out for each bound."""
    pts = materialize(B.with_unit_vector(spark.range(300).select(
        "id", (F.col("id") * 7.3 % 180 - 90).alias("__dlat"), (F.col("id") * 31.7 % 360 - 180).alias("__dlon"))), "pts")
    out = B.with_cells_within(pts, 100, F.col("id") % 3 != 0)
    text = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "cos(" not in text and "sin(" not in text
    got = {}
    for r in out.collect():
        got.setdefault(r["id"], set()).add((r["__cx"], r["__cy"], r["__cz"]))
    reach = B._radius_chord(100) + 1e-9
    side = B.CELL_PER_RADIUS * B._radius_chord(100)
    for r in pts.collect():
        if r["id"] % 3 == 0:
            assert got[r["id"]] == {(0, 0, 0)}
            continue
        u, want = (r["__ux"], r["__uy"], r["__uz"]), set()
        base = [math.floor(v / side) for v in u]
        for step in [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)]:
            cell = tuple(b + s for b, s in zip(base, step))
            lo, hi = [c * side for c in cell], [(c + 1) * side for c in cell]
            gap = sum(max(l - v, v - h, 0.0) ** 2 for v, l, h in zip(u, lo, hi))
            low = sum(0.0 if l <= 0 <= h else min(abs(l), abs(h)) ** 2 for l, h in zip(lo, hi))
            high = sum(max(abs(l), abs(h)) ** 2 for l, h in zip(lo, hi))
            if gap <= reach * reach and low <= 1 + 1e-9 and high >= 1 - 1e-9:
                want.add(cell)
        assert got[r["id"]] == want


def test_within_radius_is_the_rounded_distance(spark):
    """Pairs around the radius, at the poles and the antipodes, and without a number."""
    from quakehouse.functions.columns import cos_lat, haversine_parts_km
    i = F.col("id")
    pairs = spark.range(4000).select(
        F.when(i == 7, F.lit(float("nan"))).otherwise(F.round(i * 0.37 % 180 - 90, 5)).alias("a"), F.round(i * 1.91 % 360 - 180, 5).alias("b"),
        F.round(i * 0.37 % 180 - 90 + (i % 200) / 100 - 1, 5).alias("c"), F.round(i * 1.91 % 360 - 180 + (i % 17) / 10, 5).alias("d"))
    pairs = pairs.withColumns({"ca": cos_lat("a"), "cc": cos_lat("c")})
    for km in (0.0, 0.0005, 5, 100, 111.195, 9000, 20015.0):
        names = ("a", "b", "ca", "c", "d", "cc")
        exact = haversine_parts_km(*names) <= F.lit(float(km))
        wrong = pairs.filter(~B.within_radius(km, *names).eqNullSafe(exact)).count()
        assert wrong == 0, km


def test_keys_within_a_few_cells_are_left_whole(spark, monkeypatch):
    """400 events and 300 disasters of one degree make many pairs, but cells would only add copies; spread over the earth they are divided."""
    divided = []
    cells = B.with_cells_within
    monkeypatch.setattr(B, "with_cells_within", lambda *a, **k: divided.append(1) or cells(*a, **k))

    def links(degrees):
        d = spark.range(300).select(F.col("id").alias("DisasterKey"), F.lit(1).alias("GeographyKey"), F.lit(20200110).alias("StartDate"),
                                    (F.rand(1) * degrees).alias("Latitude"), (F.rand(2) * degrees * 2).alias("Longitude"))
        s = spark.range(400).select(F.col("id").alias("SeismicKey"), F.lit(1).alias("GeographyKey"), F.lit(20200109).alias("DateKey"),
                                    (F.rand(3) * degrees).alias("Latitude"), (F.rand(4) * degrees * 2).alias("Longitude"))
        d, s = materialize(d, "d"), materialize(s, "s")
        near = d.crossJoin(s.withColumnsRenamed({"Latitude": "sla", "Longitude": "slo"})).withColumn("km", haversine_km(
            F.round("Latitude", 5), F.round("Longitude", 5), F.round("sla", 5), F.round("slo", 5))).filter("km <= 100")
        want = {(r.DisasterKey, r.SeismicKey, r.km) for r in near.collect()}
        got = {(r.DisasterKey, r.SeismicKey, r.DistanceKM) for r in B.build_bridge(d, s, distance="double").collect()}
        assert got == want and got
        return len(divided)

    assert links(1) == 0
    assert links(80) == 1


def test_links_of_the_warehouse_are_a_view(spark):
    """The checks read the links without storing them: they grow with the square of the rows."""
    from quakehouse.plans import warehouse
    before = {k for k in warehouse._STORED if k[-1] == "bridge"}
    w = warehouse.Warehouse(spark, SF_SMALL, as_of=dt.date(2023, 5, 1))
    assert w.bridge.count() == w.bridge_plan.count()
    assert {k for k in warehouse._STORED if k[-1] == "bridge"} == before
    plan = B.without_links(w.fact_disaster, w.bridge)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [DisasterKey" in plan


def test_round_km_is_round(spark):
    odd = [0.0, 0.0005, 0.0015, 1.0005, 99.9995, 100.0005, 100.00049999, 19999.9995, 0.4999999995, float("nan"), 12.3456789, 0.00049999999]
    df = materialize(spark.createDataFrame([(x,) for x in odd], "km double").unionByName(
        spark.range(20000).select((F.rand(5) * 20015).alias("km"))).unionByName(
        spark.range(20000).select((F.floor(F.rand(6) * 200000) / 2000).alias("km"))), "km")
    assert df.filter(~round_km("km").eqNullSafe(F.round("km", 3))).count() == 0
