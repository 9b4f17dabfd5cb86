"""Readers, run log / resume, quality metrics and the streaming landing ingest."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from quakehouse.operators import ingest as I
from quakehouse.operators import quality as Q
from quakehouse.sources.readers import read_disaster_csv, read_event_geojson


def test_geojson_collection_with_short_coordinates(spark, tmpdir_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": "a1", "properties": {"time": 1705300931340, "mag": 5.1, "type": "earthquake"},
         "geometry": {"type": "Point", "coordinates": [140.1, 35.2, 10.0]}},
        {"type": "Feature", "id": "a2", "properties": {"time": None, "mag": 4.7},
         "geometry": {"type": "Point", "coordinates": [141.0]}}]}
    with open(os.path.join(tmpdir_path, "2024.json"), "w") as fh:
        json.dump(doc, fh, indent=1)
    rows = {r.id: r for r in read_event_geojson(spark, tmpdir_path).collect()}
    assert rows["a1"].latitude == 35.2 and rows["a1"].depth == 10.0 and rows["a1"].time == 1705300931340
    assert rows["a2"].longitude == 141.0 and rows["a2"].latitude is None and rows["a2"].depth is None


def test_disaster_csv_bom_renames_missing(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "x.csv")
    with open(p, "w", encoding="utf-8-sig") as fh:
        fh.write(' DisNo. ,Disaster Type,"Total Damage, Adjusted (\'000 US$)",Extra\n')
        fh.write('2004-0001-IDN,Earthquake,NA,"a, b"\n')
    df = read_disaster_csv(spark, p)
    r = df.first()
    assert r.DisNo == "2004-0001-IDN" and r.TotalDamagesAdj is None and r.Extra == "a, b"
    assert "StartYear" in df.columns and r.StartYear is None


def test_country_master_and_observed_write(spark, tmpdir_path):
    from quakehouse.sources.readers import read_country_master
    from quakehouse.sources.sinks import observed_write
    p = os.path.join(tmpdir_path, "master.csv")
    with open(p, "w") as fh:
        fh.write("CountryDurableKey,ISO3,ISO2,CountryName,SubRegion,Region,GEM_PGA_g,GeoSeismicZone\n")
        fh.write("1,XIN,,International Waters,Ocean,Ocean,,Very Low\n")
        fh.write("2,JPN,JP,Japan,Eastern Asia,Asia,0.45,Very High\n")
    m = read_country_master(spark, p)
    rows = {r.ISO3: r for r in m.collect()}
    assert rows["JPN"].GEM_PGA_g == 0.45 and rows["XIN"].ISO2 is None
    counters = observed_write(m, os.path.join(tmpdir_path, "out"),
                              with_code=F.count_if(F.col("ISO2").isNotNull()))
    assert counters == {"rows": 2, "with_code": 1}
    assert spark.read.parquet(os.path.join(tmpdir_path, "out")).count() == 2


def test_dedup_with_a_hot_key(spark):
    from quakehouse.operators.facts import keep_first
    from quakehouse.operators.staging import first_per_key
    rows = [(i, "hot" if i % 3 == 0 else f"id{i}", i * 1.5) for i in range(300)]
    rows += [(1000, None, 0.0), (1001, None, 1.0)]
    inc = spark.createDataFrame(rows, "StgId long, EventId string, v double")
    inc = inc.withColumn("at", F.col("StgId"))
    staged = spark.createDataFrame([("id1",), ("id2",)], "EventId string")
    out = I.not_yet_staged(inc, staged, "EventId", order="StgId").collect()
    ids = {r.EventId: r.StgId for r in out if r.EventId is not None}
    assert ids["hot"] == 0 and "id1" not in ids and "id2" not in ids
    assert len(out) == 200 - 2 + 1 + 1  # 200 distinct ids + 1 hot, 2 staged removed, 1 NULL group
    firsts = {r.EventId: r.StgId for r in first_per_key(inc, "EventId", "at").collect()}
    assert firsts["hot"] == 0 and len(firsts) == 202 - 0  # NULL-key rows are all kept
    kf = keep_first(inc, ["EventId"]).collect()
    assert sorted(r.StgId for r in kf if r.EventId in ("hot", None)) == [0, 1000]


def test_load_runs_are_idempotent(spark):
    from quakehouse.plans import fixtures as FX
    from quakehouse.plans import warehouse as WH
    from quakehouse.plans.catalog_io import _disasters_path, _events_path
    from quakehouse.plans.load import TABLES, run_load
    from quakehouse.session import scratch_path
    sf = "/root/testdata/sf0.001"
    w = WH.Warehouse(spark, sf)
    root = scratch_path(spark, "load_test")

    def load(batch):
        tables = run_load(spark, _events_path(w), _disasters_path(w), FX.places(spark, sf), w.master,
                          root, batch_id=batch, as_of=WH.AS_OF)
        return {n: tables.read(n).count() for n in TABLES if n != "volume_alarms"}

    first = load(1)
    assert first["fact_seismic"] > 0 and first["bridge"] > 0
    assert load(1) == first          # re-run of the same run: same partitions, same rows
    assert load(2) == first          # a new run over the same files adds nothing
    log = spark.read.parquet(f"{root}/run_log")
    assert log.filter("Status = 'SUCCESS'").count() == 6
    ok = log.filter("Status = 'SUCCESS' and SourceSystem = 'events'").orderBy("EventTime").first()
    assert ok.RowsExtracted == 6000 and ok.RowsLoaded == first["event_stage"]  # Q-34 counter filled


def test_disaster_csv_without_business_id_is_rejected(spark, tmpdir_path):
    import pytest
    p = os.path.join(tmpdir_path, "noid.csv")
    with open(p, "w") as fh:
        fh.write("Disaster Type,Start Year\nEarthquake,2004\n")
    with pytest.raises(ValueError, match="DisNo"):
        read_disaster_csv(spark, p)


def test_rejects_raw_record_and_no_rerecording(spark):
    bad = spark.createDataFrame([("x" * 30, 95.0, "y" * 5000), ("short", None, "z")],
                                "EventId string, Latitude double, Place string")
    whole = {r.EventId: len(r.RawRecord) for r in I.reject_rows(bad, 7).collect()}
    assert whole["x" * 30] > 5000  # uncut unless a width is given
    rej = I.reject_rows(bad, 7, id_width=20, raw_width=4000)
    rows = {r.EventId: r for r in rej.collect()}
    assert set(rows) == {"x" * 20, "short"}
    r = rows["x" * 20]
    assert r.LoadBatchId == 7 and r.RejectReason == I.REJECT_REASON and len(r.RawRecord) == 4000
    assert json.loads(rows["short"].RawRecord) == {"EventId": "short", "Place": "z"}
    already = spark.createDataFrame([("short", I.REJECT_REASON)], "EventId string, RejectReason string")
    assert [x.EventId for x in I.new_rejects(rej, already).collect()] == ["x" * 20]


def test_rejects_without_id_are_recorded_once(spark):
    bad = spark.createDataFrame([(None, 95.0), (None, 96.0)], "EventId string, Latitude double")
    rej = I.reject_rows(bad, 7)
    assert I.new_rejects(rej, rej).count() == 0
    assert I.new_rejects(rej, rej.filter(F.col("RawRecord").contains("95"))).count() == 1


def test_event_ingest_loses_no_row(spark, tmpdir_path):
    from quakehouse.operators import staging as ST
    from quakehouse.plans import fixtures as FX
    from quakehouse.plans import warehouse as WH
    from quakehouse.sources.readers import read_event_geojson
    sf = "/root/testdata/sf0.001"

    def feature(id_, time, lat=10.0, lon=20.0):
        return {"type": "Feature", "id": id_, "properties": {"mag": 5.0, "time": time, "type": "earthquake"},
                "geometry": {"type": "Point", "coordinates": [lon, lat, 10.0]}}
    feats = [feature("p" * 20 + "a", 1000), feature("p" * 20 + "b", 2000),     # common prefix
             feature(None, 3000), feature(None, 4000), feature("", 5000),     # no id
             feature("copy", 6000), feature("copy", None),                    # the first copy stays
             feature("zero", 7000, 0.0, 0.0), feature("minus", 8000, -0.0, -0.0)]
    path = os.path.join(tmpdir_path, "odd_events.json")
    with open(path, "w") as fh:
        fh.writelines(json.dumps(f) + "\n" for f in feats)
    flat = read_event_geojson(spark, path, lines=True)
    got = ST.ingest_events(flat, 1, FX.places(spark, sf), WH.Warehouse(spark, sf).master)
    rows = got.staged.collect()
    assert len(rows) == 8 and sorted(r.StgId for r in rows) == list(range(1, 9)) and got.rejects.count() == 0
    ids = [r.EventId for r in rows]
    assert ids.count(None) == 3 and {"p" * 20 + "a", "p" * 20 + "b"} < set(ids)
    by_id = {r.EventId: r for r in rows}
    assert by_id["copy"].SrcTime is not None
    assert by_id["zero"].ISO3 == by_id["minus"].ISO3


def test_resume_year(spark):
    cases = [(None, dt.date(2024, 5, 1), 2000), (dt.date(2023, 12, 31), dt.date(2024, 5, 1), 2024),
             (dt.date(2024, 5, 1), dt.date(2024, 5, 1), 2024)]
    for last, today, want in cases:
        log = spark.createDataFrame([(1, "events", "SUCCESS", last)],
                                    "RunId int, SourceSystem string, Status string, ExtractTo date")
        y = spark.range(1).select(I.resume_year(I.last_success(log, "events"), today)).first()[0]
        assert y == want


def test_run_log_latest(spark):
    ev = spark.createDataFrame(
        [(1, "events", dt.datetime(2024, 1, 1, 3), "RUNNING"), (1, "events", dt.datetime(2024, 1, 1, 4), "FAILED"),
         (2, "events", dt.datetime(2024, 1, 2, 3), "RUNNING")],
        "RunId int, SourceSystem string, EventTime timestamp, Status string")
    got = {r.RunId: r.Status for r in I.run_log_latest(ev).collect()}
    assert got == {1: "FAILED", 2: "RUNNING"}
    two = ev.unionByName(ev.withColumn("SourceSystem", F.lit("disasters")).withColumn("Status", F.lit("SUCCESS")))
    got = {(r.RunId, r.SourceSystem): r.Status for r in I.run_log_latest(two).collect()}
    assert len(got) == 4 and got[1, "events"] == "FAILED" and got[1, "disasters"] == "SUCCESS"


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(x / 10,) for x in range(45, 91)], "m double")
    h = {r.bin: r.n for r in Q.histogram(df, "m").collect()}
    assert len(h) == 30 and h[29] >= 1 and sum(h.values()) == 46


def test_completeness_empty_table_is_null(spark):
    df = spark.createDataFrame([], "a int, b string")
    rows = Q.completeness(df, "T", exclude=[]).collect()
    assert all(r.fill_pct is None and r.status is None for r in rows)


def test_duplicate_groups_null_is_a_group(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",)], "k string")
    r = Q.duplicate_groups(df, ["k"]).first()
    assert (r.dup_groups, r.dup_rows) == (2, 4)


def test_streaming_landing_is_idempotent(spark, tmpdir_path):
    from quakehouse.streaming.landing import stream_events
    land = os.path.join(tmpdir_path, "land")
    os.makedirs(land)
    feats = [{"type": "Feature", "id": f"e{i}", "properties": {"time": 1705300931340 + i, "mag": 5.0},
              "geometry": {"type": "Point", "coordinates": [10.0 + i, 20.0, 5.0]}} for i in range(5)]
    feats.append(dict(feats[0]))  # duplicate id inside the batch
    with open(os.path.join(land, "a.json"), "w") as fh:
        fh.write("\n".join(json.dumps(f) for f in feats))
    places = spark.createDataFrame([(1, 20.0, 12.0, "QA")], "place_id int, lat double, lon double, cc string")
    codes = spark.createDataFrame([("QA", "N00")], "ISO2 string, ISO3 string")
    from quakehouse.sources.versions import read_table
    root, ck = (os.path.join(tmpdir_path, n) for n in ("tables", "ck"))
    stream_events(spark, land, root, places, codes, ck).awaitTermination()
    df = read_table(spark, root, "event_stage")
    assert df.count() == 5 and df.select("EventId").distinct().count() == 5
    assert df.filter(F.col("ISO3") != "N00").count() == 0
    # a second file repeating two ids adds only the new one
    with open(os.path.join(land, "b.json"), "w") as fh:
        more = feats[:2] + [{"type": "Feature", "id": "e9", "properties": {"time": 1, "mag": 4.6},
                             "geometry": {"type": "Point", "coordinates": [1.0, 2.0, 3.0]}}]
        fh.write("\n".join(json.dumps(f) for f in more))
    stream_events(spark, land, root, places, codes, ck).awaitTermination()
    assert read_table(spark, root, "event_stage").count() == 6
    # a second stream over the same files is a batch of its own and adds nothing
    stream_events(spark, land, root, places, codes, ck + "2", name="other").awaitTermination()
    after = read_table(spark, root, "event_stage")
    assert after.count() == 6 and after.select("StgId").distinct().count() == 6


def test_disaster_csv_files_with_other_headers(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "exports")
    os.makedirs(folder)
    parts = {"a.csv": "DisNo.,Country,Start Year\nA-1,Chile,2001\n",
             "b.csv": "\ufeffStart Year, DisNo. ,Note\n2002,B-1,\"two\nlines\"\n2003,B-2,x\n",
             "c.csv": "DisNo.,Country,Start Year\nC-1,Peru,2004\n", "empty.csv": ""}
    for name, text in parts.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    rows = {r.DisNo: (r.Country, r.StartYear, r.Note) for r in read_disaster_csv(spark, folder).collect()}
    assert rows == {"A-1": ("Chile", "2001", None), "B-1": (None, "2002", "two\nlines"), "B-2": (None, "2003", "x"),
                    "C-1": ("Peru", "2004", None)}


def _land_years(spark, folder, years):
    for year, n in years.items():
        first = dt.datetime(year, 3, 1, tzinfo=dt.timezone.utc).timestamp() * 1000
        rows = [{"type": "Feature", "id": f"e{year}-{i}", "properties": {"time": int(first) + i, "mag": 5.0, "type": "earthquake"},
                 "geometry": {"type": "Point", "coordinates": [10.0 + i, 20.0, 5.0]}} for i in range(n)]
        os.makedirs(os.path.join(folder, f"year={year}"), exist_ok=True)
        with open(os.path.join(folder, f"year={year}", "part.json"), "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rows))


def _small_load(spark, tmpdir_path, **how):
    from quakehouse.plans import warehouse as WH
    from quakehouse.plans.load import run_load
    places = spark.createDataFrame([(1, 20.0, 12.0, "QA")], "place_id int, lat double, lon double, cc string")
    master = WH.Warehouse(spark, "/root/testdata/sf0.001").master
    return run_load(spark, os.path.join(tmpdir_path, "feed"), os.path.join(tmpdir_path, "dis.csv"), places, master,
                    os.path.join(tmpdir_path, "house"), as_of=dt.date(2024, 1, 1), **how)


def _dangling(t):
    events = t.read("bridge").join(t.read("fact_seismic"), "SeismicKey", "left_anti").count()
    disasters = t.read("bridge").join(t.read("fact_disaster"), "DisasterKey", "left_anti").count()
    codes = t.read("fact_seismic").join(t.read("dim_geography"), "GeographyKey", "left_anti").count()
    return events + disasters + codes


def _disaster_csv(tmpdir_path, ids):
    with open(os.path.join(tmpdir_path, "dis.csv"), "w") as fh:
        fh.write("DisNo.,Disaster Type,ISO,Latitude,Longitude,Start Year,Start Month,Start Day\n")
        fh.writelines(f"{i},Earthquake,N00,20.0,{lon},{y},3,2\n" for i, y, lon in ids)


def test_load_resumes_by_its_own_log(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "feed")
    _land_years(spark, folder, {2001: 3, 2002: 4})
    _disaster_csv(tmpdir_path, [("D1", 2001, 10.0)])
    t = _small_load(spark, tmpdir_path, batch_id=1, first_year=2001, today=dt.date(2002, 12, 31))
    assert t.read("event_stage").count() == 7
    # finished years are not read again; a later one is, up to today
    _land_years(spark, folder, {2002: 9, 2003: 5, 2004: 2})
    t = _small_load(spark, tmpdir_path, batch_id=2, first_year=2001, today=dt.date(2003, 6, 1))
    assert t.read("event_stage").count() == 7 + 5
    # the year in progress is read again
    _land_years(spark, folder, {2003: 8})
    t = _small_load(spark, tmpdir_path, batch_id=3, first_year=2001, today=dt.date(2003, 7, 1))
    assert t.read("event_stage").count() == 7 + 8
    log = spark.read.parquet(os.path.join(tmpdir_path, "house", "run_log"))
    got = {r.RunId: (r.ExtractFrom, r.ExtractTo, r.RowsExtracted, r.RowsLoaded)
           for r in log.filter("SourceSystem = 'events' AND Status = 'SUCCESS'").collect()}
    day = dt.date
    assert got == {1: (day(2001, 1, 1), day(2002, 12, 31), 7, 7), 2: (day(2003, 1, 1), day(2003, 6, 1), 5, 5),
                   3: (day(2003, 1, 1), day(2003, 7, 1), 8, 3)}
    last = spark.range(1).select(I.last_success(I.run_log_latest(log), "events")).first()[0]
    assert last == day(2003, 7, 1)
    assert {(r.part, r.n) for r in t.read("volume_alarms").collect()} == {(2001, 3), (2002, 4), (2003, 5), (2003, 8)}
    # only the folders of the years asked for are scanned
    feed = read_event_geojson(spark, folder, lines=True, years=(2003, 2003))
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert feed.count() == 8 and "PartitionFilters: [isnotnull(year" in plan


def test_rerun_of_an_older_run_keeps_ids_and_leaves_no_dangling_key(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "feed")
    _land_years(spark, folder, {2001: 4})
    _disaster_csv(tmpdir_path, [("D1", 2001, 10.0)])
    first = _small_load(spark, tmpdir_path, batch_id=1)
    ids = {r.EventId: r.StgId for r in first.read("event_stage").collect()}
    _land_years(spark, folder, {2000: 3, 2001: 6})
    _disaster_csv(tmpdir_path, [("D0", 2000, 10.0), ("D1", 2001, 10.0), ("D2", 2001, 11.0)])
    second = _small_load(spark, tmpdir_path, batch_id=2)
    after = {r.EventId: r.StgId for r in second.read("event_stage").collect()}
    assert len(set(after.values())) == len(after) == 9 and ids.items() <= after.items() and _dangling(second) == 0
    assert second.read("bridge").count() > 0
    # run 1 again, over what has meanwhile landed: its rows keep their ids
    again = _small_load(spark, tmpdir_path, batch_id=1)
    assert {r.EventId: r.StgId for r in again.read("event_stage").collect()} == after
    assert _dangling(again) == 0 and again.read("bridge").count() == second.read("bridge").count()
    # run 1 again, from a feed that lost its events: nothing of the earlier attempts stays
    _land_years(spark, folder, {2000: 0, 2001: 0})
    empty = _small_load(spark, tmpdir_path, batch_id=1)
    kept = {r.EventId: r.StgId for r in empty.read("event_stage").collect()}
    assert set(kept) == set(after) - set(ids) and kept.items() <= after.items()
    assert _dangling(empty) == 0 and empty.read("fact_seismic").count() == len(kept)


def test_load_over_empty_feeds_can_be_read(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "feed"))
    with open(os.path.join(tmpdir_path, "feed", "none.json"), "w"):
        pass
    _disaster_csv(tmpdir_path, [])
    t = _small_load(spark, tmpdir_path, batch_id=1)
    assert all(t.read(n).count() == 0 for n in ("event_stage", "event_rejects", "fact_seismic", "fact_disaster", "bridge"))
    assert t.read("dim_geography").count() == 1  # the sentinel


def test_failed_load_changes_nothing(spark, tmpdir_path, monkeypatch):
    import pytest

    from quakehouse.plans import load as LD
    _land_years(spark, os.path.join(tmpdir_path, "feed"), {2001: 4})
    _disaster_csv(tmpdir_path, [("D1", 2001, 10.0)])
    before = _small_load(spark, tmpdir_path, batch_id=1)
    _land_years(spark, os.path.join(tmpdir_path, "feed"), {2001: 9})
    def lost(*a, **k):
        raise RuntimeError("executor lost")
    monkeypatch.setattr(LD.B, "build_bridge", lost)
    with pytest.raises(RuntimeError):
        _small_load(spark, tmpdir_path, batch_id=2)
    from quakehouse.sources.versions import Tables
    now = Tables(spark, os.path.join(tmpdir_path, "house"))
    assert now.version == before.version and now.read("event_stage").count() == 4
    log = I.run_log_latest(spark.read.parquet(os.path.join(tmpdir_path, "house", "run_log")))
    assert {(r.RunId, r.Status) for r in log.collect()} == {(1, "SUCCESS"), (2, "FAILED")}


def test_repair_of_stored_tables(spark, tmpdir_path):
    from quakehouse.plans.load import repair_disasters
    from quakehouse.sources.versions import Tables
    _land_years(spark, os.path.join(tmpdir_path, "feed"), {2001: 4})
    _disaster_csv(tmpdir_path, [("D1", 2001, 10.0), ("D2", 2001, 11.0)])
    t = _small_load(spark, tmpdir_path, batch_id=1)
    facts, links = t.read("fact_disaster").count(), t.read("bridge").count()
    # the double load: the same rows staged and promoted once more under new ids
    c = t.change()
    twice = t.read("disaster_stage")
    c.put("disaster_stage", twice.withColumn("StgId", F.col("StgId") + 100).withColumn("LoadBatchId", F.lit(7)), 7)
    fact = t.read("fact_disaster").withColumns({"StgId": F.col("StgId") + 100, "DisasterKey": F.col("DisasterKey") + 100, "LoadBatchId": F.lit(7)})
    c.put("fact_disaster", fact.select(t.read("fact_disaster").columns), 7)
    c.commit()
    assert Tables(spark, t.root).read("fact_disaster").count() == 2 * facts
    counts = {r.tbl: r.rows_now for r in repair_disasters(spark, t.root).collect()}
    assert counts == {"STG_Disaster": 2, "FactDisaster": facts, "FactDisaster distinct date+geo+deaths": 1 if facts == 2 else facts,
                      "BridgeDisasterSeismic": links}
    now = Tables(spark, t.root)
    assert _dangling(now) == 0
    # a re-run after the repair finds everything promoted
    again = _small_load(spark, tmpdir_path, batch_id=1)
    assert again.read("fact_disaster").count() == facts and again.read("bridge").count() == links


def test_bucket_counts_and_count_distinct(spark):
    import pytest
    df = spark.createDataFrame([(x, x % 2) for x in (-5, 0, 1, 2, 10, 11)] + [(None, 1), (None, 1)], "v int, w int")
    got = [(r.bucket, r.n) for r in Q.bucket_counts(df, "v", [-1, 0, 5, 10], ["zero", "few", "many"]).collect()]
    assert got == [("zero", 1), ("few", 2), ("many", 1)]
    with pytest.raises(ValueError):
        Q.bucket_counts(df, "v", [0, 1], ["a", "b"])
    assert Q.count_distinct(df, "v", "w").first().n == 7 and Q.count_distinct(df.limit(0), "v").first().n == 0


def test_key_checks_of_many_tables(spark):
    t = {"F": spark.createDataFrame([(1, 1, 9), (2, 7, 9), (3, None, 8), (3, 7, None)], "id int, a long, b int"),
         "A": spark.createDataFrame([(1,), (2,)], "k int"), "B": spark.createDataFrame([(9,)], "k int")}
    fk = {(r.table_name, r.fk_column): r.violations for r in Q.all_fk_violations(t, [("F", "a", "A", "k"), ("F", "b", "B", "k"), ("F", "id", "A", "k")]).collect()}
    assert fk == {("F", "a"): 2, ("F", "b"): 1, ("F", "id"): 2}
    pk = {(r.table_name, r.key_columns): (r.dup_groups, r.dup_rows) for r in Q.all_pk_violations(t, [("F", ["id"]), ("F", ["a", "b"]), ("A", ["k"])]).collect()}
    assert pk == {("F", "id"): (1, 2), ("F", "a,b"): (0, 0), ("A", "k"): (0, 0)}


def test_export_texts_are_parsed_once_before_ids_are_given_out(spark, tmpdir_path):
    from quakehouse.operators import staging as ST
    path = os.path.join(tmpdir_path, "export.csv")
    with open(path, "w") as f:
        f.write("DisNo.,Disaster Type,Start Year,ISO\nD2,Earthquake,2001,AAA\nD1, earthquake ,1_999,BBB\nD2,Earthquake,2005,CCC\nD3,Flood,2001,AAA\n,Earthquake,2002,DDD\n")
    got = ST.ingest_disasters(read_disaster_csv(spark, path), 0)
    assert any("ingest_disasters_rows" in f for f in got.inputFiles())
    assert not any("ingest_disasters_batch" in f for f in got.inputFiles())
    assert sorted((r.DisNo or "", r.StartYear, r.ISO) for r in got.collect()) == [("", 2002, "DDD"), ("D1", 1999, "BBB"), ("D2", 2001, "AAA")]
    assert sorted(r.StgId for r in got.collect()) == [1, 2, 3]


def test_landed_features_are_compressed(spark):
    from quakehouse.plans import catalog_io as CI
    from quakehouse.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    feed = read_event_geojson(spark, CI._events_path(w), lines=True)
    assert all(f.endswith(".txt.gz") for f in feed.inputFiles())
    assert feed.count() == feed.filter(F.col("id").isNotNull()).count() == w.event_stage.count()


def test_staged_rows_are_stored_before_the_codes_join(spark, tmpdir_path, monkeypatch):
    """First copies, ids and codes are shuffled one after the other, each from a stored table (before, all in the one job that wrote the rows)."""
    import json
    import os

    from quakehouse.operators import staging as ST
    from quakehouse.plans import fixtures as FX
    from quakehouse.plans import warehouse as WH
    from quakehouse.sources.readers import read_event_geojson

    sf = "/root/testdata/sf0.001"
    path = os.path.join(tmpdir_path, "few_events.json")
    with open(path, "w") as fh:
        for i, (id_, lat) in enumerate([("a", 10.0), ("b", 20.5), ("a", 30.0), (None, 10.0), (None, 95.0)]):
            fh.write(json.dumps({"type": "Feature", "id": id_, "properties": {"mag": 5.0, "time": i, "type": "earthquake"},
                                 "geometry": {"type": "Point", "coordinates": [20.0, lat, 10.0]}}) + "\n")
    stored = []
    materialize = ST.materialize
    monkeypatch.setattr(ST, "materialize", lambda df, name: stored.append(name) or materialize(df, name))
    got = ST.ingest_events(read_event_geojson(spark, path, lines=True), 1, FX.places(spark, sf), WH.Warehouse(spark, sf).master)
    assert stored[-2:] == ["ingest_events_rows", "ingest_events_ids"]
    rows = sorted(((r.EventId or "", float(r.Latitude), len(r.ISO3)) for r in got.staged.collect()))
    assert rows == [("", 10.0, 3), ("a", 10.0, 3), ("b", 20.5, 3)]
    assert got.rejects.count() == 1
