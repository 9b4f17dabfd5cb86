"""Registered queries for SCD2 changes, keys, promotion, cleaning, distance,
ingest filters and dedup (with their DuckDB oracle SQL)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from quakehouse.functions import columns as C
from quakehouse.operators import bridge as B
from quakehouse.operators import dims as D
from quakehouse.operators import facts as FA
from quakehouse.operators import ingest as I
from quakehouse.operators.keys import assign_keys
from quakehouse.plans import fixtures as FX
from quakehouse.plans.catalog import _wh, nullable_as_double, query
from quakehouse.plans.oracle import hv, key_date
from quakehouse.plans.queries_sql import oracle

# ---------------------------------------------------------------- fixed values
# Official renames applied in the SCD2 change scenario, and its load date.
RENAMES = {"N03": "Republic of NATION_3", "N07": "Republic of NATION_7",
           "N11": "Republic of NATION_11"}
RENAME_AS_OF = _dt.date(2024, 6, 1)
# Batches already promoted/staged before the scenario runs.
EARLY_BATCH_MAX = 1997
# Clock of the incremental-load scenario.
INCREMENTAL_TODAY = _dt.date(2001, 6, 1)
FAILED_FROM_YEAR = 2000

_RENAMED_SQL = """
select CountryDurableKey, ISO3, case {cases} else CountryName end as CountryName, SubRegion, Region,
  GEM_PGA_g, GeoSeismicZone from incoming
""".format(cases=" ".join(f"when ISO3 = '{k}' then '{v}'" for k, v in RENAMES.items()))

_SCD2_CTES = {
    "renamed": _RENAMED_SQL,
    "changed": """
select r.* from renamed r join dim_geo g on g.CountryDurableKey = r.CountryDurableKey and g.IsCurrent = 1
where g.CountryName <> r.CountryName
""",
    "dim_geo2": f"""
select GeographyKey, CountryName, ISO, SubRegion, Region, ValidFrom,
  case when IsCurrent = 1 and CountryDurableKey in (select CountryDurableKey from changed)
       then date '{RENAME_AS_OF - _dt.timedelta(days=1)}' else ValidTo end as ValidTo,
  case when IsCurrent = 1 and CountryDurableKey in (select CountryDurableKey from changed) then 0 else IsCurrent end as IsCurrent,
  GeoSeismicZone, GEM_PGA_g, CountryDurableKey
from dim_geo
union all
select (select max(GeographyKey) from dim_geo) + row_number() over (order by CountryDurableKey), CountryName, ISO3,
  SubRegion, Region, date '{RENAME_AS_OF}', cast(null as date), 1, GeoSeismicZone, cast(GEM_PGA_g as decimal(4,3)),
  CountryDurableKey
from changed
""",
}


def _renamed_dim(w):
    master2 = D.rename_countries(w.master, RENAMES)
    incoming2 = D.incoming_countries(w.codes, master2)
    return D.scd2_apply(w.dim_geo, incoming2, RENAME_AS_OF)


@query("scd2_rename")
def scd2_rename(spark, sf_dir):
    """Renamed countries get their current row closed and a new version."""
    return _renamed_dim(_wh(spark, sf_dir))


oracle("scd2_rename", """
select cast(GeographyKey as bigint) as GeographyKey, CountryName, ISO, SubRegion, Region,
  strftime(ValidFrom, '%Y-%m-%d') as ValidFrom, strftime(ValidTo, '%Y-%m-%d') as ValidTo,
  cast(IsCurrent as bigint) as IsCurrent, GeoSeismicZone, cast(GEM_PGA_g as double) as GEM_PGA_g,
  cast(CountryDurableKey as bigint) as CountryDurableKey
from dim_geo2
""", _SCD2_CTES)


@query("multi_version")
def multi_version(spark, sf_dir):
    """All versions of countries with more than one version."""
    return D.multi_version(_renamed_dim(_wh(spark, sf_dir)))


oracle("multi_version", """
select cast(CountryDurableKey as bigint) as CountryDurableKey, cast(GeographyKey as bigint) as GeographyKey,
  CountryName, ISO, strftime(ValidFrom, '%Y-%m-%d') as ValidFrom, strftime(ValidTo, '%Y-%m-%d') as ValidTo,
  cast(IsCurrent as bigint) as IsCurrent
from dim_geo2
where CountryDurableKey in (select CountryDurableKey from dim_geo2 group by CountryDurableKey having count(*) > 1)
""", _SCD2_CTES)


@query("bridge_durable")
def bridge_durable(spark, sf_dir):
    """J9/U6 with Q-9's option: disasters promoted after the renames (new version
    keys) still meet events loaded under the old versions, by durable country key."""
    w = _wh(spark, sf_dir)
    # the dimension after the renames is a stored table, as after every load
    dim2 = w.stored("dim_geo_renamed", lambda: _renamed_dim(w))
    dis2 = FA.fact_disaster(w.disaster_stage, dim2, w.deaths_bands, w.affected_bands, w.dim_date).fact
    return B.build_bridge(dis2, w.fact_seismic, match_on="CountryDurableKey", dim_geo=dim2, distance="double")


_DURABLE_CTES = dict(_SCD2_CTES)
_DURABLE_CTES["disaster_fact2"] = """
select e.StgId as DisasterKey, e.sdate, e.Latitude, e.Longitude, coalesce(g.GeographyKey, (select k from xin_key)) as GeographyKey
from disaster_dates e left join dim_geo2 g on g.ISO = e.ISO and g.IsCurrent = 1
where e.StartYear is not null and e.StartYear between 1900 and 2030
  and exists (select 1 from calendar c where c.DateKey = year(e.sdate) * 10000 + month(e.sdate) * 100 + day(e.sdate))
"""

oracle("bridge_durable", f"""
select cast(d.DisasterKey as bigint) as DisasterKey, cast(s.SeismicKey as bigint) as SeismicKey,
  case when d.Latitude is not null and s.Latitude is not null
       then {hv('cast(d.Latitude as decimal(8,5))', 'cast(d.Longitude as decimal(9,5))', 's.Latitude', 's.Longitude')} end as DistanceKM,
  cast(date_diff('day', s.sday, d.sdate) as bigint) as TimeLagDays
from disaster_fact2 d
join dim_geo2 gd on gd.GeographyKey = d.GeographyKey
join (select f.*, {key_date('f.DateKey')} as sday, g.CountryDurableKey
      from seismic_fact f join dim_geo2 g on g.GeographyKey = f.GeographyKey) s
  on s.CountryDurableKey = gd.CountryDurableKey and s.sday between d.sdate - interval 3 day and d.sdate
where s.sday between date '1990-01-01' and date '2030-12-31'
  and (d.Latitude is null or {hv('cast(d.Latitude as decimal(8,5))', 'cast(d.Longitude as decimal(9,5))', 's.Latitude', 's.Longitude')} <= 100)
""", _DURABLE_CTES)


@query("surrogate_keys")
def surrogate_keys(spark, sf_dir):
    """K1/K2: dense keys in the order of a unique tuple, without a single-partition window."""
    li = FX.table(spark, sf_dir, "lineitem").select(*FX.EVENT_ORDER)
    out = assign_keys(li, FX.EVENT_ORDER, name="key")
    return out.select("key", *FX.EVENT_ORDER)


oracle("surrogate_keys", """
select cast(row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) as bigint) as key,
  cast(l_orderkey as bigint) as l_orderkey, cast(l_linenumber as bigint) as l_linenumber,
  cast(l_partkey as bigint) as l_partkey, cast(l_suppkey as bigint) as l_suppkey,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate
from lineitem
""")


def _second_run(w):
    """Promotion over all staging after a first run over the early batches."""
    early = w.event_stage.filter(F.col("LoadBatchId") <= EARLY_BATCH_MAX)
    first = FA.fact_seismic(early, w.dim_geo, w.mag_bands, w.depth_bands)
    return FA.fact_seismic(w.event_stage, w.dim_geo, w.mag_bands, w.depth_bands,
                           tracker=first.marks)


@query("promotion_marks")
def promotion_marks(spark, sf_dir):
    """Ids newly marked by a second run (already-promoted ids skipped)."""
    return _second_run(_wh(spark, sf_dir)).marks


_MARKS_SQL = f"""
select StgId from seismic_marks
where StgId not in (select m.StgId from seismic_marks m join event_stage s using (StgId) where s.LoadBatchId <= {EARLY_BATCH_MAX})
"""
oracle("promotion_marks", "select cast(StgId as bigint) as StgId from marks2", {"marks2": _MARKS_SQL})


@query("promotion_dropped")
def promotion_dropped(spark, sf_dir):
    """U3/Q-1..Q-4: marked ids of the second run that produced no fact row."""
    return _second_run(_wh(spark, sf_dir)).dropped


oracle("promotion_dropped", """
select cast(StgId as bigint) as StgId from marks2 where StgId not in (select StgId from seismic_fact)
""", {"marks2": _MARKS_SQL})


@query("partial_dates")
def partial_dates(spark, sf_dir):
    """Resolved start and end dates and the duration in days."""
    s = _wh(spark, sf_dir).disaster_stage
    start = C.partial_start("StartYear", "StartMonth", "StartDay")
    end = C.partial_end("EndYear", "EndMonth", "EndDay", "StartYear", "StartMonth", "StartDay")
    return nullable_as_double(s.select("StgId", start.alias("StartDate"), end.alias("EndDate"),
                                       F.datediff(end, start).alias("DurationDays")), ["DurationDays"])


oracle("partial_dates", """
select cast(StgId as bigint) as StgId, strftime(sdate, '%Y-%m-%d') as StartDate, strftime(edate, '%Y-%m-%d') as EndDate,
  cast(date_diff('day', sdate, edate) as double) as DurationDays
from disaster_dates
""")


def _raw_number():
    k = F.col("o_orderkey")
    ks = lambda c: c.cast("string")
    return (F.when(k % 8 == 0, F.concat(ks(F.col("o_custkey")), F.lit("."), ks(k % 10)))
            .when(k % 8 == 1, F.concat(F.lit("-"), ks(k % 5), F.lit(".5")))
            .when(k % 8 == 2, F.lit("nan"))
            .when(k % 8 == 3, F.lit(""))
            .when(k % 8 == 4, F.concat(ks(k % 7), F.lit(".5")))
            .when(k % 8 == 5, F.concat(F.lit("abc"), ks(k)))
            .when(k % 8 == 6, F.concat(F.lit(" "), ks(F.col("o_custkey")), F.lit("_0 ")))
            .otherwise(F.lit("inf")))


_RAW_NUMBER_SQL = """
case o_orderkey % 8
  when 0 then concat(cast(o_custkey as varchar), '.', cast(o_orderkey % 10 as varchar))
  when 1 then concat('-', cast(o_orderkey % 5 as varchar), '.5')
  when 2 then 'nan' when 3 then ''
  when 4 then concat(cast(o_orderkey % 7 as varchar), '.5')
  when 5 then concat('abc', cast(o_orderkey as varchar))
  when 6 then concat(' ', cast(o_custkey as varchar), '_0 ')
  else 'inf' end
"""
_NUM_RX = C._NUMERIC_RX.replace("'", "''")


def _sql_double(x: str) -> str:
    return (f"(case when regexp_matches(lower({x}), '{_NUM_RX}') then "
            f"try_cast(replace(regexp_replace(lower({x}), '^\\s+|\\s+$', '', 'g'), '_', '') as double) end)")


@query("lenient_numbers")
def lenient_numbers(spark, sf_dir):
    """Lenient int, bigint (banker's rounding) and float parsing of text."""
    o = FX.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    raw = _raw_number()
    out = o.select("o_orderkey", raw.alias("raw"), C.int_or_null(raw).alias("int_v"),
                   C.bigint_or_null(raw).alias("bigint_v"), C.float_or_null(raw).alias("float_v"))
    return nullable_as_double(out, ["int_v", "bigint_v"])


_D = _sql_double("raw")
_F = f"(case when isnan({_D}) or isinf({_D}) then null else {_D} end)"
oracle("lenient_numbers", f"""
select cast(o_orderkey as bigint) as o_orderkey, raw,
  cast(case when try_cast(trunc({_F}) as integer) >= 0 then try_cast(trunc({_F}) as integer) end as double) as int_v,
  cast(case when try_cast(round_even({_F}, 0) as bigint) >= 0 then try_cast(round_even({_F}, 0) as bigint) end as double) as bigint_v,
  case when isnan({_D}) then null else {_D} end as float_v
from (select o_orderkey, {_RAW_NUMBER_SQL} as raw from orders) t
""")


def _raw_text():
    k = F.col("c_custkey")
    return (F.when(k % 5 == 0, F.lit(None).cast("string"))
            .when(k % 4 == 0, F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("  ")))
            .when(k % 4 == 1, F.lit(""))
            .when(k % 4 == 2, F.lit("   "))
            .otherwise(F.col("c_name")))


@query("clean_strings")
def clean_strings(spark, sf_dir):
    """NULL-or-trimmed-and-cut vs empty-default-and-cut text cleaning."""
    c = FX.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    raw = _raw_text()
    return c.select("c_custkey", raw.alias("raw"), C.clean_str(raw, 5).alias("clean"),
                    C.cut_str(raw, 5).alias("cut"))


oracle("clean_strings", """
select cast(c_custkey as bigint) as c_custkey, raw,
  case when raw is null or raw = '' then null else substr(regexp_replace(raw, '^\\s+|\\s+$', '', 'g'), 1, 5) end as clean,
  substr(coalesce(raw, ''), 1, 5) as cut
from (select c_custkey, case when c_custkey % 5 = 0 then null when c_custkey % 4 = 0 then concat('  ', c_mktsegment, '  ')
   when c_custkey % 4 = 1 then '' when c_custkey % 4 = 2 then '   ' else c_name end as raw from customer) t
""")


@query("contains_flag")
def contains_flag(spark, sf_dir):
    """Case-insensitive substring flag, NULL as 0."""
    o = FX.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return o.select("o_orderkey", C.contains_flag("o_orderpriority", "urgent").alias("flag"))


oracle("contains_flag", """
select cast(o_orderkey as bigint) as o_orderkey,
  cast(case when contains(lower(coalesce(o_orderpriority, '')), 'urgent') then 1 else 0 end as bigint) as flag
from orders
""")


@query("haversine_pairs")
def haversine_pairs(spark, sf_dir):
    """Distance from each disaster to its country's reference point (NULL if no coordinates)."""
    w = _wh(spark, sf_dir)
    m = w.master.select("ISO3", ((F.col("CountryDurableKey") - 2) * 7 - 80).alias("clat"),
                        ((F.col("CountryDurableKey") - 2) * 13 - 160).alias("clon"))
    j = w.disaster_stage.join(F.broadcast(m), w.disaster_stage.ISO == m.ISO3)
    return j.select("StgId", C.haversine_km("Latitude", "Longitude", "clat", "clon").alias("distance_km"))


oracle("haversine_pairs", f"""
select cast(s.StgId as bigint) as StgId,
  {hv('s.Latitude', 's.Longitude', '(m.CountryDurableKey - 2) * 7 - 80', '(m.CountryDurableKey - 2) * 13 - 160')} as distance_km
from disaster_stage s join master m on s.ISO = m.ISO3
""")


@query("split_valid")
def split_valid(spark, sf_dir):
    """valid/invalid flag of staged events (missing core field, out-of-range coordinate)."""
    s = _wh(spark, sf_dir).event_stage
    good, bad = I.split_valid(s)
    return (good.select("StgId", F.lit(0).alias("is_bad"))
            .unionByName(bad.select("StgId", F.lit(1).alias("is_bad"))))


_BAD_SQL = ("(Latitude is null or Longitude is null or Mag is null or Depth is null "
            "or abs(Latitude) > 90 or abs(Longitude) > 180)")
oracle("split_valid", f"""
select cast(StgId as bigint) as StgId, cast(case when {_BAD_SQL} then 1 else 0 end as bigint) as is_bad from event_stage
""")


@query("rejects")
def rejects(spark, sf_dir):
    """Reject records of invalid events (batch, id, reason); raw JSON kept in the library."""
    s = _wh(spark, sf_dir).event_stage
    _, bad = I.split_valid(s)
    return I.reject_rows(bad, F.col("LoadBatchId")).select("LoadBatchId", "EventId", "RejectReason")


oracle("rejects", f"""
select cast(LoadBatchId as bigint) as LoadBatchId, substr(EventId, 1, 20) as EventId,
  '{I.REJECT_REASON}' as RejectReason
from event_stage where {_BAD_SQL}
""")


@query("staging_antijoin")
def staging_antijoin(spark, sf_dir):
    """J6 (+Q-23): later batches minus already-staged ids, first row per id inside the batch."""
    s = _wh(spark, sf_dir).event_stage
    staged = s.filter(F.col("LoadBatchId") <= EARLY_BATCH_MAX)
    incoming = s.filter(F.col("LoadBatchId") > EARLY_BATCH_MAX)
    return I.not_yet_staged(incoming, staged, "EventId", order="StgId").select("StgId", "EventId")


oracle("staging_antijoin", f"""
select cast(StgId as bigint) as StgId, EventId from event_stage
where LoadBatchId > {EARLY_BATCH_MAX}
  and EventId not in (select EventId from event_stage where LoadBatchId <= {EARLY_BATCH_MAX})
qualify row_number() over (partition by EventId order by StgId) = 1
""")


@query("keep_first")
def keep_first(spark, sf_dir):
    """Lowest staging id per business id."""
    s = _wh(spark, sf_dir).event_stage
    return FA.keep_first(s, ["EventId"]).select("EventId", "StgId")


oracle("keep_first", """
select EventId, cast(min(StgId) as bigint) as StgId from event_stage group by EventId
""")


@query("rebuild")
def rebuild(spark, sf_dir):
    """Dedup disaster staging by DisNo, rebuild fact + bridge from scratch, report counts."""
    from quakehouse.plans.load import rebuild_disasters
    w = _wh(spark, sf_dir)
    fact, br = rebuild_disasters(w.disaster_stage, w.dim_geo, w.fact_seismic, spark)
    distinct = fact.select("StartDate", "GeographyKey", "TotalDeaths").distinct()
    parts = [("FactDisaster", fact), ("FactDisaster distinct date+geo+deaths", distinct),
             ("BridgeDisasterSeismic", br)]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("rows_now")).select(F.lit(name).alias("tbl"), "rows_now")
        out = one if out is None else out.unionByName(one)
    return out


oracle("rebuild", """
select 'FactDisaster' as tbl, cast(count(*) as bigint) as rows_now from disaster_fact
  where StgId in (select min(StgId) from disaster_stage group by DisNo)
union all
select 'FactDisaster distinct date+geo+deaths', cast(count(*) as bigint) from
  (select distinct StartDate, GeographyKey, TotalDeaths from disaster_fact
   where StgId in (select min(StgId) from disaster_stage group by DisNo)) x
union all
select 'BridgeDisasterSeismic', cast(count(*) as bigint) from bridge
  where DisasterKey in (select StgId from disaster_fact where StgId in (select min(StgId) from disaster_stage group by DisNo))
""")


@query("event_slice")
def event_slice(spark, sf_dir):
    """Half-open time slice with a minimum value and an event type."""
    ev = FX.table(spark, sf_dir, "events")
    s = I.event_slice(ev, "ts", "2024-01-10", "2024-01-20", "value", 4.5, "event_type", "click")
    return s.select("event_id", "ts", "value")


oracle("event_slice", """
select cast(event_id as bigint) as event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, value from events
where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20' and value >= 4.5 and event_type = 'click'
""")


@query("filter_type")
def filter_type(spark, sf_dir):
    """Trimmed, case-insensitive type filter."""
    ev = FX.table(spark, sf_dir, "events")
    return I.filter_type(ev, "event_type", "View").select("event_id", "event_type")


oracle("filter_type", """
select cast(event_id as bigint) as event_id, event_type from events where lower(trim(event_type)) = 'view'
""")


@query("year_volume_alarm")
def year_volume_alarm(spark, sf_dir):
    """Staged rows per yearly batch and whether the batch reaches the alarm level."""
    from quakehouse.operators.quality import volume_alarm
    s = _wh(spark, sf_dir).event_stage
    return volume_alarm(s, F.col("LoadBatchId"))


oracle("year_volume_alarm", """
select cast(LoadBatchId as bigint) as part, cast(count(*) as bigint) as n,
  cast(case when count(*) >= 19900 then 1 else 0 end as bigint) as alarm
from event_stage group by LoadBatchId
""")


# ---------------------------------------------------------------- run log and resume
def _run_events(stage):
    """A start and a finish event per yearly batch, derived from the staged batches."""
    per = stage.groupBy("LoadBatchId").agg(F.count(F.lit(1)).alias("n"))
    y = F.col("LoadBatchId")
    start = F.make_date(y, F.lit(1), F.lit(1))
    end = F.make_date(y, F.lit(12), F.lit(31))
    t0 = F.to_timestamp(F.date_add(end, 1))
    begin = per.select(*I.run_event(y, "events", I.RUN_RUNNING, t0, start, end))
    done = [per.filter(ok).select(*I.run_event(y, "events", status, t0 + F.expr("INTERVAL 1 HOUR"),
                                               start, end, loaded=F.col("n"), rejected=F.lit(0)))
            for ok, status in ((y < FAILED_FROM_YEAR, I.RUN_SUCCESS),
                               (y >= FAILED_FROM_YEAR, I.RUN_FAILED))]
    return begin.unionByName(done[0]).unionByName(done[1])


@query("run_log_latest")
def run_log_latest(spark, sf_dir):
    """Latest state of each run from append-only start/finish events."""
    ev = _run_events(_wh(spark, sf_dir).event_stage)
    return I.run_log_latest(ev).select("RunId", "SourceSystem", "Status", "ExtractFrom", "ExtractTo",
                                       "RowsLoaded")


oracle("run_log_latest", f"""
select cast(LoadBatchId as bigint) as RunId, 'events' as SourceSystem,
  case when LoadBatchId >= {FAILED_FROM_YEAR} then 'FAILED' else 'SUCCESS' end as Status,
  strftime(make_date(LoadBatchId, 1, 1), '%Y-%m-%d') as ExtractFrom,
  strftime(make_date(LoadBatchId, 12, 31), '%Y-%m-%d') as ExtractTo,
  cast(count(*) as bigint) as RowsLoaded
from event_stage group by LoadBatchId
""")


@query("incremental_slice")
def incremental_slice(spark, sf_dir):
    """U8: staged rows from the resume year on (after the last successful run)."""
    w = _wh(spark, sf_dir)
    latest = I.run_log_latest(_run_events(w.event_stage))
    s = I.incremental_slice(w.event_stage, "LoadBatchId", latest, "events", INCREMENTAL_TODAY)
    return s.select("StgId", "EventId", "LoadBatchId")


oracle("incremental_slice", """
select cast(StgId as bigint) as StgId, EventId, cast(LoadBatchId as bigint) as LoadBatchId
from event_stage where LoadBatchId >= (select y from resume_year)
""", {
    "last_ok": f"""
select coalesce(max(make_date(LoadBatchId, 12, 31)), date '{I.FIRST_YEAR - 1}-12-31') as d
from (select distinct LoadBatchId from event_stage) b where LoadBatchId < {FAILED_FROM_YEAR}""",
    "resume_year": f"""
select least(year(d) + case when d >= make_date(year(d), 12, 31) then 1 else 0 end,
             {INCREMENTAL_TODAY.year}) as y from last_ok""",
})
