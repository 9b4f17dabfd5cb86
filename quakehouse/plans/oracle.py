"""SQL text of the derived warehouse for the DuckDB oracle.

Each entry is a CTE body; :func:`sql` pulls in the CTEs a query needs, in
dependency order. These statements restate the semantics directly (range join
for the bridge, global ``row_number`` for keys) so they check the Spark plans
rather than mirror them.
"""

from __future__ import annotations

import math
import re

RAD = repr(math.pi / 180.0)


def hv(la1: str, lo1: str, la2: str, lo2: str, rounded: bool = True) -> str:
    """Haversine km in SQL (inputs rounded to 5 decimals, result to 3)."""
    if rounded:
        la1, lo1, la2, lo2 = (f"round(cast({x} as double), 5)" for x in (la1, lo1, la2, lo2))
    else:
        la1, lo1, la2, lo2 = (f"cast({x} as double)" for x in (la1, lo1, la2, lo2))
    a = (f"(pow(sin((({la2}) - ({la1})) * {RAD} / 2), 2) + cos(({la1}) * {RAD}) * "
         f"cos(({la2}) * {RAD}) * pow(sin((({lo2}) - ({lo1})) * {RAD} / 2), 2))")
    a = f"(case when {a} > 1.0 then 1.0 else {a} end)"
    d = f"(6371.0 * 2.0 * atan2(sqrt({a}), sqrt(1.0 - {a})))"
    return f"round({d}, 3)" if rounded else d


def dkey(d: str) -> str:
    return f"(year({d}) * 10000 + month({d}) * 100 + day({d}))"


def to_date_txt(txt: str, fmt: str = "%Y-%m-%d") -> str:
    return f"cast(try_strptime({txt}, '{fmt}') as date)"


def make_date(y: str, m: str, d: str) -> str:
    ok = f"({y}) is not null and ({m}) is not null and ({d}) is not null and ({y}) between 1 and 9999"
    txt = f"printf('%04d-%02d-%02d', {y}, {m}, {d})"
    return f"(case when {ok} then {to_date_txt(txt)} end)"


def key_date(k: str) -> str:
    return to_date_txt(f"lpad(cast({k} as varchar), 8, '0')", "%Y%m%d")


CTES: dict[str, str] = {}

CTES["event_stage"] = """
select id as StgId,
  concat('e', cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as EventId,
  case when id % 97 = 0 then 'None' else concat(cast(cast(l_shipdate as date) as varchar), 'T00:00:00+00:00') end as SrcTime,
  case when id % 83 = 0 then cast(95 as double) else cast(n * 7 - 80 as double) + cast(l_partkey % 200 as double) / 100 end as Latitude,
  cast(n * 13 - 160 as double) + cast((l_suppkey * 37 + l_linenumber * 11) % 200 as double) / 100 as Longitude,
  case when id % 61 = 0 then null else cast((l_partkey * 7 + l_orderkey * 13) % 800 - 5 as double) end as Depth,
  cast(case when id % 50 = 0 then least(floor(l_quantity / 5), 9) + 0.99 else l_quantity / 5 end as decimal(4,2)) as Mag,
  case when id % 14 = 0 then cast(l_linenumber as double) else null end as Mmi,
  cast(l_quantity * 10 as int) as Sig,
  case when id % 6 = 0 then cast(l_linenumber as double) / 2 else null end as Cdi,
  case when id % 11 = 0 then 'XIN' when id % 13 = 0 then 'ZZZ' else concat('N', lpad(cast(n as varchar), 2, '0')) end as ISO3,
  year(l_shipdate) as LoadBatchId
from (select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) as id,
             l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, s_nationkey as n
      from lineitem join supplier on l_suppkey = s_suppkey) k
"""

CTES["disaster_stage"] = """
select o_orderkey + 1 as StgId,
  concat('D', cast(o_orderkey - case when o_orderkey % 40 = 1 then 1 else 0 end as varchar)) as DisNo,
  concat('N', lpad(cast(c_nationkey as varchar), 2, '0')) as ISO,
  case when o_orderkey % 25 = 0 then null else cast(c_nationkey * 7 - 80 as double) + cast(o_orderkey % 200 as double) / 100 end as Latitude,
  case when o_orderkey % 25 = 0 then null else cast(c_nationkey * 13 - 160 as double) + cast(o_custkey % 200 as double) / 100 end as Longitude,
  case when o_orderkey % 101 = 0 then null when o_orderkey % 103 = 0 then 1985 else year(o_orderdate) end as StartYear,
  case when o_orderkey % 17 = 0 then null else month(o_orderdate) end as StartMonth,
  case when o_orderkey % 19 = 0 then null else day(o_orderdate) end as StartDay,
  case when o_orderkey % 7 = 0 then null else year(cast(cast(o_orderdate as date) + interval 20 day as date)) end as EndYear,
  case when o_orderkey % 23 = 0 then null else month(cast(cast(o_orderdate as date) + interval 20 day as date)) end as EndMonth,
  case when o_orderkey % 29 = 0 then null else day(cast(cast(o_orderdate as date) + interval 20 day as date)) end as EndDay,
  case when o_orderkey % 10 = 0 then null else cast((o_custkey * 31 + o_orderkey * 7) % 1500 as int) end as TotalDeaths,
  case when o_orderkey % 21 = 0 then null else cast(floor(o_totalprice / 10) as int) end as NoInjured,
  case when o_orderkey % 15 = 0 then null else cast(floor(o_totalprice / (2 + o_orderkey % 2)) as int) end as NoAffected,
  case when o_orderkey % 8 = 0 then null else cast(floor(o_totalprice / 3) as int) end as NoHomeless,
  case when o_orderkey % 9 = 0 then null else cast(floor(o_totalprice) as int) end as TotalAffected,
  case when o_orderkey % 2 = 1 then null else cast(floor(o_totalprice / 10) as bigint) end as TotalDamagesAdj,
  case when o_orderkey % 9 = 1 then cast(floor(o_totalprice / 50) as bigint) else null end as InsuredDamagesAdj,
  case when o_orderkey % 12 = 0 then 1 else 0 end as TsunamiFlag,
  year(o_orderdate) as LoadBatchId
from orders join customer on o_custkey = c_custkey
"""

CTES["master"] = """
select n_nationkey + 2 as CountryDurableKey, concat('N', lpad(cast(n_nationkey as varchar), 2, '0')) as ISO3,
  concat('Q', substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1)) as ISO2,
  n_name as CountryName, r_name as SubRegion, r_name as Region, cast(n_nationkey as double) / 40 as GEM_PGA_g,
  case when n_nationkey < 5 then 'Very Low' when n_nationkey < 10 then 'Low' when n_nationkey < 15 then 'Moderate'
       when n_nationkey < 20 then 'High' else 'Very High' end as GeoSeismicZone
from nation join region on n_regionkey = r_regionkey
union all select 1, 'XIN', null, 'International Waters', 'Ocean', 'Ocean', null, 'Very Low'
"""

CTES["calendar"] = f"""
select {dkey('d')} as DateKey, d as Date, year(d) as Year, quarter(d) as Quarter, month(d) as Month,
  monthname(d) as MonthName, left(monthname(d), 3) as MonthNameShort, day(d) as Day,
  dayofweek(d) + 1 as DayWeek, dayname(d) as DayWeekName, dayofyear(d) as DayYear, weekofyear(d) as WeekYear
from (select cast(t.g as date) as d from generate_series(timestamp '1990-01-01', timestamp '2030-12-31', interval 1 day) t(g)) c
"""

CTES["mag_bands"] = """
select MagnitudeKey, cast(lo as decimal(4,2)) as LowerBound, cast(hi as decimal(4,2)) as UpperBound from (values
 (1, '0.00', '1.99'), (2, '2.00', '2.99'), (3, '3.00', '3.99'), (4, '4.00', '4.99'),
 (5, '5.00', '5.99'), (6, '6.00', '6.99'), (7, '7.00', '7.99'), (8, '8.00', '10.00')) t(MagnitudeKey, lo, hi)
"""
CTES["depth_bands"] = """
select * from (values (1, 0, 70), (2, 70, 300), (3, 300, 700), (4, 700, 9999)) t(SeismicDepthKey, LowerBoundKM, UpperBoundKM)
"""
CTES["deaths_bands"] = """
select * from (values (1, 0, 9), (2, 10, 99), (3, 100, 999), (4, 1000, 2147483647)) t(SeverityDeathsKey, LowerBound, UpperBound)
"""
CTES["affected_bands"] = """
select * from (values (1, 0, 999), (2, 1000, 9999), (3, 10000, 99999), (4, 100000, 2147483647)) t(SeverityAffectedKey, LowerBound, UpperBound)
"""

CTES["codes"] = """
select ISO3 from event_stage where ISO3 is not null union select ISO from disaster_stage where ISO is not null
"""
CTES["incoming"] = """
select distinct CountryDurableKey, ISO3, CountryName, SubRegion, Region, GEM_PGA_g, GeoSeismicZone
from master where ISO3 in (select ISO3 from codes union select 'XIN')
"""
CTES["dim_geo"] = """
select row_number() over (order by CountryDurableKey) as GeographyKey, CountryName, ISO3 as ISO, SubRegion, Region,
  date '2024-01-01' as ValidFrom, cast(null as date) as ValidTo, 1 as IsCurrent, GeoSeismicZone,
  cast(GEM_PGA_g as decimal(4,3)) as GEM_PGA_g, CountryDurableKey
from incoming
"""
CTES["xin_key"] = "select max(GeographyKey) as k from dim_geo where ISO = 'XIN' and IsCurrent = 1"

# Facts in steps of their own: the day, then the member of each dimension, then the measures.
CTES["current_geo"] = "select ISO as code, max(GeographyKey) as geo from dim_geo where IsCurrent = 1 group by ISO"
CTES["event_days"] = "select *, try_cast(left(SrcTime, 10) as date) as day from event_stage"
CTES["event_members"] = """
select StgId,
  (select geo from current_geo where code = ISO3) as geo,
  (select min(MagnitudeKey) from mag_bands where cast(Mag as decimal(4,2)) >= LowerBound and cast(Mag as decimal(4,2)) < UpperBound) as mag_key,
  (select min(SeismicDepthKey) from depth_bands where coalesce(Depth, 0) >= LowerBoundKM and coalesce(Depth, 0) < UpperBoundKM) as deep_key
from event_stage
"""
CTES["seismic_fact"] = f"""
select StgId as SeismicKey, StgId, {dkey('day')} as DateKey, coalesce(geo, (select k from xin_key)) as GeographyKey,
  mag_key as MagnitudeKey, deep_key as SeismicDepthKey,
  Latitude::decimal(8,5) as Latitude, Longitude::decimal(9,5) as Longitude, Mag::decimal(4,2) as Magnitude,
  Depth::decimal(7,2) as SeismicDepth, Mmi::decimal(4,2) as ModifiedMercalliIntensity, Sig as SignificanceScore,
  Cdi::decimal(3,1) as CommunityDecimalIntensity
from event_days join event_members using (StgId)
where day is not null and mag_key is not null and deep_key is not null
"""
CTES["seismic_marks"] = f"""
select StgId from event_stage where try_cast(left(SrcTime, 10) as date) is not null
"""

_START = make_date("e.StartYear", "coalesce(e.StartMonth, 1)", "coalesce(e.StartDay, 1)")
_END = make_date("coalesce(e.EndYear, e.StartYear)", "coalesce(e.EndMonth, e.StartMonth, 1)",
                 "coalesce(e.EndDay, e.StartDay, 1)")

CTES["disaster_dates"] = f"""
select e.*, {_START} as sdate, {_END} as edate from disaster_stage e
"""
CTES["disaster_members"] = """
select StgId,
  (select geo from current_geo where code = ISO) as geo,
  (select min(SeverityDeathsKey) from deaths_bands where coalesce(TotalDeaths, 0) between LowerBound and UpperBound) as deadly,
  (select min(SeverityAffectedKey) from affected_bands where coalesce(TotalAffected, 0) between LowerBound and UpperBound) as wide
from disaster_stage
"""
# of a known total the parts default to 0; of an unknown one they are unknown
CTES["casualties"] = """
select StgId, coalesce(NoInjured, 0) as hurt, coalesce(NoAffected - coalesce(NoInjured, 0) - coalesce(NoHomeless, 0), 0) as rest,
  coalesce(NoHomeless, 0) as homeless
from disaster_stage where TotalAffected is not null
"""
CTES["disaster_fact"] = f"""
select StgId as DisasterKey, StgId, {dkey('sdate')} as StartDate, {dkey('edate')} as EndDate,
  coalesce(geo, (select k from xin_key)) as GeographyKey, coalesce(deadly, 1) as SeverityDeathsKey, coalesce(wide, 1) as SeverityAffectedKey,
  Latitude::decimal(8,5) as Latitude, Longitude::decimal(9,5) as Longitude, date_diff('day', sdate, edate) as DurationDays,
  ifnull(TotalDeaths, 0) as TotalDeaths, TotalAffected, hurt as NumInjuries, rest as NumOtherAffected, homeless as NumHomeless,
  1000 * TotalDamagesAdj as TotalDamageAdj, 1000 * InsuredDamagesAdj as InsuredDamage, TsunamiFlag as Tsunami
from disaster_dates join disaster_members using (StgId) left join casualties using (StgId)
where StartYear between 1900 and 2030 and {dkey('sdate')} in (select DateKey from calendar)
"""
CTES["disaster_marks"] = """
select StgId from disaster_stage where StartYear is not null and StartYear between 1900 and 2030
"""

CTES["bridge"] = f"""
select d.DisasterKey, s.SeismicKey,
  case when d.Latitude is not null and s.Latitude is not null
       then {hv('d.Latitude', 'd.Longitude', 's.Latitude', 's.Longitude')} end as DistanceKM,
  date_diff('day', s.sday, d.dday) as TimeLagDays
from (select *, {key_date('StartDate')} as dday from disaster_fact) d
join (select *, {key_date('DateKey')} as sday from seismic_fact) s
  on s.GeographyKey = d.GeographyKey and s.sday between d.dday - interval 3 day and d.dday
where s.sday between date '1990-01-01' and date '2030-12-31'
  and (d.Latitude is null or {hv('d.Latitude', 'd.Longitude', 's.Latitude', 's.Longitude')} <= 100)
"""


def _deps(body: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
    return [n for n in CTES if n in words]


def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs it (transitively) references."""
    ctes = dict(CTES)
    if extra:
        ctes.update(extra)
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order or name in stack:
            return
        words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", ctes[name]))
        for dep in ctes:
            if dep != name and dep in words:
                visit(dep, stack + (name,))
        order.append(name)

    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
    for n in ctes:
        if n in words:
            visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} as ({ctes[n].strip()})" for n in order)
    return f"with {parts}\n{body.strip()}"
