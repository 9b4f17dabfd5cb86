"""DuckDB oracle SQL for each registered query (same column names and types)."""

from __future__ import annotations

from quakehouse.plans.oracle import sql

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, extra: dict[str, str] | None = None) -> None:
    ORACLE[name] = sql(body, extra)


# ---------------------------------------------------------------- dimensions
oracle("dim_date", """
select cast(DateKey as bigint) as DateKey, strftime(Date, '%Y-%m-%d') as Date, cast(Year as bigint) as Year, cast(Quarter as bigint) as Quarter,
  cast(Month as bigint) as Month, MonthName, MonthNameShort, cast(Day as bigint) as Day,
  cast(DayWeek as bigint) as DayWeek, DayWeekName, cast(DayYear as bigint) as DayYear, cast(WeekYear as bigint) as WeekYear,
  (select count(*) from seismic_fact f where f.DateKey = c.DateKey) as n_seismic,
  (select count(*) from disaster_fact f where f.StartDate = c.DateKey) as n_disaster
from calendar c
""")

oracle("magnitude_band", """
select cast(s.StgId as bigint) as StgId, cast(m.MagnitudeKey as bigint) as MagnitudeKey
from event_stage s join mag_bands m on cast(s.Mag as decimal(4,2)) >= m.LowerBound and cast(s.Mag as decimal(4,2)) < m.UpperBound
""")

oracle("depth_band", """
select cast(s.StgId as bigint) as StgId, cast(d.SeismicDepthKey as bigint) as SeismicDepthKey
from event_stage s join depth_bands d on coalesce(s.Depth, 0) >= d.LowerBoundKM and coalesce(s.Depth, 0) < d.UpperBoundKM
""")

oracle("severity_bands", """
select cast(e.StgId as bigint) as StgId, cast(coalesce(sd.SeverityDeathsKey, 1) as bigint) as SeverityDeathsKey,
  cast(coalesce(sa.SeverityAffectedKey, 1) as bigint) as SeverityAffectedKey
from disaster_stage e
left join deaths_bands sd on coalesce(e.TotalDeaths, 0) >= sd.LowerBound and coalesce(e.TotalDeaths, 0) <= sd.UpperBound
left join affected_bands sa on coalesce(e.TotalAffected, 0) >= sa.LowerBound and coalesce(e.TotalAffected, 0) <= sa.UpperBound
""")

oracle("geo_lookup_fallback", """
select cast(s.StgId as bigint) as StgId, cast(coalesce(g.GeographyKey, (select k from xin_key)) as bigint) as GeographyKey
from event_stage s left join dim_geo g on g.ISO = s.ISO3 and g.IsCurrent = 1
""")

oracle("incoming_codes", """
select cast(CountryDurableKey as bigint) as CountryDurableKey, ISO3, CountryName, SubRegion, Region,
  cast(GEM_PGA_g as double) as GEM_PGA_g, GeoSeismicZone
from incoming
""")

_GEO_OUT = """cast(GeographyKey as bigint) as GeographyKey, CountryName, ISO, SubRegion, Region,
  strftime(ValidFrom, '%Y-%m-%d') as ValidFrom, strftime(ValidTo, '%Y-%m-%d') as ValidTo,
  cast(IsCurrent as bigint) as IsCurrent, GeoSeismicZone, cast(GEM_PGA_g as double) as GEM_PGA_g,
  cast(CountryDurableKey as bigint) as CountryDurableKey"""

oracle("scd2_new", f"select {_GEO_OUT} from dim_geo")

# ---------------------------------------------------------------- facts and bridge
SEISMIC_OUT = """cast(SeismicKey as bigint) as SeismicKey, cast(StgId as bigint) as StgId, cast(DateKey as bigint) as DateKey,
  cast(GeographyKey as bigint) as GeographyKey, cast(MagnitudeKey as bigint) as MagnitudeKey,
  cast(SeismicDepthKey as bigint) as SeismicDepthKey, cast(Latitude as double) as Latitude,
  cast(Longitude as double) as Longitude, cast(Magnitude as double) as Magnitude,
  cast(SeismicDepth as double) as SeismicDepth, cast(ModifiedMercalliIntensity as double) as ModifiedMercalliIntensity,
  cast(SignificanceScore as bigint) as SignificanceScore, cast(CommunityDecimalIntensity as double) as CommunityDecimalIntensity"""

DISASTER_OUT = """cast(DisasterKey as bigint) as DisasterKey, cast(StgId as bigint) as StgId, cast(StartDate as bigint) as StartDate,
  cast(EndDate as double) as EndDate, cast(GeographyKey as bigint) as GeographyKey,
  cast(SeverityDeathsKey as bigint) as SeverityDeathsKey, cast(SeverityAffectedKey as bigint) as SeverityAffectedKey,
  cast(Latitude as double) as Latitude, cast(Longitude as double) as Longitude, cast(DurationDays as double) as DurationDays,
  cast(TotalDeaths as bigint) as TotalDeaths, cast(TotalAffected as double) as TotalAffected,
  cast(NumInjuries as double) as NumInjuries, cast(NumOtherAffected as double) as NumOtherAffected,
  cast(NumHomeless as double) as NumHomeless, cast(TotalDamageAdj as double) as TotalDamageAdj,
  cast(InsuredDamage as double) as InsuredDamage, cast(Tsunami as bigint) as Tsunami"""

BRIDGE_OUT = """cast(DisasterKey as bigint) as DisasterKey, cast(SeismicKey as bigint) as SeismicKey,
  cast(DistanceKM as double) as DistanceKM, cast(TimeLagDays as bigint) as TimeLagDays"""

oracle("fact_seismic", f"select {SEISMIC_OUT} from seismic_fact")
oracle("fact_disaster", f"select {DISASTER_OUT} from disaster_fact")
oracle("bridge", f"select {BRIDGE_OUT} from bridge")
oracle("bridge_unmatched", """
select cast(DisasterKey as bigint) as DisasterKey from disaster_fact
where DisasterKey not in (select DisasterKey from bridge)
""")

# ---------------------------------------------------------------- profiling
oracle("top_countries_count", """
select CountryName, cast(sum(k) as bigint) as n
from (select GeographyKey, count(*) as k from seismic_fact group by GeographyKey) per_key join dim_geo using (GeographyKey)
where ISO <> 'XIN' group by CountryName order by 2 desc, 1 limit 10
""")
