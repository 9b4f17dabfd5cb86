"""Registered data-quality queries (Q1-Q12) with their DuckDB oracle SQL."""

from __future__ import annotations

from quakehouse.operators import quality as Q
from quakehouse.plans import fixtures as FX
from quakehouse.plans.catalog import _wh, query
from quakehouse.plans.oracle import key_date
from quakehouse.plans.queries_sql import oracle

SEIS_ATTRS = ["Latitude", "Longitude", "Magnitude", "SeismicDepth",
              "ModifiedMercalliIntensity", "SignificanceScore", "CommunityDecimalIntensity"]
DIS_ATTRS = ["Latitude", "Longitude", "DurationDays", "TotalDeaths", "TotalAffected", "NumInjuries",
             "NumOtherAffected", "NumHomeless", "TotalDamageAdj", "InsuredDamage", "Tsunami"]
SEIS_NOT_NULL = ["SeismicKey", "DateKey", "GeographyKey", "MagnitudeKey", "SeismicDepthKey",
                 "Latitude", "Longitude", "Magnitude", "SeismicDepth"]
DIS_NOT_NULL = ["DisasterKey", "StartDate", "EndDate", "GeographyKey", "SeverityDeathsKey",
                "SeverityAffectedKey", "Tsunami"]
SEIS_RULES_SQL = {
    "magnitude in [0, 10]": "Magnitude < 0 or Magnitude > 10",
    "latitude in [-90, 90]": "Latitude < -90 or Latitude > 90",
    "longitude in [-180, 180]": "Longitude < -180 or Longitude > 180",
}
DIS_RULES_SQL = {
    "EndDate >= StartDate": "EndDate < StartDate",
    "TotalDeaths >= 0": "TotalDeaths < 0",
    "NumOtherAffected >= 0": "NumOtherAffected < 0",
}
OTHER_TABLES_SQL = {
    "BridgeDisasterSeismic": "bridge", "DimGeography": "dim_geo", "DimDate": "calendar",
    "DimMagnitude": "mag_bands", "DimSeismicDepth": "depth_bands",
    "DimSeverityDeaths": "deaths_bands", "DimSeverityAffected": "affected_bands",
}
FACTS_SQL = {"FactSeismic": "seismic_fact", "FactDisaster": "disaster_fact"}


def _band_sql(x: str) -> str:
    return (f"case when {x} >= 95 then 'green' when {x} >= 50 then 'amber' "
            f"when {x} is not null then 'red' end")


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


@query("row_counts")
def row_counts(spark, sf_dir):
    """Q1/A1: row count per warehouse table."""
    return Q.row_counts(_wh(spark, sf_dir).tables())


oracle("row_counts", _union(
    [f"select '{n}' as table_name, cast(count(*) as bigint) as row_count from {t}"
     for n, t in {**FACTS_SQL, **OTHER_TABLES_SQL}.items()]))


@query("coverage")
def coverage(spark, sf_dir):
    """Q3/A2: first and last date of each fact."""
    w = _wh(spark, sf_dir)
    return (Q.coverage(w.fact_seismic, "DateKey", "FactSeismic")
            .unionByName(Q.coverage(w.fact_disaster, "StartDate", "FactDisaster")))


oracle("coverage", _union([
    f"select '{n}' as table_name, strftime({key_date(f'min({k})')}, '%Y-%m-%d') as min_date, "
    f"strftime({key_date(f'max({k})')}, '%Y-%m-%d') as max_date from {t}"
    for n, t, k in (("FactSeismic", "seismic_fact", "DateKey"), ("FactDisaster", "disaster_fact", "StartDate"))]))


@query("completeness")
def completeness(spark, sf_dir):
    """Fill percentage of every attribute column of both facts."""
    w = _wh(spark, sf_dir)
    return (Q.completeness(w.fact_seismic, "FactSeismic")
            .unionByName(Q.completeness(w.fact_disaster, "FactDisaster")))


def _fill_sql(table: str, name: str, cols: list[str]) -> list[str]:
    pct = "cast(100.0 as double) * count({c}) / nullif(count(*), 0)"
    return [f"select '{name}' as table_name, '{c}' as column_name, {pct.format(c=c)} as fill_pct, "
            f"{_band_sql(pct.format(c=c))} as status from {table}" for c in cols]


oracle("completeness", _union(_fill_sql("seismic_fact", "FactSeismic", SEIS_ATTRS)
                              + _fill_sql("disaster_fact", "FactDisaster", DIS_ATTRS)))


@query("validity")
def validity(spark, sf_dir):
    """Range rules with violation counts and PASS/FAIL, one scan per fact."""
    w = _wh(spark, sf_dir)
    return Q.validity(w.fact_seismic, w.fact_disaster)


def _rules_sql(table: str, name: str, rules: dict[str, str]) -> list[str]:
    return [f"select '{name}' as table_name, '{r}' as rule, cast(count(*) filter (where {cond}) as bigint) as violations, "
            f"case when count(*) filter (where {cond}) = 0 then 'PASS' else 'FAIL' end as status from {table}"
            for r, cond in rules.items()]


oracle("validity", _union(_rules_sql("seismic_fact", "FactSeismic", SEIS_RULES_SQL)
                          + _rules_sql("disaster_fact", "FactDisaster", DIS_RULES_SQL)))

FK_LIST = [
    ("FactSeismic", "DateKey", "DimDate", "DateKey"),
    ("FactSeismic", "GeographyKey", "DimGeography", "GeographyKey"),
    ("FactSeismic", "MagnitudeKey", "DimMagnitude", "MagnitudeKey"),
    ("FactSeismic", "SeismicDepthKey", "DimSeismicDepth", "SeismicDepthKey"),
    ("FactDisaster", "StartDate", "DimDate", "DateKey"),
    ("FactDisaster", "EndDate", "DimDate", "DateKey"),
    ("FactDisaster", "GeographyKey", "DimGeography", "GeographyKey"),
    ("FactDisaster", "SeverityDeathsKey", "DimSeverityDeaths", "SeverityDeathsKey"),
    ("FactDisaster", "SeverityAffectedKey", "DimSeverityAffected", "SeverityAffectedKey"),
    ("BridgeDisasterSeismic", "DisasterKey", "FactDisaster", "DisasterKey"),
    ("BridgeDisasterSeismic", "SeismicKey", "FactSeismic", "SeismicKey"),
]


@query("fk_violations")
def fk_violations(spark, sf_dir):
    """Q9: foreign-key violations of the facts and the bridge (constraints re-aimed as checks)."""
    return Q.all_fk_violations(_wh(spark, sf_dir).tables(), FK_LIST)


_SQL_NAMES = {**FACTS_SQL, **OTHER_TABLES_SQL}
oracle("fk_violations", _union([
    f"select '{fact}' as table_name, '{fk}' as fk_column, cast(count(*) as bigint) as violations from {_SQL_NAMES[fact]} "
    f"where {fk} is not null and {fk} not in (select {pk} from {_SQL_NAMES[dim]})"
    for fact, fk, dim, pk in FK_LIST]))

PK_LIST = [("FactSeismic", ["SeismicKey"]), ("FactDisaster", ["DisasterKey"]),
           ("BridgeDisasterSeismic", ["DisasterKey", "SeismicKey"]),
           ("DimGeography", ["GeographyKey"]), ("DimDate", ["DateKey"]),
           ("DimMagnitude", ["MagnitudeKey"]), ("DimSeismicDepth", ["SeismicDepthKey"]),
           ("DimSeverityDeaths", ["SeverityDeathsKey"]), ("DimSeverityAffected", ["SeverityAffectedKey"]),
           ("CountryMaster", ["CountryDurableKey"]), ("CountryMaster", ["ISO3"])]


_PK_NAMES = {**_SQL_NAMES, "CountryMaster": "master"}


@query("pk_violations")
def pk_violations(spark, sf_dir):
    """Duplicate primary keys of the nine tables, and the country master's two unique keys."""
    w = _wh(spark, sf_dir)
    return Q.all_pk_violations({**w.tables(), "CountryMaster": w.master}, PK_LIST)


oracle("pk_violations", _union([
    f"select '{name}' as table_name, '{','.join(keys)}' as key_columns, cast(count(*) as bigint) as dup_groups, "
    f"cast(coalesce(sum(n), 0) as bigint) as dup_rows from "
    f"(select count(*) as n from {_PK_NAMES[name]} group by {', '.join(keys)} having count(*) > 1) x"
    for name, keys in PK_LIST]))


@query("null_violations")
def null_violations(spark, sf_dir):
    """Q11: NULLs in NOT NULL columns of the facts."""
    w = _wh(spark, sf_dir)
    return (Q.null_violations(w.fact_seismic, SEIS_NOT_NULL, "FactSeismic")
            .unionByName(Q.null_violations(w.fact_disaster, DIS_NOT_NULL, "FactDisaster")))


oracle("null_violations", _union(
    _rules_sql("seismic_fact", "FactSeismic", {c: f"{c} is null" for c in SEIS_NOT_NULL})
    + _rules_sql("disaster_fact", "FactDisaster", {c: f"{c} is null" for c in DIS_NOT_NULL})
).replace("as rule,", "as column_name,"))


@query("geo_resolution")
def geo_resolution(spark, sf_dir):
    """Q5/U-2/A13: fact rows on real countries vs the sentinel, with shares."""
    w = _wh(spark, sf_dir)
    return Q.geo_resolution({"FactSeismic": w.fact_seismic, "FactDisaster": w.fact_disaster}, w.dim_geo)


oracle("geo_resolution", """
select src, is_xin, cast(sum(k) as bigint) as n, sum(k) / any_value(total) as share
from (select 'FactSeismic' as src, GeographyKey, count(*) as k, (select count(*) from seismic_fact) as total from seismic_fact group by GeographyKey
      union all
      select 'FactDisaster', GeographyKey, count(*), (select count(*) from disaster_fact) from disaster_fact group by GeographyKey) per_key
join (select GeographyKey, cast(ISO = 'XIN' as bigint) as is_xin from dim_geo) flag using (GeographyKey)
group by src, is_xin
""")


@query("flag_share")
def flag_share(spark, sf_dir):
    """Tsunami flag counts and shares."""
    return Q.flag_share(_wh(spark, sf_dir).fact_disaster, "Tsunami")


oracle("flag_share", """
select cast(Tsunami as bigint) as flag, cast(count(*) as bigint) as n,
  count(*) / (select count(*) from disaster_fact) as share
from disaster_fact group by Tsunami
""")


@query("bridge_coverage")
def bridge_coverage(spark, sf_dir):
    """Disasters per links-count bucket (0, 1, 2-5, 6-10, >10), empty buckets as 0."""
    w = _wh(spark, sf_dir)
    return Q.bridge_coverage(w.fact_disaster, w.bridge)


oracle("bridge_coverage", """
select cast(b.o as bigint) as bucket_order, b.bucket, cast(coalesce(c.k, 0) as bigint) as n_disasters
from (values (0, '0'), (1, '1'), (2, '2-5'), (3, '6-10'), (4, '>10')) b(o, bucket)
left join (
  select case when n <= 0 then '0' when n <= 1 then '1' when n <= 5 then '2-5' when n <= 10 then '6-10' else '>10' end as bucket,
    count(*) as k
  from (select d.DisasterKey, count(l.SeismicKey) as n from disaster_fact d
        left join bridge l on l.DisasterKey = d.DisasterKey group by d.DisasterKey) x
  group by 1) c on c.bucket = b.bucket
""")


@query("duplicate_groups")
def duplicate_groups(spark, sf_dir):
    """Duplicate business ids in both stagings and in the events table."""
    w = _wh(spark, sf_dir)
    ev = FX.table(spark, sf_dir, "events")
    out = None
    for name, df, key in (("event_stage", w.event_stage, "EventId"),
                          ("disaster_stage", w.disaster_stage, "DisNo"),
                          ("events", ev, "event_id")):
        one = Q.pk_violations(df, [key], name)
        out = one if out is None else out.unionByName(one)
    return out


oracle("duplicate_groups", _union([
    f"select '{name}' as table_name, '{key}' as key_columns, cast(count(*) as bigint) as dup_groups, "
    f"cast(coalesce(sum(n), 0) as bigint) as dup_rows from "
    f"(select count(*) as n from {t} group by {key} having count(*) > 1) x"
    for name, t, key in (("event_stage", "event_stage", "EventId"),
                         ("disaster_stage", "disaster_stage", "DisNo"), ("events", "events", "event_id"))]))


@query("magnitude_histogram")
def magnitude_histogram(spark, sf_dir):
    """30 equal-width magnitude bins, last bin closed, empty bins kept."""
    return Q.histogram(_wh(spark, sf_dir).fact_seismic, "Magnitude")


oracle("magnitude_histogram", """
select cast(b.bin as bigint) as bin, s.mn + (s.mx - s.mn) * b.bin / cast(30 as double) as lo,
  cast(coalesce(c.n, 0) as bigint) as n
from range(30) b(bin)
cross join (select min(cast(Magnitude as double)) as mn, max(cast(Magnitude as double)) as mx from seismic_fact) s
left join (
  select case when mx = mn then 0 else least(floor((v - mn) * cast(30 as double) / (mx - mn)), 29) end as bin, count(*) as n
  from (select cast(Magnitude as double) as v from seismic_fact where Magnitude is not null) f,
       (select min(cast(Magnitude as double)) as mn, max(cast(Magnitude as double)) as mx from seismic_fact) m
  group by 1) c on c.bin = b.bin
""")


@query("per_year")
def per_year(spark, sf_dir):
    """Seismic fact rows per calendar year."""
    w = _wh(spark, sf_dir)
    return Q.per_year(w.fact_seismic, w.dim_date)


oracle("per_year", """
select cast(c.Year as bigint) as yr, cast(count(*) as bigint) as n
from seismic_fact f join calendar c on c.DateKey = f.DateKey group by c.Year
""")


@query("top_countries_sum")
def top_countries_sum(spark, sf_dir):
    """Ten countries with the most deaths (sentinel excluded)."""
    w = _wh(spark, sf_dir)
    return Q.top_countries(w.fact_disaster, w.dim_geo, n=10, measure="TotalDeaths")


oracle("top_countries_sum", """
select CountryName, cast(sum(k) as bigint) as deaths
from (select GeographyKey, sum(TotalDeaths) as k from disaster_fact group by GeographyKey) per_key join dim_geo using (GeographyKey)
where ISO <> 'XIN' group by CountryName having sum(k) is not null
order by 2 desc, 1 limit 10
""")


@query("quality_metrics")
def quality_metrics(spark, sf_dir):
    """Q12: every check of the report as one long (section, check, subject, value, status) table."""
    w = _wh(spark, sf_dir)
    return Q.quality_metrics({**w.tables(), "CountryMaster": w.master},
                             {"event_stage": (w.event_stage, "EventId"), "disaster_stage": (w.disaster_stage, "DisNo")},
                             fks=FK_LIST, pks=PK_LIST)


def _profile_sql(table: str, name: str, attrs: list[str], rules: dict[str, str], nn: list[str]) -> list[str]:
    head = "select '{s}' as section, '{c}' as check_name, '" + name + "' as subject, cast({v} as double) as value, {st} as status from " + table
    out = [head.format(s="counts", c="rows", v="count(*)", st="cast(null as varchar)")]
    for c in attrs:
        pct = f"cast(100.0 as double) * count({c}) / nullif(count(*), 0)"
        out.append(head.format(s="completeness", c=c, v=pct, st=_band_sql(pct)))
    for r, cond in rules.items():
        v = f"count(*) filter (where {cond})"
        out.append(head.format(s="validity", c=r, v=v, st=f"case when {v} = 0 then 'PASS' else 'FAIL' end"))
    for c in nn:
        v = f"count(*) filter (where {c} is null)"
        out.append(head.format(s="not_null", c=c, v=v, st=f"case when {v} = 0 then 'PASS' else 'FAIL' end"))
    return out


_QM_PARTS = (
    _profile_sql("seismic_fact", "FactSeismic", SEIS_ATTRS, SEIS_RULES_SQL, SEIS_NOT_NULL)
    + _profile_sql("disaster_fact", "FactDisaster", DIS_ATTRS, DIS_RULES_SQL, DIS_NOT_NULL)
    + [f"select 'counts', 'rows', '{n}', cast(count(*) as double), cast(null as varchar) from {t}"
       for n, t in {**OTHER_TABLES_SQL, "CountryMaster": "master"}.items()]
    + ["""select 'integrity', 'sentinel_share', src,
  cast(sum(case when ISO = 'XIN' then 1 else 0 end) as double) / nullif(count(*), 0), cast(null as varchar) from (
    select 'FactSeismic' as src, g.ISO from seismic_fact f join dim_geo g on g.GeographyKey = f.GeographyKey
    union all
    select 'FactDisaster' as src, g.ISO from disaster_fact f join dim_geo g on g.GeographyKey = f.GeographyKey) x
  group by src""",
       """select 'integrity', concat('links_', b.bucket), 'BridgeDisasterSeismic', cast(coalesce(c.k, 0) as double), cast(null as varchar)
from (values ('0'), ('1'), ('2-5'), ('6-10'), ('>10')) b(bucket)
left join (
  select case when n <= 0 then '0' when n <= 1 then '1' when n <= 5 then '2-5' when n <= 10 then '6-10' else '>10' end as bucket,
    count(*) as k
  from (select d.DisasterKey, count(l.SeismicKey) as n from disaster_fact d
        left join bridge l on l.DisasterKey = d.DisasterKey group by d.DisasterKey) x
  group by 1) c on c.bucket = b.bucket"""]
    + [f"""select 'uniqueness', 'duplicate_{key}', '{name}', cast(count(*) as double),
  case when count(*) = 0 then 'PASS' else 'FAIL' end
from (select {key} from {name} group by {key} having count(*) > 1) x"""
       for name, key in (("event_stage", "EventId"), ("disaster_stage", "DisNo"))]
    + ["""select 'integrity', 'scd2_multiple_current', 'DimGeography', cast(count(*) filter (where c > 1) as double),
  case when count(*) filter (where c > 1) = 0 then 'PASS' else 'FAIL' end
from (select CountryDurableKey, sum(IsCurrent) as c from dim_geo group by CountryDurableKey) x""",
       """select 'integrity', 'scd2_valid_to_before_from', 'DimGeography',
  cast(count(*) filter (where ValidTo < ValidFrom) as double),
  case when count(*) filter (where ValidTo < ValidFrom) = 0 then 'PASS' else 'FAIL' end from dim_geo"""]
    + ["""select 'profile', 'tsunami_share', 'FactDisaster', cast(count(*) filter (where Tsunami = 1) as double) / count(*),
  cast(null as varchar) from disaster_fact"""]
)
_NONE = "cast(null as varchar)"
_QM_PARTS += [f"select 'coverage', '{check}', '{name}', cast({f}({date}) as double), {_NONE} from {t}"
              for name, t, date in (("FactSeismic", "seismic_fact", "DateKey"), ("FactDisaster", "disaster_fact", "StartDate"))
              for check, f in (("first_date_key", "min"), ("last_date_key", "max"))]
_QM_PARTS += [f"""select 'per_year', cast(c.Year as varchar), '{name}', cast(count(*) as double), {_NONE}
from calendar c join {t} f on f.{date} = c.DateKey group by c.Year"""
              for name, t, date in (("FactSeismic", "seismic_fact", "DateKey"), ("FactDisaster", "disaster_fact", "StartDate"))]
_QM_PARTS += [f"""select * from (select 'ranking', concat('{check} ', CountryName), '{name}', v, {_NONE} from (
  select CountryName, cast(sum(k) as double) as v from (select GeographyKey, {what} as k from {t} group by GeographyKey) per_key
  join dim_geo using (GeographyKey) where ISO <> 'XIN' group by CountryName) named
where v is not null order by v desc, CountryName limit 10)"""
              for name, t, what, check in (("FactSeismic", "seismic_fact", "count(*)", "top_rows"),
                                           ("FactDisaster", "disaster_fact", "sum(TotalDeaths)", "top_deaths"))]
_QM_PARTS += [f"""select 'histogram', concat('magnitude_bin_', cast(b.bin as varchar)), 'FactSeismic', cast(count(f.v) as double), {_NONE}
from range(30) b(bin) left join (
  select least(floor((v - mn) * 30.0::double / (mx - mn)), 29) as bin, v
  from (select cast(Magnitude as double) as v, min(cast(Magnitude as double)) over () as mn, max(cast(Magnitude as double)) over () as mx
        from seismic_fact) m) f on f.bin = b.bin group by b.bin"""]
_QM_PARTS += [f"""select 'foreign_key', '{fk}', '{fact}', cast(count(*) as double), case when count(*) = 0 then 'PASS' else 'FAIL' end
from {_SQL_NAMES[fact]} where {fk} is not null and {fk} not in (select {pk} from {_SQL_NAMES[dim]})""" for fact, fk, dim, pk in FK_LIST]
_QM_PARTS += [f"""select 'unique_key', '{','.join(keys)}', '{name}', cast(count(*) as double), case when count(*) = 0 then 'PASS' else 'FAIL' end
from (select 1 from {_PK_NAMES[name]} group by {', '.join(keys)} having count(*) > 1) x""" for name, keys in PK_LIST]
oracle("quality_metrics", _union(_QM_PARTS))
