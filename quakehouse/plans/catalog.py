"""Registered queries: one per operator group of the survey, over the test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose integral
columns are ``bigint`` and fractional ones ``double`` (see :func:`normalize`),
so results compare by value with the SQL oracle in ``queries_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakehouse.operators import bridge as B
from quakehouse.operators import lookups as L
from quakehouse.operators import quality as Q
from quakehouse.plans.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def normalize(df: DataFrame) -> DataFrame:
    """Integral -> bigint, decimal/float -> double, dates/timestamps -> ISO text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def nullable_as_double(df: DataFrame, cols: list[str]) -> DataFrame:
    """Integer measures that can be NULL, emitted as double on both engines.

    Pandas renders a NULL-holding integer column as float64 from Spark but as
    nullable Int64 from DuckDB; as double (exact below 2^53) both agree.
    """
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir)


# ---------------------------------------------------------------- dimensions
@query("dim_date")
def dim_date(spark, sf_dir):
    """Every day of the calendar, with the fact rows that fall on it."""
    w = _wh(spark, sf_dir)
    seismic = w.fact_seismic.groupBy("DateKey").agg(F.count(F.lit(1)).alias("n_seismic"))
    disaster = w.fact_disaster.groupBy(F.col("StartDate").alias("DateKey")).agg(F.count(F.lit(1)).alias("n_disaster"))
    return (w.dim_date.join(seismic, "DateKey", "left").join(disaster, "DateKey", "left")
            .fillna(0, ["n_seismic", "n_disaster"]))


@query("magnitude_band")
def magnitude_band(spark, sf_dir):
    """Half-open magnitude band per staged event (gaps dropped)."""
    w = _wh(spark, sf_dir)
    return L.band_join(w.event_stage, F.col("Mag").cast("decimal(4,2)"), w.mag_bands,
                       "LowerBound", "UpperBound", "MagnitudeKey").select("StgId", "MagnitudeKey")


@query("depth_band")
def depth_band(spark, sf_dir):
    """Depth band (NULL depth as 0, negatives dropped)."""
    w = _wh(spark, sf_dir)
    v = F.coalesce(F.col("Depth"), F.lit(0.0))
    return L.band_join(w.event_stage, v, w.depth_bands, "LowerBoundKM", "UpperBoundKM",
                       "SeismicDepthKey").select("StgId", "SeismicDepthKey")


@query("severity_bands")
def severity_bands(spark, sf_dir):
    """Closed severity bands with default key 1."""
    w = _wh(spark, sf_dir)
    x = L.band_join(w.disaster_stage, F.coalesce(F.col("TotalDeaths"), F.lit(0)), w.deaths_bands,
                    "LowerBound", "UpperBound", "SeverityDeathsKey", closed=True, how="left")
    x = L.band_join(x, F.coalesce(F.col("TotalAffected"), F.lit(0)), w.affected_bands,
                    "LowerBound", "UpperBound", "SeverityAffectedKey", closed=True, how="left")
    return x.select("StgId",
                    F.coalesce("SeverityDeathsKey", F.lit(1)).alias("SeverityDeathsKey"),
                    F.coalesce("SeverityAffectedKey", F.lit(1)).alias("SeverityAffectedKey"))


@query("geo_lookup_fallback")
def geo_lookup_fallback(spark, sf_dir):
    """Current geography key per staged event, sentinel for unknown codes."""
    w = _wh(spark, sf_dir)
    x = L.lookup_current(w.event_stage.select("StgId", "ISO3"), w.dim_geo, on="ISO3")
    return L.with_fallback(x, w.dim_geo).select("StgId", "GeographyKey")


@query("incoming_codes")
def incoming_codes(spark, sf_dir):
    """U-1/J10/A9/U2: master rows of all staged codes (plus the sentinel)."""
    return _wh(spark, sf_dir).incoming


@query("scd2_new")
def scd2_new(spark, sf_dir):
    """U1 first load: every incoming country becomes a current row."""
    return _wh(spark, sf_dir).dim_geo_plan


# ---------------------------------------------------------------- facts and bridge
@query("fact_seismic")
def fact_seismic(spark, sf_dir):
    """Seismic fact rows."""
    return _wh(spark, sf_dir).fact_seismic_plan


@query("fact_disaster")
def fact_disaster(spark, sf_dir):
    """Disaster fact rows."""
    return nullable_as_double(_wh(spark, sf_dir).fact_disaster_plan, DISASTER_NULLABLE)


DISASTER_NULLABLE = ["EndDate", "DurationDays", "TotalAffected", "NumInjuries", "NumOtherAffected",
                     "NumHomeless", "TotalDamageAdj", "InsuredDamage"]


@query("bridge")
def bridge(spark, sf_dir):
    """Disaster <-> event links within 100 km and 3 days."""
    return _wh(spark, sf_dir)._links(distance="double")


@query("bridge_unmatched")
def bridge_unmatched(spark, sf_dir):
    """Disasters without any link."""
    w = _wh(spark, sf_dir)
    return B.without_links(w.fact_disaster, w.bridge).select("DisasterKey")


# ---------------------------------------------------------------- profiling
@query("top_countries_count")
def top_countries_count(spark, sf_dir):
    """Ten countries with the most seismic fact rows (sentinel excluded)."""
    w = _wh(spark, sf_dir)
    return Q.top_countries(w.fact_seismic, w.dim_geo, n=10)
