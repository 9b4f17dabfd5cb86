"""Dimensions: calendar (D1), band tables (S7), country dimension with SCD2."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakehouse.functions.columns import SENTINEL_ISO, date_key
from quakehouse.operators.keys import assign_keys, next_key_start
from quakehouse.session import materialize

# ---------------------------------------------------------------- fixed values
# Calendar range of the warehouse.
CALENDAR_START = _dt.date(1990, 1, 1)
CALENDAR_END = _dt.date(2030, 12, 31)

# Band dimensions, as seeded by the warehouse (key, code/name, lower, upper, ...).
MAGNITUDE_BANDS = [
    (1, "M0-2", "Micro", "0.00", "1.99", "Mw"),
    (2, "M2-3", "Minor", "2.00", "2.99", "Mw"),
    (3, "M3-4", "Light", "3.00", "3.99", "Mw"),
    (4, "M4-5", "Moderate", "4.00", "4.99", "Mw"),
    (5, "M5-6", "Strong", "5.00", "5.99", "Mw"),
    (6, "M6-7", "Major", "6.00", "6.99", "Mw"),
    (7, "M7-8", "Great", "7.00", "7.99", "Mw"),
    (8, "M8+", "Mega", "8.00", "10.00", "Mw"),
]
DEPTH_BANDS = [
    (1, "Shallow", 0, 70),
    (2, "Intermediate", 70, 300),
    (3, "Deep", 300, 700),
    (4, "Ultra-deep", 700, 9999),
]
DEATHS_BANDS = [
    (1, "Minimal", 0, 9),
    (2, "Limited", 10, 99),
    (3, "Severe", 100, 999),
    (4, "Catastrophic", 1000, 2147483647),
]
AFFECTED_BANDS = [
    (1, "Minor", 0, 999),
    (2, "Moderate", 1000, 9999),
    (3, "Major", 10000, 99999),
    (4, "Massive", 100000, 2147483647),
]

GEO_COLUMNS = ["GeographyKey", "CountryName", "ISO", "SubRegion", "Region", "ValidFrom",
               "ValidTo", "IsCurrent", "GeoSeismicZone", "GEM_PGA_g", "CountryDurableKey"]

DIM_GEOGRAPHY_SCHEMA = T.StructType([
    T.StructField("GeographyKey", T.LongType(), False),
    T.StructField("CountryName", T.StringType(), False),
    T.StructField("ISO", T.StringType(), False),
    T.StructField("SubRegion", T.StringType(), True),
    T.StructField("Region", T.StringType(), True),
    T.StructField("ValidFrom", T.DateType(), False),
    T.StructField("ValidTo", T.DateType(), True),
    T.StructField("IsCurrent", T.IntegerType(), False),
    T.StructField("GeoSeismicZone", T.StringType(), True),
    T.StructField("GEM_PGA_g", T.DecimalType(4, 3), True),
    T.StructField("CountryDurableKey", T.LongType(), False),
])

MASTER_COLUMNS = ["CountryDurableKey", "ISO3", "CountryName", "SubRegion", "Region",
                  "GEM_PGA_g", "GeoSeismicZone"]


# ---------------------------------------------------------------- calendar
def dim_date(spark: SparkSession, start: _dt.date = CALENDAR_START,
             end: _dt.date = CALENDAR_END) -> DataFrame:
    """One row per day in [start, end] with the calendar attributes.

    Generated with ``spark.range`` so the rows are produced in parallel; names
    are English (Spark's formatter locale), weekday 1 = Sunday, ISO week.
    """
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    base = spark.range(days).select(d.alias("Date"))
    return base.select(
        date_key("Date").alias("DateKey"),
        "Date",
        F.year("Date").alias("Year"),
        F.quarter("Date").alias("Quarter"),
        F.month("Date").alias("Month"),
        F.date_format("Date", "MMMM").alias("MonthName"),
        F.substring(F.date_format("Date", "MMMM"), 1, 3).alias("MonthNameShort"),
        F.dayofmonth("Date").alias("Day"),
        F.dayofweek("Date").alias("DayWeek"),
        F.date_format("Date", "EEEE").alias("DayWeekName"),
        F.dayofyear("Date").alias("DayYear"),
        F.weekofyear("Date").alias("WeekYear"),
    )


# ---------------------------------------------------------------- band tables
def magnitude_bands(spark: SparkSession) -> DataFrame:
    rows = [(k, c, n, lo, hi, s) for k, c, n, lo, hi, s in MAGNITUDE_BANDS]
    df = spark.createDataFrame(rows, "MagnitudeKey int, BandCode string, BandName string, "
                                     "lo string, hi string, MagScale string")
    return df.select("MagnitudeKey", "BandCode", "BandName",
                     F.col("lo").cast("decimal(4,2)").alias("LowerBound"),
                     F.col("hi").cast("decimal(4,2)").alias("UpperBound"), "MagScale")


def depth_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEPTH_BANDS, "SeismicDepthKey int, BandName string, "
                                              "LowerBoundKM int, UpperBoundKM int")


def deaths_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEATHS_BANDS, "SeverityDeathsKey int, SeverityCode string, "
                                               "LowerBound int, UpperBound int")


def affected_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AFFECTED_BANDS, "SeverityAffectedKey int, SeverityCode string, "
                                                 "LowerBound int, UpperBound int")


# ---------------------------------------------------------------- country dimension
def empty_geography(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_GEOGRAPHY_SCHEMA)


def staged_codes(*code_columns: DataFrame) -> DataFrame:
    """U-1: distinct union of single-column code frames, trimmed and in upper case as the lookup compares them (NULL codes dropped)."""
    frames = [df.select(F.upper(F.trim(F.col(df.columns[0]).cast("string"))).alias("ISO3")) for df in code_columns]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.filter(F.col("ISO3").isNotNull()).distinct()


def known_countries(codes: DataFrame, master: DataFrame) -> DataFrame:
    """Codes that exist in the country master, with the master attributes."""
    wanted = codes.select(F.upper(F.trim("ISO3")).alias("__code"))
    return master.select(*MASTER_COLUMNS).join(wanted, F.upper(F.trim("ISO3")) == F.col("__code"), "left_semi")


def incoming_countries(codes: DataFrame, master: DataFrame, ensure_sentinel: bool = True,
                       sentinel: str = SENTINEL_ISO) -> DataFrame:
    """The master rows referenced by staged codes (plus the sentinel, Q-7)."""
    if ensure_sentinel:
        spark = codes.sparkSession
        codes = codes.unionByName(spark.createDataFrame([(sentinel,)], "ISO3 string"))
    return known_countries(codes.distinct(), master).distinct()


def scd2_apply(dim: DataFrame, incoming: DataFrame, as_of: _dt.date | str,
               key: str = "CountryDurableKey", tracked: Sequence[str] = ("CountryName",),
               surrogate: str = "GeographyKey") -> DataFrame:
    """One-pass SCD2 transition of the country dimension.

    * durable key unknown to ``dim``         -> new current row (ValidFrom = as_of)
    * current row whose tracked value differs -> closed (ValidTo = as_of - 1) and a
      new current version opened with the incoming attributes
    * otherwise                                -> unchanged (other attributes are
      not updated, as in the source)

    New surrogate keys continue after the current maximum (inserts first, then
    new versions, each by durable key).
    """
    as_of_col = F.to_date(F.lit(str(as_of)))
    inc = incoming.select(
        F.col(key).cast("bigint").alias(key), F.col("ISO3").alias("ISO"), "CountryName",
        "SubRegion", "Region", "GeoSeismicZone",
        F.col("GEM_PGA_g").cast("decimal(4,3)").alias("GEM_PGA_g"))
    # the incoming set is bounded (one row per country of the reference list) and
    # is used three times below: materialize it once in the shared checkpoint folder
    inc = materialize(inc, "scd2_incoming")
    cur = dim.filter(F.col("IsCurrent") == 1)
    known = dim.select(key).distinct()

    changed_cond = None
    for t in tracked:
        c = ~F.col(f"inc.{t}").eqNullSafe(F.col(f"cur.{t}"))
        changed_cond = c if changed_cond is None else (changed_cond | c)
    changed_keys = (inc.alias("inc").join(cur.alias("cur"), key)
                    .filter(changed_cond).select(key))

    new_rows = inc.join(known, key, "left_anti").withColumn("__phase", F.lit(0))
    versions = inc.join(changed_keys, key, "left_semi").withColumn("__phase", F.lit(1))
    opened = new_rows.unionByName(versions)

    start = next_key_start(dim, surrogate)
    opened = assign_keys(opened, ["__phase", key], name=surrogate, start=start)
    opened = opened.select(
        surrogate, "CountryName", "ISO", "SubRegion", "Region",
        as_of_col.alias("ValidFrom"), F.lit(None).cast("date").alias("ValidTo"),
        F.lit(1).alias("IsCurrent"), "GeoSeismicZone", "GEM_PGA_g", key)

    is_closing = (F.col("IsCurrent") == 1) & F.col("__chg").isNotNull()
    kept = (dim.join(changed_keys.withColumn("__chg", F.lit(1)), key, "left")
            .select(
                surrogate, "CountryName", "ISO", "SubRegion", "Region", "ValidFrom",
                F.when(is_closing, F.date_sub(as_of_col, 1)).otherwise(F.col("ValidTo")).alias("ValidTo"),
                F.when(is_closing, F.lit(0)).otherwise(F.col("IsCurrent")).alias("IsCurrent"),
                "GeoSeismicZone", "GEM_PGA_g", key))
    # the new dimension version is written to a new path and read back (never
    # overwrite a path being read); later joins then start from a plain scan
    return materialize(kept.unionByName(opened).select(*GEO_COLUMNS), "dim_version")


def multi_version(dim: DataFrame, key: str = "CountryDurableKey") -> DataFrame:
    """U13 listing: all versions of durable keys that have more than one row."""
    # one pass partitioned by the durable key (no self-join)
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    return (dim.withColumn("__qh_versions", n).filter(F.col("__qh_versions") > 1)
            .select(key, "GeographyKey", "CountryName", "ISO", "ValidFrom", "ValidTo", "IsCurrent"))


def rename_countries(master: DataFrame, renames: dict[str, str]) -> DataFrame:
    """U13 step 1: official renames applied to the master (ISO3 -> new name)."""
    name = F.col("CountryName")
    for iso, new in renames.items():
        name = F.when(F.col("ISO3") == iso, F.lit(new)).otherwise(name)
    return master.withColumn("CountryName", name)
