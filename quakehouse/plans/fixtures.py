"""Hazard-model inputs derived from the driver's TPC-H-like tables.

events      <- lineitem x supplier   (event staging, with built-in dirt)
disasters   <- orders x customer     (disaster staging, with built-in dirt)
master      <- nation x region       (+ the sentinel country)

Every expression is a built-in function so the same text exists in DuckDB SQL
(see ``quakehouse.plans.oracle``). Staging ids are assigned with the distributed
dense-key operator (K2), never with a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakehouse.functions.columns import prefix_date
from quakehouse.operators.keys import assign_keys

# ---------------------------------------------------------------- fixed values
# ISO2 letters used for the derived country master (nation key n -> letter n+1).
ISO2_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXY"
EVENT_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code(n) -> F.Column:
    return F.concat(F.lit("N"), F.lpad(n.cast("string"), 2, "0"))


def _by_batch(df: DataFrame, day: str) -> DataFrame:
    """Rows with their yearly batch, sorted by it for the partitioned write while they are narrow."""
    return df.withColumn("LoadBatchId", F.year(day)).sortWithinPartitions("LoadBatchId")


def event_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: event staging rows (StgId, EventId, SrcTime, coordinates, Mag, ...)."""
    li = table(spark, sf_dir, "lineitem").select(*EVENT_ORDER, "l_quantity")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(su, li.l_suppkey == su.s_suppkey).withColumnRenamed("s_nationkey", "n").drop("s_suppkey")
    k = _by_batch(assign_keys(j, EVENT_ORDER, name="id", whole=True), "l_shipdate")
    i = F.col("id")
    n = F.col("n")
    mag = F.when(i % 50 == 0, F.least(F.floor(F.col("l_quantity") / 5), F.lit(9)) + F.lit(0.99)) \
        .otherwise(F.col("l_quantity") / 5)
    return k.select(
        i.alias("StgId"),
        F.concat(F.lit("e"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("EventId"),
        F.when(i % 97 == 0, F.lit("None"))
        .otherwise(F.concat(F.to_date("l_shipdate").cast("string"), F.lit("T00:00:00+00:00")))
        .alias("SrcTime"),
        F.when(i % 83 == 0, F.lit(95.0))
        .otherwise((n * 7 - 80).cast("double") + (F.col("l_partkey") % 200).cast("double") / 100)
        .alias("Latitude"),
        ((n * 13 - 160).cast("double")
         + ((F.col("l_suppkey") * 37 + F.col("l_linenumber") * 11) % 200).cast("double") / 100)
        .alias("Longitude"),
        F.when(i % 61 == 0, F.lit(None).cast("double"))
        .otherwise(((F.col("l_partkey") * 7 + F.col("l_orderkey") * 13) % 800 - 5).cast("double"))
        .alias("Depth"),
        mag.cast("decimal(4,2)").alias("Mag"),
        F.when(i % 14 == 0, F.col("l_linenumber").cast("double")).alias("Mmi"),
        (F.col("l_quantity") * 10).cast("int").alias("Sig"),
        F.when(i % 6 == 0, F.col("l_linenumber").cast("double") / 2).alias("Cdi"),
        F.when(i % 11 == 0, F.lit("XIN")).when(i % 13 == 0, F.lit("ZZZ"))
        .otherwise(_code(n)).alias("ISO3"),
        "LoadBatchId",
    )


def disaster_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: disaster staging rows (partial dates, casualties, money, flag)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = _by_batch(o.join(c, o.o_custkey == c.c_custkey), "o_orderdate")
    k = F.col("o_orderkey")
    tp = F.col("o_totalprice")
    od = F.to_date("o_orderdate")
    end = F.date_add(od, 20)
    cn = F.col("c_nationkey")
    return j.select(
        (k + 1).alias("StgId"),
        F.concat(F.lit("D"), (k - F.when(k % 40 == 1, 1).otherwise(0)).cast("string")).alias("DisNo"),
        _code(cn).alias("ISO"),
        F.when(k % 25 == 0, F.lit(None).cast("double"))
        .otherwise((cn * 7 - 80).cast("double") + (k % 200).cast("double") / 100).alias("Latitude"),
        F.when(k % 25 == 0, F.lit(None).cast("double"))
        .otherwise((cn * 13 - 160).cast("double") + (F.col("o_custkey") % 200).cast("double") / 100)
        .alias("Longitude"),
        F.when(k % 101 == 0, F.lit(None).cast("int")).when(k % 103 == 0, F.lit(1985))
        .otherwise(F.year(od)).alias("StartYear"),
        F.when(k % 17 != 0, F.month(od)).alias("StartMonth"),
        F.when(k % 19 != 0, F.dayofmonth(od)).alias("StartDay"),
        F.when(k % 7 != 0, F.year(end)).alias("EndYear"),
        F.when(k % 23 != 0, F.month(end)).alias("EndMonth"),
        F.when(k % 29 != 0, F.dayofmonth(end)).alias("EndDay"),
        F.when(k % 10 != 0, ((F.col("o_custkey") * 31 + k * 7) % 1500).cast("int")).alias("TotalDeaths"),
        F.when(k % 21 != 0, F.floor(tp / 10).cast("int")).alias("NoInjured"),
        F.when(k % 15 != 0, F.floor(tp / (k % 2 + 2)).cast("int")).alias("NoAffected"),
        F.when(k % 8 != 0, F.floor(tp / 3).cast("int")).alias("NoHomeless"),
        F.when(k % 9 != 0, F.floor(tp).cast("int")).alias("TotalAffected"),
        F.when(k % 2 != 1, F.floor(tp / 10).cast("bigint")).alias("TotalDamagesAdj"),
        F.when(k % 9 == 1, F.floor(tp / 50).cast("bigint")).alias("InsuredDamagesAdj"),
        F.when(k % 12 == 0, 1).otherwise(0).alias("TsunamiFlag"),
        "LoadBatchId",
    )


def country_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country master (durable key, ISO3, ISO2, names, hazard attributes) + sentinel."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nk = F.col("n_nationkey")
    base = n.join(r, n.n_regionkey == r.r_regionkey).select(
        (nk + 2).cast("int").alias("CountryDurableKey"),
        _code(nk).alias("ISO3"),
        F.concat(F.lit("Q"), F.substring(F.lit(ISO2_LETTERS), nk + 1, 1)).alias("ISO2"),
        F.col("n_name").alias("CountryName"),
        F.col("r_name").alias("SubRegion"),
        F.col("r_name").alias("Region"),
        (nk.cast("double") / 40).alias("GEM_PGA_g"),
        F.when(nk < 5, "Very Low").when(nk < 10, "Low").when(nk < 15, "Moderate")
        .when(nk < 20, "High").otherwise("Very High").alias("GeoSeismicZone"),
    )
    sentinel = spark.createDataFrame(
        [(1, "XIN", None, "International Waters", "Ocean", "Ocean", None, "Very Low")],
        "CountryDurableKey int, ISO3 string, ISO2 string, CountryName string, SubRegion string, "
        "Region string, GEM_PGA_g double, GeoSeismicZone string")
    return base.unionByName(sentinel)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference places for nearest-place assignment, derived from suppliers.

    Every tenth place has an empty code and every tenth+1 an unknown one.
    """
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    k = F.col("s_suppkey")
    iso2 = F.concat(F.lit("Q"), F.substring(F.lit(ISO2_LETTERS), F.col("s_nationkey") + 1, 1))
    return s.select(
        k.alias("place_id"),
        ((k * 37) % 170 - 85).cast("double") + 0.5,
        ((k * 53) % 350 - 175).cast("double") + 0.25,
        F.when(k % 10 == 0, F.lit("")).when(k % 10 == 1, F.lit("ZZ")).otherwise(iso2).alias("cc"),
    ).toDF("place_id", "lat", "lon", "cc")


def event_features(stage: DataFrame) -> DataFrame:
    """Event staging rows as GeoJSON Feature JSON lines (one feature per row)."""
    day = prefix_date("SrcTime")
    ms = (F.unix_date(day).cast("bigint") * F.lit(86_400_000))
    coords = F.when(F.col("Depth").isNull(), F.array("Longitude", "Latitude")) \
        .otherwise(F.array("Longitude", "Latitude", "Depth"))
    props = F.struct(
        ms.alias("time"), F.col("Mag").cast("double").alias("mag"), F.lit("mww").alias("magType"),
        F.lit("us").alias("net"), ms.alias("updated"),
        F.concat(F.lit("near "), F.col("ISO3")).alias("place"), F.lit("earthquake").alias("type"),
        F.lit("reviewed").alias("status"), F.col("Mmi").alias("mmi"), F.col("Sig").alias("sig"),
        F.col("Cdi").alias("cdi"))
    feat = F.struct(F.lit("Feature").alias("type"), F.col("EventId").alias("id"),
                    props.alias("properties"),
                    F.struct(F.lit("Point").alias("type"), coords.alias("coordinates")).alias("geometry"))
    return stage.select(F.to_json(feat).alias("value"))


# Disaster staging column -> export header used when landing the CSV fixture.
EXPORT_HEADERS = {
    "DisNo": "DisNo.", "ISO": "ISO", "Latitude": "Latitude", "Longitude": "Longitude",
    "StartYear": "Start Year", "StartMonth": "Start Month", "StartDay": "Start Day",
    "EndYear": "End Year", "EndMonth": "End Month", "EndDay": "End Day",
    "TotalDeaths": "Total Deaths", "NoInjured": "No. Injured", "NoAffected": "No. Affected",
    "NoHomeless": "No. Homeless", "TotalAffected": "Total Affected",
    "TotalDamagesAdj": "Total Damage, Adjusted ('000 US$)",
    "InsuredDamagesAdj": "Insured Damage, Adjusted ('000 US$)",
}


def disaster_export(stage: DataFrame) -> DataFrame:
    """Disaster staging rows in the export's shape (text headers, type and associated types)."""
    k = F.col("StgId")
    cols = [F.col(c).cast("string").alias(h) for c, h in EXPORT_HEADERS.items()]
    cols.append(F.when(k % 13 == 0, F.lit(" Flood ")).otherwise(F.lit("Earthquake")).alias("Disaster Type"))
    cols.append(F.when(F.col("TsunamiFlag") == 1, F.lit("Tsunami|Landslide")).alias("Associated Types"))
    cols.append(F.col("StartYear").cast("string").alias("Year"))
    return stage.select(*cols)
