"""Fact promotion: idempotent staging -> fact transitions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakehouse.functions.columns import (
    date_key,
    partial_end,
    partial_start,
    prefix_date,
    scale_thousands,
)
from quakehouse.operators.keys import assign_keys, next_key_start
from quakehouse.operators.lookups import (
    band_join,
    keep_where_missing,
    lookup_current,
    with_calendar_member,
    with_fallback,
)
from quakehouse.session import shuffled

SEISMIC_COLUMNS = ["SeismicKey", "StgId", "DateKey", "GeographyKey", "MagnitudeKey",
                   "SeismicDepthKey", "Latitude", "Longitude", "Magnitude", "SeismicDepth",
                   "ModifiedMercalliIntensity", "SignificanceScore", "CommunityDecimalIntensity"]

DISASTER_COLUMNS = ["DisasterKey", "StgId", "StartDate", "EndDate", "GeographyKey",
                    "SeverityDeathsKey", "SeverityAffectedKey", "Latitude", "Longitude",
                    "DurationDays", "TotalDeaths", "TotalAffected", "NumInjuries",
                    "NumOtherAffected", "NumHomeless", "TotalDamageAdj", "InsuredDamage", "Tsunami"]

# Calendar bounds the disaster load accepts for the start year.
MIN_YEAR, MAX_YEAR = 1900, 2030


@dataclass
class Promotion:
    """Result of one promotion run.

    fact    -- new fact rows
    marks   -- staging ids to append to the tracker (never re-processed)
    dropped -- marked ids that produced no fact row (band gaps, outside calendar)
    """
    fact: DataFrame
    marks: DataFrame
    dropped: DataFrame


def promote(stage: DataFrame, tracker: DataFrame | None, markable: Column,
            transform: Callable[[DataFrame], DataFrame], id_col: str = "StgId") -> Promotion:
    """Staging minus tracker -> (fact rows, newly marked ids, dropped ids)."""
    pending = stage if tracker is None else keep_where_missing(stage, tracker, id_col)
    marked = pending.filter(markable)
    fact = transform(marked)
    marks = marked.select(id_col)
    dropped = marks.join(shuffled(fact.select(id_col)), id_col, "left_anti")
    return Promotion(fact, marks, dropped)


def _keys(df: DataFrame, name: str, key_mode: str, existing: DataFrame | None) -> DataFrame:
    """Surrogate key: the staging identity (stable on re-runs) or dense K1 keys."""
    if key_mode == "stgid":
        return df.withColumn(name, F.col("StgId").cast("bigint"))
    start = 0 if existing is None else next_key_start(existing, name)
    return assign_keys(df, ["StgId"], name=name, start=start)


def seismic_transform(dim_geo: DataFrame, mag_bands: DataFrame, depth_bands: DataFrame,
                      key_mode: str = "stgid", existing: DataFrame | None = None
                      ) -> Callable[[DataFrame], DataFrame]:
    """U4: staging rows -> FactSeismic rows (date key, geography, two band keys)."""
    def run(stage: DataFrame) -> DataFrame:
        x = stage.withColumn("DateKey", date_key(prefix_date("SrcTime")))
        x = lookup_current(x, dim_geo, on="ISO3")
        x = with_fallback(x, dim_geo)
        x = band_join(x, F.col("Mag").cast("decimal(4,2)"), mag_bands,
                      "LowerBound", "UpperBound", "MagnitudeKey")
        x = band_join(x, F.coalesce(F.col("Depth").cast("double"), F.lit(0.0)), depth_bands,
                      "LowerBoundKM", "UpperBoundKM", "SeismicDepthKey")
        x = _keys(x, "SeismicKey", key_mode, existing)
        return x.select(
            "SeismicKey", "StgId", "DateKey", "GeographyKey", "MagnitudeKey", "SeismicDepthKey",
            F.col("Latitude").try_cast("decimal(8,5)").alias("Latitude"),
            F.col("Longitude").try_cast("decimal(9,5)").alias("Longitude"),
            F.col("Mag").try_cast("decimal(4,2)").alias("Magnitude"),
            F.col("Depth").try_cast("decimal(7,2)").alias("SeismicDepth"),
            F.col("Mmi").try_cast("decimal(4,2)").alias("ModifiedMercalliIntensity"),
            F.col("Sig").try_cast("int").alias("SignificanceScore"),
            F.col("Cdi").try_cast("decimal(3,1)").alias("CommunityDecimalIntensity"),
        )
    return run


def fact_seismic(stage: DataFrame, dim_geo: DataFrame, mag_bands: DataFrame,
                 depth_bands: DataFrame, tracker: DataFrame | None = None,
                 key_mode: str = "stgid", existing: DataFrame | None = None) -> Promotion:
    """U3(U4): promote event staging rows whose time text has a parsable date."""
    return promote(stage, tracker, prefix_date("SrcTime").isNotNull(),
                   seismic_transform(dim_geo, mag_bands, depth_bands, key_mode, existing))


def casualty_split(total, injured, affected, homeless) -> dict[str, Column]:
    """Sub-components are NULL iff the total is NULL, otherwise defaulted to 0."""
    t, inj, aff, hom = (F.col(c) for c in (total, injured, affected, homeless))
    known = t.isNotNull()
    other = aff.cast("bigint") - F.coalesce(inj, F.lit(0)).cast("bigint") \
        - F.coalesce(hom, F.lit(0)).cast("bigint")
    return {
        "NumInjuries": F.when(known, F.coalesce(inj, F.lit(0))),
        "NumOtherAffected": F.when(known, F.coalesce(other, F.lit(0)).try_cast("int")),
        "NumHomeless": F.when(known, F.coalesce(hom, F.lit(0))),
    }


def disaster_transform(dim_geo: DataFrame, deaths_bands: DataFrame, affected_bands: DataFrame,
                       dim_date: DataFrame, key_mode: str = "stgid",
                       existing: DataFrame | None = None) -> Callable[[DataFrame], DataFrame]:
    """Staging rows -> FactDisaster rows."""
    def run(stage: DataFrame) -> DataFrame:
        start = partial_start("StartYear", "StartMonth", "StartDay")
        end = partial_end("EndYear", "EndMonth", "EndDay", "StartYear", "StartMonth", "StartDay")
        x = (stage.withColumn("__start", start).withColumn("__end", end)
             .withColumn("StartDate", date_key("__start")))
        x = with_calendar_member(x, dim_date, "StartDate")
        x = lookup_current(x, dim_geo, on="ISO")
        x = with_fallback(x, dim_geo)
        x = band_join(x, F.coalesce(F.col("TotalDeaths"), F.lit(0)), deaths_bands,
                      "LowerBound", "UpperBound", "SeverityDeathsKey", closed=True, how="left")
        x = band_join(x, F.coalesce(F.col("TotalAffected"), F.lit(0)), affected_bands,
                      "LowerBound", "UpperBound", "SeverityAffectedKey", closed=True, how="left")
        x = _keys(x, "DisasterKey", key_mode, existing)
        split = casualty_split("TotalAffected", "NoInjured", "NoAffected", "NoHomeless")
        return x.select(
            "DisasterKey", "StgId", "StartDate",
            date_key("__end").alias("EndDate"),
            "GeographyKey",
            F.coalesce(F.col("SeverityDeathsKey"), F.lit(1)).alias("SeverityDeathsKey"),
            F.coalesce(F.col("SeverityAffectedKey"), F.lit(1)).alias("SeverityAffectedKey"),
            F.col("Latitude").try_cast("decimal(8,5)").alias("Latitude"),
            F.col("Longitude").try_cast("decimal(9,5)").alias("Longitude"),
            F.datediff("__end", "__start").alias("DurationDays"),
            F.coalesce(F.col("TotalDeaths"), F.lit(0)).alias("TotalDeaths"),
            F.col("TotalAffected"),
            split["NumInjuries"].alias("NumInjuries"),
            split["NumOtherAffected"].alias("NumOtherAffected"),
            split["NumHomeless"].alias("NumHomeless"),
            scale_thousands("TotalDamagesAdj").alias("TotalDamageAdj"),
            scale_thousands("InsuredDamagesAdj").alias("InsuredDamage"),
            F.col("TsunamiFlag").cast("int").alias("Tsunami"),
        )
    return run


def fact_disaster(stage: DataFrame, dim_geo: DataFrame, deaths_bands: DataFrame,
                  affected_bands: DataFrame, dim_date: DataFrame,
                  tracker: DataFrame | None = None, key_mode: str = "stgid",
                  existing: DataFrame | None = None, min_year: int = MIN_YEAR,
                  max_year: int = MAX_YEAR) -> Promotion:
    """U3(U5): promote disaster rows with a start year in [min_year, max_year]."""
    y = F.col("StartYear")
    return promote(stage, tracker, y.isNotNull() & y.between(min_year, max_year),
                   disaster_transform(dim_geo, deaths_bands, affected_bands, dim_date,
                                      key_mode, existing))


def keep_first(df: DataFrame, keys: list[str], order: str = "StgId") -> DataFrame:
    """A10: keep the row with the lowest ``order`` per business key (NULL key = one group).

    Aggregate the minimum id per key (map-side partial aggregation, so a hot
    key costs one partial row per task), then semi-join the rows back.
    """
    ren = {k: f"__qh_k{i}" for i, k in enumerate(keys)}
    firsts = df.groupBy(*keys).agg(F.min(order).alias("__qh_first"))
    firsts = firsts.select(*[F.col(k).alias(v) for k, v in ren.items()], "__qh_first")
    cond = F.col(order) == F.col("__qh_first")
    for k, v in ren.items():
        cond = cond & F.col(k).eqNullSafe(F.col(v))
    return df.join(shuffled(firsts), cond, "left_semi")
