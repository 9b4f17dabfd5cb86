"""Data-quality metrics (Q1-Q12, A1-A15, O1, O2, U-2, S10, J12).

Design rules: one aggregate scan per table for counts, fill rates and rule
violations; large facts are pre-aggregated by their (small-cardinality) keys
before joining a dimension; only metric rows ever leave the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakehouse.functions.columns import SENTINEL_ISO, key_to_date, status_band
from quakehouse.session import materialize

# ---------------------------------------------------------------- fixed values
# Key and audit columns left out of the completeness profile, per fact table.
FACT_EXCLUDE = {
    "FactSeismic": ["SeismicKey", "StgId", "DateKey", "DateYear", "GeographyKey", "MagnitudeKey",
                    "SeismicDepthKey", "InsertDate", "UpdateDate"],
    "FactDisaster": ["DisasterKey", "StgId", "StartDate", "EndDate", "GeographyKey",
                     "SeverityDeathsKey", "SeverityAffectedKey", "InsertDate", "UpdateDate"],
}
# Bucket labels of links per disaster (right-closed edges -1, 0, 1, 5, 10, inf).
LINK_BUCKETS = ["0", "1", "2-5", "6-10", ">10"]
LINK_EDGES = [-1.0, 0.0, 1.0, 5.0, 10.0, float("inf")]
HISTOGRAM_BINS = 30
# Alarm level for rows per yearly source request.
VOLUME_ALARM_ROWS = 19_900


def attribute_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Profiled columns = all columns minus keys/audit columns."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Q1/A1: one row per table with its row count."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def coverage(df: DataFrame, key_col: str, name: str) -> DataFrame:
    """Q3/A2: first and last date of a fact (date keys are monotone in the date)."""
    return df.agg(F.min(key_col).alias("lo"), F.max(key_col).alias("hi")).select(
        F.lit(name).alias("table_name"),
        key_to_date("lo").alias("min_date"), key_to_date("hi").alias("max_date"))


def _unpivot(one_row: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return one_row.selectExpr(f"stack({len(names)}, {pairs}) as (`{label}`, `{value}`)")


def completeness(df: DataFrame, name: str, exclude: Sequence[str] | None = None) -> DataFrame:
    """Fill percentage per attribute column in one pass, with a traffic light.

    An empty table gives NULL (not 100 %).
    """
    exclude = FACT_EXCLUDE.get(name, []) if exclude is None else exclude
    cols = attribute_columns(df, exclude)
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
    rates = agg.select(*[(F.lit(100.0) * F.col(f"`{c}`") / F.nullif(F.col("__n"), F.lit(0)))
                       .alias(c) for c in cols])
    long = _unpivot(rates, cols, "column_name", "fill_pct")
    return long.select(F.lit(name).alias("table_name"), "column_name",
                       F.col("fill_pct").cast("double").alias("fill_pct"),
                       status_band("fill_pct").alias("status"))


def count_violations(df: DataFrame, rules: dict[str, Column], name: str) -> DataFrame:
    """Violations per rule (``rules`` maps rule name -> violation predicate), one scan."""
    names = list(rules)
    agg = df.agg(*[F.count_if(F.coalesce(rules[r], F.lit(False))).alias(r) for r in names])
    long = _unpivot(agg, names, "rule", "violations")
    return long.select(F.lit(name).alias("table_name"), "rule", "violations",
                       F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"))


def seismic_rules() -> dict[str, Column]:
    m, la, lo = F.col("Magnitude"), F.col("Latitude"), F.col("Longitude")
    return {
        "magnitude in [0, 10]": (m < 0) | (m > 10),
        "latitude in [-90, 90]": (la < -90) | (la > 90),
        "longitude in [-180, 180]": (lo < -180) | (lo > 180),
    }


def disaster_rules() -> dict[str, Column]:
    return {
        "EndDate >= StartDate": F.col("EndDate") < F.col("StartDate"),
        "TotalDeaths >= 0": F.col("TotalDeaths") < 0,
        "NumOtherAffected >= 0": F.col("NumOtherAffected") < 0,
    }


def validity(seismic: DataFrame, disaster: DataFrame) -> DataFrame:
    """Q4: the range rules of the report (+ negative 'other affected'), PASS/FAIL."""
    return (count_violations(seismic, seismic_rules(), "FactSeismic")
            .unionByName(count_violations(disaster, disaster_rules(), "FactDisaster")))


def null_violations(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Q11: NULLs in columns declared NOT NULL."""
    rules = {c: F.col(f"`{c}`").isNull() for c in cols}
    return count_violations(df, rules, name).withColumnRenamed("rule", "column_name")


def fk_violations(fact: DataFrame, fk: str, dim: DataFrame, pk: str, name: str) -> DataFrame:
    """Q9: fact rows whose non-NULL foreign key has no dimension row.

    The fact is reduced to its distinct key values (partial aggregation) before
    the anti join, so the join moves one row per key value, not per fact row.
    """
    per_key = fact.groupBy(F.col(fk).alias("__fk")).agg(F.count(F.lit(1)).alias("__n"))
    missing = per_key.filter(F.col("__fk").isNotNull()).join(
        dim.select(F.col(pk).alias("__fk")), "__fk", "left_anti")
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit(fk).alias("fk_column"), "violations")


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key groups with more than one row (NULL is a group)."""
    return (df.groupBy(*keys).count().filter(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("dup_groups"),
                 F.coalesce(F.sum("count"), F.lit(0)).alias("dup_rows")))


def pk_violations(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Q10: duplicate primary-key groups of a table."""
    return duplicate_groups(df, keys).select(
        F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
        "dup_groups", "dup_rows")


def all_fk_violations(tables: dict[str, DataFrame], keys: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Q9 for a whole list of (fact, fk, dimension, pk): one count per foreign key and one join in all.

    Every foreign key is counted by its value before it is named and before the shuffle (the columns are
    scanned apart, as a row per key and link would cost more), and all of them meet the dimensions' keys in a single anti join.
    """
    held, asked = None, None
    for dim, pk in dict.fromkeys((d, p) for _, _, d, p in keys):
        one = tables[dim].select(F.lit(f"{dim}.{pk}").alias("__dim"), F.col(pk).cast("bigint").alias("__key"))
        held = one if held is None else held.unionByName(one)
    for fact, fk, dim, pk in keys:
        one = (tables[fact].select(F.col(fk).cast("bigint").alias("__key")).filter(F.col("__key").isNotNull())
               .groupBy("__key").agg(F.count(F.lit(1)).alias("__n"))
               .select(F.lit(fact).alias("table_name"), F.lit(fk).alias("fk_column"), F.lit(f"{dim}.{pk}").alias("__dim"), "__key", "__n"))
        asked = one if asked is None else asked.unionByName(one)
    missing = (asked.join(held, ["__dim", "__key"], "left_anti")
               .groupBy("table_name", "fk_column").agg(F.sum("__n").alias("violations")))
    names = asked.sparkSession.createDataFrame([(f, fk) for f, fk, _, _ in keys], "table_name string, fk_column string")
    return names.join(missing, ["table_name", "fk_column"], "left").select(
        "table_name", "fk_column", F.coalesce("violations", F.lit(0)).alias("violations"))


def all_pk_violations(tables: dict[str, DataFrame], keys: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Q10 for a whole list of (table, key columns): each shuffles its key columns alone, as they are (a name, list or text
    beside every row costs several times the key)."""
    out = None
    for name, cols in keys:
        one = pk_violations(tables[name], cols, name)
        out = one if out is None else out.unionByName(one)
    return out


def _per_geo(fact: DataFrame) -> DataFrame:
    return fact.groupBy("GeographyKey").agg(F.count(F.lit(1)).alias("__n"))


def top_countries(fact: DataFrame, dim_geo: DataFrame, n: int = 10,
                  measure: str | None = None, sentinel: str = SENTINEL_ISO) -> DataFrame:
    """Top-n country names by row count or by a summed measure.

    Pre-aggregates the fact per geography key (a few hundred rows), joins the
    dimension, regroups by name (renamed countries split, as in the source)
    and keeps the n largest with a name tie-break.
    """
    if measure is None:
        per = _per_geo(fact).withColumnRenamed("__n", "__v")
        out_name = "n"
    else:
        per = (fact.filter(F.col(measure).isNotNull()).groupBy("GeographyKey")
               .agg(F.sum(measure).alias("__v")))
        out_name = measure_alias(measure)
    g = dim_geo.filter(F.col("ISO") != sentinel).select("GeographyKey", "CountryName")
    by_name = (per.join(F.broadcast(g), "GeographyKey").groupBy("CountryName")
               .agg(F.sum("__v").alias(out_name)))
    return by_name.orderBy(F.col(out_name).desc(), F.col("CountryName").asc()).limit(n)


def measure_alias(measure: str) -> str:
    return {"TotalDeaths": "deaths"}.get(measure, f"sum_{measure}")


def per_year(fact: DataFrame, dim_date: DataFrame, key_col: str = "DateKey") -> DataFrame:
    """Fact rows per calendar year."""
    per_day = fact.groupBy(F.col(key_col).alias("DateKey")).agg(F.count(F.lit(1)).alias("__n"))
    cal = dim_date.select("DateKey", "Year")
    return (per_day.join(F.broadcast(cal), "DateKey").groupBy(F.col("Year").alias("yr"))
            .agg(F.sum("__n").alias("n")).orderBy("yr"))


def flag_share(df: DataFrame, flag: str) -> DataFrame:
    """Rows per flag value and their share of all rows (0-guarded)."""
    per = df.groupBy(F.col(flag).alias("flag")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return per.select("flag", "n", (F.col("n") / F.nullif(total, F.lit(0))).alias("share"))


def geo_resolution(facts: dict[str, DataFrame], dim_geo: DataFrame,
                   sentinel: str = SENTINEL_ISO) -> DataFrame:
    """Q5/U-2/A4/A13: per fact, rows on real countries vs the sentinel, and the share."""
    g = dim_geo.select("GeographyKey", (F.col("ISO") == sentinel).cast("int").alias("is_xin"))
    parts = [
        _per_geo(df).join(F.broadcast(g), "GeographyKey").groupBy("is_xin")
        .agg(F.sum("__n").alias("n")).select(F.lit(src).alias("src"), "is_xin", "n")
        for src, df in facts.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    from pyspark.sql import Window
    tot = F.sum("n").over(Window.partitionBy("src"))
    return out.select("src", "is_xin", "n", (F.col("n") / tot).alias("share"))


def count_distinct(df: DataFrame, *keys: str) -> DataFrame:
    """Number of distinct tuples (NULL counts as a value)."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n"))


def bucket_label(v: Column, edges: Sequence[float] = LINK_EDGES, labels: Sequence = LINK_BUCKETS) -> Column:
    """Label of the right-closed bucket (edges[i], edges[i + 1]] that holds v, else NULL."""
    if len(edges) != len(labels) + 1 or list(edges) != sorted(edges):
        raise ValueError("edges must ascend, one more than the labels")
    out = F.lit(None)
    for i, label in enumerate(labels):
        out = F.when((v > F.lit(float(edges[i]))) & (v <= F.lit(float(edges[i + 1]))), F.lit(label)).otherwise(out)
    return out


def bucket_counts(df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Rows per right-closed bucket (edges[i], edges[i + 1]], in order, empty buckets as 0.

    NULL and values outside the edges are in no bucket.
    """
    counts = (df.groupBy(bucket_label(F.col(value), edges, range(len(labels))).alias("bucket_order"))
              .agg(F.count(F.lit(1)).alias("n")))
    names = df.sparkSession.createDataFrame(list(enumerate(labels)), "bucket_order int, bucket string")
    return (names.join(counts, "bucket_order", "left")
            .select("bucket_order", "bucket", F.coalesce(F.col("n"), F.lit(0)).alias("n")).orderBy("bucket_order"))


def bridge_coverage(disasters: DataFrame, bridge: DataFrame) -> DataFrame:
    """Disasters per link-count bucket, empty buckets shown as 0."""
    from quakehouse.operators.bridge import links_per
    return (bucket_counts(links_per(disasters, bridge), "n", LINK_EDGES, LINK_BUCKETS)
            .withColumnRenamed("n", "n_disasters"))


def histogram(df: DataFrame, value: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, empty bins kept."""
    spark: SparkSession = df.sparkSession
    v = F.col(value).cast("double")
    vals = df.select(v.alias("__v")).filter(F.col("__v").isNotNull())
    mn = vals.agg(F.min("__v")).scalar()
    mx = vals.agg(F.max("__v")).scalar()
    width = mx - mn
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("__v") - mn) * F.lit(float(bins)) / width), F.lit(bins - 1)))
    counts = vals.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counts, "bin", "left")
            .select("bin", (mn + width * F.col("bin") / F.lit(float(bins))).alias("lo"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n"))
            .orderBy("bin"))


def volume_alarm(df: DataFrame, part: Column, limit: int = VOLUME_ALARM_ROWS) -> DataFrame:
    """Rows per slice (e.g. year) and whether it reaches the alarm level."""
    return (df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
            .select("part", "n", (F.col("n") >= limit).cast("int").alias("alarm")))


def scd2_checks(dim: DataFrame, key: str = "CountryDurableKey") -> DataFrame:
    """SCD2 invariants of a versioned dimension (Q-16): durable keys with more than
    one current row, and closed rows whose ValidTo precedes their ValidFrom."""
    per_key = dim.groupBy(key).agg(F.sum("IsCurrent").alias("__cur"))
    multi = per_key.agg(F.count_if(F.col("__cur") > 1).alias("value")).select(
        F.lit("scd2_multiple_current").alias("check_name"), "value")
    inverted = dim.agg(F.count_if(F.col("ValidTo") < F.col("ValidFrom")).alias("value")).select(
        F.lit("scd2_valid_to_before_from").alias("check_name"), "value")
    return multi.unionByName(inverted).select(
        F.lit("integrity").alias("section"), "check_name", F.lit("DimGeography").alias("subject"),
        F.col("value").cast("double").alias("value"),
        F.when(F.col("value") == 0, "PASS").otherwise("FAIL").alias("status"))


# ---------------------------------------------------------------- Q12
def table_partials(df: DataFrame, name: str, exclude: Sequence[str] | None = None,
                   rules: dict[str, Column] | None = None, not_null: Sequence[str] = (),
                   by: Sequence[Column | str] = (), flags: dict[str, Column] | None = None,
                   more: Sequence[Column] = ()) -> DataFrame:
    """The single scan of a table for Q12: all counters, optionally per low-cardinality keys.

    Grouping by ``by`` (e.g. geography key and year) keeps one row per key value, so
    the same scan also serves per-key checks (sentinel share); hash aggregation
    is partial per task, so even a key holding a third of the rows costs one
    row per task before the shuffle.
    """
    exclude = FACT_EXCLUDE.get(name, []) if exclude is None else exclude
    rules = rules or {}
    flags = flags or {}
    cols = attribute_columns(df, exclude)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"fill::{c}") for c in cols]
    aggs += [F.count_if(F.coalesce(r, F.lit(False))).alias(f"rule::{k}") for k, r in rules.items()]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null::{c}") for c in not_null]
    aggs += [F.count_if(F.coalesce(f, F.lit(False))).alias(f"flag::{k}") for k, f in flags.items()]
    return df.groupBy(*by).agg(*aggs, *more) if by else df.agg(*aggs, *more)


def profile_from_partials(partials: DataFrame, name: str) -> DataFrame:
    """Long metric rows (section, check_name, subject, value, status) from :func:`table_partials`."""
    metric_cols = [c for c in partials.columns if c == "__n" or "::" in c and not c.startswith("flag::")]
    one = partials.agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in metric_cols])
    names = [a for a in one.columns if a != "__n"]
    vals = one.select(
        *[(F.lit(100.0) * F.col(f"`{a}`") / F.nullif(F.col("__n"), F.lit(0))).alias(a)
          if a.startswith("fill::") else F.col(f"`{a}`").cast("double").alias(a) for a in names],
        F.col("__n").cast("double").alias("__n"))
    long = _unpivot(vals, names + ["__n"], "metric", "value")
    kind = F.split(F.col("metric"), "::").getItem(0)
    check = F.when(F.col("metric") == "__n", F.lit("rows")).otherwise(
        F.split(F.col("metric"), "::").getItem(1))
    section = (F.when(F.col("metric") == "__n", "counts").when(kind == "fill", "completeness")
               .when(kind == "rule", "validity").otherwise("not_null"))
    status = (F.when(kind == "fill", status_band("value"))
              .when(kind.isin("rule", "null"),
                    F.when(F.col("value") == 0, "PASS").otherwise("FAIL")))
    return long.select(section.alias("section"), check.alias("check_name"),
                       F.lit(name).alias("subject"), F.col("value"), status.alias("status"))


def quality_metrics(tables: dict[str, DataFrame], stages: dict[str, tuple[DataFrame, str]],
                    sentinel: str = SENTINEL_ISO, fks: Sequence[tuple[str, str, str, str]] = (),
                    pks: Sequence[tuple[str, Sequence[str]]] = ()) -> DataFrame:
    """Q12: every check of the report as one long table (section, check_name, subject, value, status).

    ``tables`` are the warehouse tables by reference name; ``stages`` maps a staging name to
    (frame, business key) for the uniqueness checks; ``fks`` and ``pks`` list the foreign and
    unique keys to check (Q9, Q10). Each fact is scanned once for everything that a count per
    geography and year answers: rows, fill rates, rules, NOT NULL, sentinel share, coverage,
    years, rankings, tsunami share.
    """
    seis, dis = tables["FactSeismic"], tables["FactDisaster"]
    geo, bridge = tables["DimGeography"], tables["BridgeDisasterSeismic"]
    seis_nn = ["SeismicKey", "DateKey", "GeographyKey", "MagnitudeKey", "SeismicDepthKey",
               "Latitude", "Longitude", "Magnitude", "SeismicDepth"]
    dis_nn = ["DisasterKey", "StartDate", "EndDate", "GeographyKey", "SeverityDeathsKey",
              "SeverityAffectedKey", "Tsunami"]

    def scan(df: DataFrame, name: str, date: str, **how) -> DataFrame:
        # written once, as several checks read it (otherwise column pruning would give each
        # use its own, narrower scan of the fact)
        year = F.floor(F.col(date) / 10000).cast("int").alias("__year")
        span = [F.min(date).alias("__first"), F.max(date).alias("__last")]
        return materialize(table_partials(df, name, by=("GeographyKey", year), more=span + how.pop("sums", []), **how), f"q12_{name}")

    seis_p = scan(seis, "FactSeismic", "DateKey", rules=seismic_rules(), not_null=seis_nn)
    dis_p = scan(dis, "FactDisaster", "StartDate", rules=disaster_rules(), not_null=dis_nn,
                 flags={"Tsunami": F.col("Tsunami") == 1}, sums=[F.sum("TotalDeaths").alias("__deaths")])
    parts = [profile_from_partials(seis_p, "FactSeismic"), profile_from_partials(dis_p, "FactDisaster")]

    def rows(df: DataFrame, section: str, check, subject, value, status=None) -> None:
        text = lambda x: x if isinstance(x, Column) else F.lit(x)
        parts.append(df.select(text(section).alias("section"), text(check).alias("check_name"), text(subject).alias("subject"),
                               value.cast("double").alias("value"),
                               (F.lit(None).cast("string") if status is None else status).alias("status")))

    passed = lambda c: F.when(F.col(c) == 0, "PASS").otherwise("FAIL")
    others = {k: v for k, v in tables.items() if k not in ("FactSeismic", "FactDisaster")}
    rows(row_counts(others), "counts", "rows", F.col("table_name"), F.col("row_count"))
    named = geo.select("GeographyKey", "CountryName", (F.col("ISO") == sentinel).alias("__x"))
    for src, p in (("FactSeismic", seis_p), ("FactDisaster", dis_p)):
        share = p.join(named, "GeographyKey", "left").agg(
            (F.sum(F.when(F.col("__x"), F.col("__n")).otherwise(0)) / F.nullif(F.sum("__n"), F.lit(0))).alias("v"))
        rows(share, "integrity", "sentinel_share", src, F.col("v"))
        span = p.agg(F.min("__first").alias("first_date_key"), F.max("__last").alias("last_date_key"))
        rows(_unpivot(span, ["first_date_key", "last_date_key"], "c", "v"), "coverage", F.col("c"), src, F.col("v"))
        rows(p.filter(F.col("__year").isNotNull()).groupBy("__year").agg(F.sum("__n").alias("n")),
             "per_year", F.col("__year").cast("string"), src, F.col("n"))
    for src, p, measure, check in (("FactSeismic", seis_p, "__n", "top_rows"), ("FactDisaster", dis_p, "__deaths", "top_deaths")):
        top = (p.groupBy("GeographyKey").agg(F.sum(measure).alias("v")).join(named.filter(~F.col("__x")), "GeographyKey")
               .groupBy("CountryName").agg(F.sum("v").alias("v")).filter(F.col("v").isNotNull())
               .orderBy(F.desc("v"), "CountryName").limit(10))
        rows(top, "ranking", F.concat(F.lit(check + " "), F.col("CountryName")), src, F.col("v"))
    hist = histogram(seis, "Magnitude")
    rows(hist, "histogram", F.concat(F.lit("magnitude_bin_"), F.col("bin").cast("string")), "FactSeismic", F.col("n"))
    rows(bridge_coverage(dis, bridge), "integrity", F.concat(F.lit("links_"), F.col("bucket")), "BridgeDisasterSeismic", F.col("n_disasters"))
    if fks:
        rows(all_fk_violations(tables, fks), "foreign_key", F.col("fk_column"), F.col("table_name"), F.col("violations"), passed("violations"))
    if pks:
        rows(all_pk_violations(tables, pks), "unique_key", F.col("key_columns"), F.col("table_name"), F.col("dup_groups"), passed("dup_groups"))
    for sname, (sdf, skey) in stages.items():
        rows(duplicate_groups(sdf, [skey]), "uniqueness", f"duplicate_{skey}", sname, F.col("dup_groups"), passed("dup_groups"))
    parts.append(scd2_checks(geo))
    ts = dis_p.agg((F.sum(F.col("`flag::Tsunami`")) / F.nullif(F.sum("__n"), F.lit(0))).alias("v"))
    rows(ts, "profile", "tsunami_share", "FactDisaster", F.col("v"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
