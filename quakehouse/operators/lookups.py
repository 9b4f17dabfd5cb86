"""Dimension lookups: current-version (J1), fallback member (J2), band range joins
(J3, J4), calendar membership (J7), anti/semi helpers (J5, J6, J8, J13, J14).

Broadcasts here are limited to tables with a fixed bound: the calendar (14,975
rows) and the *current* rows of the country dimension (one per country of the
reference list).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakehouse.functions.columns import SENTINEL_ISO
from quakehouse.session import shuffled


def lookup_current(df: DataFrame, dim: DataFrame, on: str, dim_on: str = "ISO",
                   key: str = "GeographyKey", out: str | None = None) -> DataFrame:
    """Left join to the current version of the dimension (IsCurrent = 1); codes are compared upper-case and trimmed."""
    out = out or key
    cur = (dim.filter(F.col("IsCurrent") == 1)
           .select(F.col(dim_on).alias("__qh_on"), F.col(key).alias(out)))
    return (df.join(F.broadcast(cur), F.upper(F.trim(df[on].cast("string"))) == F.col("__qh_on"), "left")
            .drop("__qh_on"))


def with_fallback(df: DataFrame, dim: DataFrame, key: str = "GeographyKey",
                  sentinel: str = SENTINEL_ISO, dim_on: str = "ISO") -> DataFrame:
    """Replace unresolved keys by the sentinel member's current key.

    The sentinel key is a scalar subquery (a single value), not a join.
    """
    fallback = (dim.filter((F.col(dim_on) == sentinel) & (F.col("IsCurrent") == 1))
                .select(F.max(key)).scalar())
    return df.withColumn(key, F.coalesce(F.col(key), fallback))


def band_join(df: DataFrame, value: Column, bands: DataFrame, lo: str, hi: str, key: str,
              closed: bool = False, how: str = "inner", form: str | None = None) -> DataFrame:
    """Attach the band key whose [lo, hi) (or [lo, hi] if closed) holds ``value``.

    ``form``: ``case`` - one CASE expression, no join; for a seeded band table (at most 64
    rows, no overlap). ``binned`` - an equi-join on bins, for band tables of any size, with
    overlaps (a row then comes once per band). None: ``case`` if the table allows it.
    """
    if form not in (None, "case", "binned"):
        raise ValueError(f"unknown form {form!r}")
    b = bands.select(F.col(key).alias(key), F.col(lo).alias("__qh_lo"), F.col(hi).alias("__qh_hi"))
    if form != "binned":
        expr = _band_case(b, value, key, closed)
        if expr is not None:
            out = df.withColumn(key, expr)
            return out.filter(F.col(key).isNotNull()) if how == "inner" else out
        if form == "case":
            raise ValueError("the band table is too large, overlaps or has NULL bounds: use form='binned'")
    return _binned_join(df, value, b, key, closed, how)


# level of bands without an end; exponents of doubles stay far below
_ENDLESS = 2000


def _bin(x: Column, level: Column) -> Column:
    """Number of the bin of side 2^level that holds x (a double: it may pass 64 bits)."""
    at = x / F.pow(F.lit(2.0), level)
    return F.when(level == _ENDLESS, F.lit(0.0)).otherwise(at - F.pmod(at, F.lit(1.0)))


def _binned_join(df: DataFrame, value: Column, bands: DataFrame, key: str, closed: bool, how: str) -> DataFrame:
    """Range join as an equi-join on (level, bin), with the exact test after it.

    A band belongs to the level whose bins are at least as wide as it is, so it meets two or
    three bins whatever its width; a value looks into its bin of each level that occurs (a few,
    as a level stands for a power of two). Nothing is broadcast by force and no pair is
    formed that does not share a bin.
    """
    low, high = F.col("__qh_lo").cast("double"), F.col("__qh_hi").cast("double")
    inf = F.lit(float("inf"))
    # bins of a band's own size, but none so small beside its bounds that neighbours coincide
    size = F.greatest(F.abs(low), F.abs(high), F.lit(1e-300))
    level = F.when((F.abs(low) == inf) | (F.abs(high) == inf), F.lit(_ENDLESS)).otherwise(
        F.greatest(F.ceil(F.log2(F.greatest(high - low, F.lit(1e-300)))), F.ceil(F.log2(size)) - 45).cast("int"))
    held = (bands.filter((low <= high) & F.col(key).isNotNull())  # NULL bounds hold no value
            .withColumn("__qh_level", level)
            .withColumn("__qh_first", _bin(low, F.col("__qh_level")))
            .withColumn("__qh_last", _bin(high, F.col("__qh_level"))))
    # one number per power of two that occurs
    levels = sorted(r[0] for r in held.select("__qh_level").distinct().collect())
    steps = F.array(*[F.col("__qh_first") + F.lit(float(i)) for i in range(3)])
    held = held.withColumn("__qh_bin", F.explode(F.filter(steps, lambda b: b <= F.col("__qh_last")))).drop("__qh_first", "__qh_last")
    upper = F.col("__qh_value") <= F.col("__qh_hi") if closed else F.col("__qh_value") < F.col("__qh_hi")
    exact = (F.col("__qh_value") >= F.col("__qh_lo")) & upper

    def matched(rows: DataFrame) -> DataFrame:
        looked = rows.withColumn("__qh_level", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
        looked = looked.withColumn("__qh_bin", _bin(F.col("__qh_value").cast("double"), F.col("__qh_level")))
        return (looked.join(held, ["__qh_level", "__qh_bin"]).filter(exact)
                .drop("__qh_level", "__qh_bin", "__qh_lo", "__qh_hi"))

    valued = df.withColumn("__qh_value", value)
    if how == "inner":
        return matched(valued.filter(F.col("__qh_value").isNotNull())).drop("__qh_value").select(*df.columns, key)
    if how != "left":
        raise ValueError(f"unknown join {how!r}")
    # each distinct value's bands, then back to the rows: rows without a band stay, once
    found = matched(valued.select("__qh_value").filter(F.col("__qh_value").isNotNull()).distinct())
    return valued.join(found, "__qh_value", "left").select(*df.columns, key)


_MAX_CASE_BANDS = 64


def _band_case(b: DataFrame, value: Column, key: str, closed: bool) -> Column | None:
    """A band table of at most 64 non-overlapping rows as one CASE expression.

    Same result as the range join (each value falls in at most one band), but it
    stays inside whole-stage codegen instead of a nested-loop join. The read is
    capped (``limit``) so at most 65 rows ever reach the driver; anything larger,
    overlapping or with NULL bounds keeps the join.
    """
    rows = b.limit(_MAX_CASE_BANDS + 1).collect()
    if len(rows) > _MAX_CASE_BANDS or any(r[1] is None or r[2] is None or r[0] is None for r in rows):
        return None
    ordered = sorted(rows, key=lambda r: r[1])
    for prev, nxt in zip(ordered, ordered[1:]):
        if nxt[1] < prev[2] or (closed and nxt[1] == prev[2]):
            return None  # overlapping bands: a row may match several, keep join semantics
    expr = None
    for k, lo_v, hi_v in ordered:
        upper = value <= F.lit(hi_v) if closed else value < F.lit(hi_v)
        cond = (value >= F.lit(lo_v)) & upper
        expr = F.when(cond, F.lit(k)) if expr is None else expr.when(cond, F.lit(k))
    return expr


def with_calendar_member(df: DataFrame, dim_date: DataFrame, key_col: str) -> DataFrame:
    """Keep rows whose computed date key exists in the calendar."""
    cal = dim_date.select(F.col("DateKey").alias("__qh_dk"))
    return df.join(F.broadcast(cal), df[key_col] == F.col("__qh_dk"), "left_semi")


def keep_where_missing(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` without a partner in ``other`` (NOT EXISTS)."""
    cols = [on] if isinstance(on, str) else list(on)
    return df.join(shuffled(other.select(*cols)), cols, "left_anti")


def keep_where_exists(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` with a partner in ``other`` (EXISTS)."""
    cols = [on] if isinstance(on, str) else list(on)
    return df.join(shuffled(other.select(*cols)), cols, "left_semi")
