"""Column -> Column building blocks (cleaning, dates, distance, labels).

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen and needs no Python at execution time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Mean earth radius in km used by the distance function of the warehouse.
EARTH_RADIUS_KM = 6371.0
# Traffic-light thresholds of the quality report (percent filled).
GREEN_AT = 95.0
AMBER_AT = 50.0
# Country code used for events outside any country / unresolved codes.
SENTINEL_ISO = "XIN"

# A number as Python's float() accepts it (optional sign, digits with optional
# single underscores between them, decimals, exponent) or inf/nan words.
_NUMERIC_RX = (
    r"^\s*[+-]?((\d(_?\d)*)(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?\s*$"
    r"|^\s*[+-]?(inf|infinity|nan)\s*$"
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _rad(x: Column) -> Column:
    # degrees -> radians as one multiplication by a fixed constant
    return x * F.lit(math.pi / 180.0)


_WS = " \t\n\r\f\u000b"
_PLAIN_CHARS = "0123456789+-.eE"
_WORDS = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan", "+nan", "-nan"]


def strip_ws(c) -> Column:
    """Trim all leading/trailing ASCII whitespace (like Python's str.strip)."""
    return F.btrim(_c(c), F.lit(_WS))


def lenient_double(c) -> Column:
    """Text -> double the way Python's float() reads it; anything else NULL.

    Fast path without regex: trimmed text made only of digits, signs, '.', 'e'
    is read the same by Python and by Spark's cast (which alone would also take
    '12d' or hex forms), as are the inf/nan words. Only text with '_' (digit
    grouping) goes through the full pattern.
    """
    t = F.lower(strip_ws(_c(c).cast("string")))
    plain = (t != "") & (F.translate(t, _PLAIN_CHARS, "") == "")
    words = t.isin(*_WORDS)
    grouped = t.contains("_") & t.rlike(_NUMERIC_RX)
    return (F.when(plain | words, t.try_cast("double"))
            .when(grouped, F.regexp_replace(t, "_", "").try_cast("double")))


def float_from_double(d) -> Column:
    """P5 on an already-parsed double: NaN -> NULL (infinity kept, like the source)."""
    d = _c(d)
    return F.when(~F.isnan(d), d)


def int_from_double(d) -> Column:
    """P3 on an already-parsed double: truncate toward zero; negative/NaN/inf/overflow -> NULL.

    Truncation maps (-1, 0) to 0, so the valid inputs are exactly (-1, 2^31);
    NaN compares above every number in Spark, so it fails the upper bound.
    Written as one range test to keep generated code small.
    """
    d = _c(d)
    ok = (d > -1.0) & (d < 2147483648.0)
    return F.when(ok, F.floor(F.greatest(d, F.lit(0.0))).cast("int"))


def bigint_from_double(d) -> Column:
    """P4 on an already-parsed double: banker's rounding; negative/NaN/inf/overflow -> NULL.

    Half-even rounding maps [-0.5, 0) to 0, so the valid inputs are [-0.5, 2^63).
    """
    d = _c(d)
    ok = (d >= -0.5) & (d < float(2**63))
    return F.when(ok, F.bround(F.greatest(d, F.lit(0.0)), 0).cast("bigint"))


def float_or_null(c) -> Column:
    """P5: lenient float, NaN -> NULL (infinity kept, like the source)."""
    return float_from_double(lenient_double(c))


def int_or_null(c) -> Column:
    """Lenient int: truncate toward zero, negatives/junk/NaN/inf -> NULL.

    For many columns, parse once with :func:`lenient_double` in one projection
    and apply :func:`int_from_double` in the next (keeps generated code small).
    """
    return int_from_double(lenient_double(c))


def bigint_or_null(c) -> Column:
    """Lenient bigint with banker's rounding, negatives -> NULL."""
    return bigint_from_double(lenient_double(c))


def clean_str(c, n: int | None = None) -> Column:
    """NULL or '' -> NULL; otherwise stripped and cut to n characters."""
    col = _c(c).cast("string")
    s = strip_ws(col)
    if n is not None:
        s = F.substring(s, 1, n)
    return F.when(col.isNotNull() & (col != ""), s)


def cut_str(c, n: int) -> Column:
    """Missing -> '' then cut to n characters."""
    return F.substring(F.coalesce(_c(c).cast("string"), F.lit("")), 1, n)


def contains_flag(c, word: str) -> Column:
    """1 when the lower-cased text contains ``word`` (NULL -> 0)."""
    return F.lower(F.coalesce(_c(c).cast("string"), F.lit(""))).contains(word.lower()).cast("int")


def type_equals(c, value: str) -> Column:
    """P1 predicate: trimmed, lower-cased value equals ``value``."""
    return F.lower(strip_ws(_c(c))) == value.lower()


def prefix_date(c) -> Column:
    """Date from the first 10 characters of a timestamp text; else NULL.

    A plain ``try_cast`` (Spark's native date parser, like the source's
    TRY_CAST), not a pattern formatter: cheaper per row.
    """
    return F.substring(_c(c), 1, 10).try_cast("date")


def date_key(d) -> Column:
    """P10: yyyyMMdd integer key of a date."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def key_to_date(k) -> Column:
    """Inverse of :func:`date_key`."""
    return F.try_to_date(F.lpad(_c(k).cast("string"), 8, "0"), "yyyyMMdd")


def safe_make_date(y, m, d) -> Column:
    """DATEFROMPARTS that yields NULL instead of failing (Feb 30, month 13).

    Made from the numbers themselves: writing them as text to parse it again took most of the
    time of the disaster fact. No clock takes part (``timestamp_ntz``).
    """
    part = [_c(v).try_cast("int") for v in (y, m, d)]
    midnight = F.try_make_timestamp_ntz(*part, F.lit(0), F.lit(0), F.lit(0))
    return F.when((_c(y) >= 1) & (_c(y) <= 9999), midnight.cast("date"))


def partial_start(y, m, d) -> Column:
    """Start date with missing month/day taken as 1."""
    return safe_make_date(y, F.coalesce(_c(m), F.lit(1)), F.coalesce(_c(d), F.lit(1)))


def partial_end(ey, em, ed, sy, sm, sd) -> Column:
    """End date whose missing parts fall back to the start parts."""
    return safe_make_date(
        F.coalesce(_c(ey), _c(sy)),
        F.coalesce(_c(em), _c(sm), F.lit(1)),
        F.coalesce(_c(ed), _c(sd), F.lit(1)),
    )


def scale_thousands(c) -> Column:
    """Thousands of USD -> USD, NULL kept; an overflow is NULL."""
    return F.try_multiply(_c(c).cast("bigint"), F.lit(1000).cast("bigint"))


def status_band(pct) -> Column:
    """Traffic-light label of a fill percentage."""
    p = _c(pct)
    return (F.when(p >= GREEN_AT, F.lit("green"))
            .when(p >= AMBER_AT, F.lit("amber"))
            .when(p.isNotNull(), F.lit("red")))


def epoch_ms_iso(c) -> Column:
    """Epoch milliseconds -> ISO-8601 UTC text (NULL stays NULL).

    Like Python's ``isoformat``: the fraction is printed only when non-zero.
    """
    ms = _c(c).cast("bigint")
    ts = F.timestamp_millis(ms)
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    return F.when(F.pmod(ms, F.lit(1000)) == 0,
                  F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")) \
        .otherwise(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km, rounded to 3 decimals.

    Inputs are first rounded to 5 decimals (the stored coordinate precision).
    Any NULL input gives NULL. ``a`` is clamped to 1 with ``when`` (not
    ``least``, which would skip NULL).
    """
    la1, lo1, la2, lo2 = (F.round(_c(x).cast("double"), 5) for x in (lat1, lon1, lat2, lon2))
    dlat = _rad(la2 - la1)
    dlon = _rad(lo2 - lo1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(_rad(la1)) * F.cos(_rad(la2)) * F.pow(F.sin(dlon / 2), 2))
    a = F.when(a > 1.0, F.lit(1.0)).otherwise(a)
    d = F.lit(EARTH_RADIUS_KM) * 2.0 * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))
    return F.round(d, 3)


def coord(c) -> Column:
    """A coordinate at the stored precision (5 decimals), as double."""
    return F.round(_c(c).cast("double"), 5)


def cos_lat(lat_deg) -> Column:
    """cos of a latitude given in (already rounded) degrees."""
    return F.cos(_rad(_c(lat_deg)))


def unit_vector(lat_deg, lon_deg) -> tuple[Column, Column, Column]:
    """Point of the unit sphere; the straight distance of two points grows with their great-circle distance."""
    la, lo = _rad(_c(lat_deg)), _rad(_c(lon_deg))
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def haversine_parts_km(lat1, lon1, cos1, lat2, lon2, cos2) -> Column:
    """X1 from per-row parts: rounded coordinates and the cosines of their latitudes.

    Same arithmetic as :func:`haversine_km`, but the rounding and cosines are
    computed once per input row (before a join) instead of once per pair.
    """
    la1, lo1, la2, lo2 = (_c(x) for x in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(_rad(la2 - la1) / 2), 2)
         + _c(cos1) * _c(cos2) * F.pow(F.sin(_rad(lo2 - lo1) / 2), 2))
    a = F.when(a > 1.0, F.lit(1.0)).otherwise(a)
    d = F.lit(EARTH_RADIUS_KM) * 2.0 * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))
    return F.round(d, 3)


def round_km(km: str) -> Column:
    """``round(km, 3)`` of a column of distances (a column, as it is read several times).

    All but those next to a half go without the decimal arithmetic, which takes longer than the distance.
    """
    d = _c(km)
    x = d * 1000.0
    low = F.floor(x)
    part = x - low
    return (F.when((part >= 0.0) & (part < 0.499999), low / 1000.0)
            .when((part > 0.500001) & (part < 1.0), (low + 1) / 1000.0).otherwise(F.round(d, 3)))


def raw_haversine_parts_km(lat1, lon1, cos1, lat2, lon2, cos2) -> Column:
    """Unrounded haversine from per-row parts (for nearest-neighbour ranking)."""
    la1, lo1, la2, lo2 = (_c(x) for x in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(_rad(la2 - la1) / 2), 2)
         + _c(cos1) * _c(cos2) * F.pow(F.sin(_rad(lo2 - lo1) / 2), 2))
    a = F.when(a > 1.0, F.lit(1.0)).otherwise(a)
    return F.lit(EARTH_RADIUS_KM) * 2.0 * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))
