"""Spatio-temporal bridge between disasters and seismic events.

A disaster links to every event of the same geography whose date lies in
[start - W, start] and whose epicentre is within R km. Disasters without
coordinates link to all same-geography events in the window (distance NULL).

Spark has no interval join, and a join on geography alone would pair every
disaster with every event of a busy country. Instead the *small* side
(disasters) is exploded into its W + 1 candidate dates, and the join becomes an
equi-join on (geography, date). Where a key's pairs are many beside its rows (a
swarm, a large country), the key is divided in space as well: its rows join on
(geography, date, cell), so that pairs follow the links and not the square of a
day's total. The pairs left are a bounded multiple of rows plus links. Keys whose rows
lie in a few cells already are left whole: copies would cost more than they save.

Cells are cubes over the 3-D unit vectors of the coordinates, so poles, the date
line and latitudes past 90 need no case of their own: points within R km are
within a fixed chord of each other, a cube's side is twice that chord, and a
disaster takes those of its own and the 26 neighbouring cubes that its ball
meets and the sphere passes (5.5 on average; candidates are then some five times
the links where events are spread evenly).

A divided key can still be hot (an aftershock swarm right beside many
disasters). Its pairs are n events times m disasters, so both are counted - after
a semi join, so only events of touched days are read - and keys of more pairs
than one task should form are split: events by a hash, the disasters' copies once
per part.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakehouse.functions.columns import (
    EARTH_RADIUS_KM,
    coord,
    cos_lat,
    date_key,
    haversine_parts_km,
    key_to_date,
    raw_haversine_parts_km,
    round_km,
    unit_vector,
)
from quakehouse.operators.dims import CALENDAR_END, CALENDAR_START
from quakehouse.operators.lookups import keep_where_missing
from quakehouse.session import materialize

# ---------------------------------------------------------------- fixed values
RADIUS_KM = 100
WINDOW_DAYS = 3
# Partition column of a stored seismic fact (event year).
YEAR_COLUMN = "DateYear"
# A cell's side as a multiple of the radius' chord.
CELL_PER_RADIUS = 2.0
# A (geography, day) key is divided into cells when it makes more pairs than this a row.
PAIRS_PER_ROW = 32
# Cubes that a disaster's ball meets, on average.
CELLS_TAKEN = 5.5


def with_event_year(fact: DataFrame) -> DataFrame:
    """Partition column for storing the seismic fact: the year of its date key."""
    return fact.withColumn(YEAR_COLUMN, (F.col("DateKey") / 10000).cast("int"))


def _durable(df: DataFrame, dim_geo: DataFrame) -> DataFrame:
    m = dim_geo.select(F.col("GeographyKey").alias("__g"), F.col("CountryDurableKey"))
    return df.join(m, df["GeographyKey"] == F.col("__g")).drop("__g")


def _radius_chord(radius_km: float) -> float:
    """Chord of the unit sphere that any distance of at most ``radius_km``, rounded to 3 decimals, stays below."""
    return 2 * math.sin(min(math.pi / 2, (radius_km + 0.001) / (2 * EARTH_RADIUS_KM)))


_CELL = ["__cx", "__cy", "__cz"]


def with_cell(df: DataFrame, radius_km: float, divided: Column, lat: str = "__slat", lon: str = "__slon", unit: str | None = None) -> DataFrame:
    """Add the cube (``__cx``, ``__cy``, ``__cz``) of each row's point; 0, 0, 0 for rows that are not ``divided``.

    ``unit``: prefix of the columns that hold its unit vector.
    """
    side = F.lit(CELL_PER_RADIUS * _radius_chord(radius_km))
    vector = unit_vector(lat, lon) if unit is None else [F.col(f"{unit}{n}") for n in "xyz"]
    return df.withColumns({c: F.when(divided, F.floor(v / side).cast("int")).otherwise(0)
                           for c, v in zip(_CELL, vector)})


def with_unit_vector(df: DataFrame, lat: str = "__dlat", lon: str = "__dlon", unit: str = "__u") -> DataFrame:
    """Add the point's place on the unit sphere (``__ux``, ``__uy``, ``__uz``)."""
    return df.withColumns({f"{unit}{n}": v for n, v in zip("xyz", unit_vector(lat, lon))})


def with_cells_within(df: DataFrame, radius_km: float, divided: Column, lat: str = "__dlat", lon: str = "__dlon") -> DataFrame:
    """One row per cube that can hold a point within ``radius_km`` of the row's point; one 0, 0, 0 for rows that are not ``divided``.

    One axis after the other, each dropping the cubes that are too far off already: the test
    of all 27 cubes at once makes a method that the JVM does not compile. Rows that bring
    their unit vector stored (:func:`with_unit_vector`) spare its functions.
    """
    reach = _radius_chord(radius_km) + 1e-9
    side = F.lit(CELL_PER_RADIUS * _radius_chord(radius_km))
    out = (df if "__ux" in df.columns else with_unit_vector(df, lat, lon)).withColumn("__divided", divided)
    square = lambda v: v * v
    parts = {"gap": F.lit(0.0), "low": F.lit(0.0), "high": F.lit(0.0)}
    for c, n in zip(_CELL, "xyz"):
        u = F.col(f"__u{n}")
        out = out.withColumn("__no", F.floor(u / side).cast("int"))
        cubes = []
        for step in (-1, 0, 1):
            lo, hi = (F.col("__no") + step) * side, (F.col("__no") + step + 1) * side
            near = F.when((lo <= 0) & (hi >= 0), F.lit(0.0)).otherwise(F.least(F.abs(lo), F.abs(hi)))
            cubes.append(F.struct((F.col("__no") + step).alias("no"), square(F.greatest(lo - u, u - hi, F.lit(0.0))).alias("gap"),
                                  square(near).alias("low"), square(F.greatest(F.abs(lo), F.abs(hi))).alias("high")))
        whole = F.struct(F.lit(0).alias("no"), *[F.lit(v).alias(p) for p, v in (("gap", 0.0), ("low", 0.0), ("high", 1.0))])
        out = out.withColumn("__cube", F.explode(F.when(F.col("__divided"), F.array(*cubes)).otherwise(F.array(whole))))
        out = out.withColumns({c: F.col("__cube.no"), **{f"__{p}": v + F.col(f"__cube.{p}") for p, v in parts.items()}})
        # the ball around the point meets the cube
        out = out.drop("__cube", "__no").filter(F.col("__gap") <= reach * reach)
        parts = {p: F.col(f"__{p}") for p in parts}
    # and the sphere passes it
    passed = (F.col("__low") <= 1 + 1e-9) & (F.col("__high") >= 1 - 1e-9)
    return out.filter(passed).drop("__divided", *[f"__{p}" for p in parts])


def within_radius(radius_km: float, lat1: str, lon1: str, cos1, lat2: str, lon2: str, cos2, units: tuple[str, str] | None = None) -> Column:
    """Whether the distance, rounded to 3 decimals, is at most ``radius_km``.

    One minus the cosine of the angle, a sum of two products, settles all pairs but those within
    metres of the radius, and these are settled by the distance itself. ``units``: prefixes of the columns
    that hold the unit vectors, whose product is that cosine.
    """
    angle = lambda km: min(math.pi, max(0.0, km / EARTH_RADIUS_KM))
    surely, maybe = 1 - math.cos(angle(radius_km - 0.001)) - 1e-12, 1 - math.cos(angle(radius_km + 0.001)) + 1e-12
    if units is None:
        turn = lambda a, b: F.lit(1.0) - F.cos((F.col(a) - F.col(b)) * F.lit(math.pi / 180.0))
        less = turn(lat2, lat1) + F.col(cos1) * F.col(cos2) * turn(lon2, lon1)
    else:
        x, y, z = (F.col(f"{units[0]}{n}") * F.col(f"{units[1]}{n}") for n in "xyz")
        less = F.lit(1.0) - (x + y + z)
    exact = haversine_parts_km(lat1, lon1, cos1, lat2, lon2, cos2) <= F.lit(float(radius_km))
    return (less <= F.lit(surely)) | ((less <= F.lit(maybe)) & exact)


def build_bridge(disasters: DataFrame, seismic: DataFrame, existing: DataFrame | None = None,
                 radius_km: float = RADIUS_KM, window_days: int = WINDOW_DAYS,
                 match_on: str = "GeographyKey", dim_geo: DataFrame | None = None,
                 calendar: tuple[_dt.date, _dt.date] = (CALENDAR_START, CALENDAR_END),
                 hot_key_rows: int | None = None, salts: int | None = None,
                 pairs_per_row: int = PAIRS_PER_ROW, distance: str = "decimal(10,3)") -> DataFrame:
    """New bridge rows (DisasterKey, SeismicKey, DistanceKM, TimeLagDays).

    Only disasters without any existing bridge row are (re)matched (J8).
    ``match_on="CountryDurableKey"`` matches across country versions (needs ``dim_geo``).
    ``pairs_per_row``: (geography, day) keys with more pairs a row are divided into cells, if that saves pairs.
    ``hot_key_rows``: keys with more candidate pairs (events times disasters) than this
    are split into parts of about so many (``salts``: into so many at most).
    ``distance``: type of DistanceKM; as double it is spared the decimal arithmetic of a stored link.
    """
    todo = disasters if existing is None else keep_where_missing(disasters, existing, "DisasterKey")
    ev = seismic
    if match_on == "CountryDurableKey":
        todo = _durable(todo, dim_geo)
        ev = _durable(ev, dim_geo)
    lo, hi = calendar
    # per-row parts of the distance (rounded coordinates, unit vector) are
    # computed once per disaster / event, not once per candidate pair
    d = (todo.select(
            "DisasterKey", F.col(match_on).alias("__geo"),
            key_to_date("StartDate").alias("__start"),
            coord("Latitude").alias("__dlat"), coord("Longitude").alias("__dlon"))
         .filter(F.col("__start").isNotNull()))

    def days(df: DataFrame) -> DataFrame:
        return (df.withColumn("TimeLagDays", F.explode(F.sequence(F.lit(0), F.lit(int(window_days)))))
                .withColumn("__day", F.date_sub("__start", F.col("TimeLagDays")))
                # the event date must itself be a calendar member
                .filter(F.col("__day").between(F.lit(lo), F.lit(hi)))
                .withColumn("__dk", date_key("__day"))
                .withColumn("__yr", F.year("__day")))

    # a seismic fact stored partitioned by event year exposes that column; joining
    # on it as well lets dynamic partition pruning skip years no window touches
    year = F.col(YEAR_COLUMN) if YEAR_COLUMN in ev.columns else (F.col("DateKey") / 10000).cast("int")
    s = ev.select(
        "SeismicKey", F.col(match_on).alias("__geo"), F.col("DateKey").alias("__dk"),
        year.alias("__yr"), coord("Latitude").alias("__slat"), coord("Longitude").alias("__slon"))
    keys = ["__geo", "__yr", "__dk"]
    # with coordinates: by day and cell, then by distance (compared in double, rounded to
    # 3 decimals; stored as decimal(10,3))
    # (stored with the unit vectors: they are read by each count and by the join)
    placed = d.filter(F.col("__dlat").isNotNull() & F.col("__dlon").isNotNull())
    near_d = materialize(with_unit_vector(placed), "bridge_disasters")
    near_s = with_unit_vector(s.filter(F.col("__slat").isNotNull() & F.col("__slon").isNotNull()), "__slat", "__slon", "__v")
    busy = busy_keys(near_d, near_s, days, keys, radius_km, pairs_per_row)
    near_d, near_keys, hot = days(near_d), keys, None
    if not busy.isEmpty():
        if hot_key_rows:  # a cell's pairs are no more than its key's
            hot = busy.filter(F.col("__pairs") > F.lit(hot_key_rows)).select(*keys)
        busy = materialize(busy.filter("__saves").select(*keys, F.lit(True).alias("__busy")), "bridge_divided_keys")
        if not busy.isEmpty():
            divided = F.coalesce(F.col("__busy"), F.lit(False))
            near_d = with_cells_within(near_d.join(busy, keys, "left"), radius_km, divided).drop("__busy")
            near_s = with_cell(near_s.join(busy, keys, "left"), radius_km, divided, unit="__v").drop("__busy")
            near_keys = [*keys, *_CELL]
        if hot is not None and not hot.isEmpty():
            near_d, near_s, near_keys = _split_hot_keys(near_d, near_s, near_keys, hot_key_rows, salts, hot)
    # cosines are taken after the join, as few pairs need them and all rows would carry them
    place = ("__dlat", "__dlon", cos_lat("__dlat"), "__slat", "__slon", cos_lat("__slat"))
    near = (near_d.join(near_s, near_keys)
            .filter(within_radius(radius_km, *place, units=("__u", "__v")))
            .withColumn("__km", raw_haversine_parts_km(*place)).withColumn("__dist", round_km("__km")))
    # without a latitude: every event of the day. Those events are result rows, not mere candidates
    all_d, all_s, all_keys = _split_hot_keys(days(d.filter(F.col("__dlat").isNull())), s, keys, hot_key_rows, salts)
    everywhere = all_d.join(all_s, all_keys).withColumn("__dist", F.lit(None).cast("double"))
    out = ["DisasterKey", "SeismicKey", F.col("__dist").cast(distance).alias("DistanceKM"),
           F.col("TimeLagDays").cast("int").alias("TimeLagDays")]
    return near.select(*out).unionByName(everywhere.select(*out))


def busy_keys(d: DataFrame, s: DataFrame, days, keys: list[str], radius_km: float, pairs_per_row: int) -> DataFrame:
    """Keys that make more than ``pairs_per_row`` pairs a row, their pairs and whether cells would save some (``__saves``).

    Disasters are counted by start and cube before they are dealt out to their days. A disaster takes ``CELLS_TAKEN``
    cubes, so of a key's pairs about so many times those inside one cube are left, and its copies cost rows.
    """
    cells = materialize(with_cell(d, radius_km, F.lit(True), unit="__u").groupBy("__geo", "__start", *_CELL).agg(F.count(F.lit(1)).alias("__n")), "bridge_starts")
    asked = days(cells.groupBy("__geo", "__start").agg(F.sum("__n").alias("__n"))).groupBy(*keys).agg(F.sum("__n").alias("__asked"))
    rows = F.col("__events") + F.col("__asked")
    busy = materialize(_pairs(s, materialize(asked, "bridge_asked"), keys).filter(F.col("__pairs") > F.lit(pairs_per_row) * rows), "bridge_busy_keys")
    if busy.isEmpty():
        return busy.withColumn("__saves", F.lit(False))
    inside = (with_cell(s.join(busy.select(*keys), keys, "left_semi"), radius_km, F.lit(True), unit="__v").groupBy(*keys, *_CELL).agg(F.count(F.lit(1)).alias("__e"))
              .join(days(cells).groupBy(*keys, *_CELL).agg(F.sum("__n").alias("__a")), [*keys, *_CELL])
              .groupBy(*keys).agg((F.lit(CELLS_TAKEN) * F.sum(F.col("__e") * F.col("__a"))).alias("__inside")))
    left = F.least(F.coalesce(F.col("__inside"), F.lit(0.0)), F.col("__pairs"))
    return materialize(busy.join(inside, keys, "left").select(
        *keys, "__pairs", (left + F.lit(pairs_per_row) * F.col("__asked") <= F.col("__pairs")).alias("__saves")), "bridge_busy_cells")


def candidate_pairs(d: DataFrame, s: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs each key makes (``__pairs``) and its events (``__events``); only events of touched keys are shuffled."""
    # stored, as both joins read it
    return _pairs(s, materialize(d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__asked")), "bridge_asked"), keys)


def _pairs(s: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    held = s.join(asked.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("__events"))
    return held.join(asked, keys).withColumn("__pairs", F.col("__events") * F.col("__asked"))


def _split_hot_keys(d: DataFrame, s: DataFrame, keys: list[str], hot_key_rows: int | None,
                    salts: int | None, only: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Salt only the hot join keys, each by as many salts as its pairs call for; other keys keep salt 0. ``only``: rows that can be hot."""
    if not hot_key_rows:
        return d, s, keys
    parts = F.least(F.ceil(F.col("__pairs") / F.lit(hot_key_rows)), F.col("__events"))
    if salts:
        parts = F.least(parts, F.lit(salts))
    counted = (d, s) if only is None else tuple(x.join(only, only.columns, "left_semi") for x in (d, s))
    hot = materialize(candidate_pairs(*counted, keys).filter(F.col("__pairs") > hot_key_rows)
                      .select(*keys, parts.cast("int").alias("__parts")), "bridge_hot_keys")
    if hot.isEmpty():
        return d, s, keys
    # no forced broadcast: hot keys grow with the rows, and a skewed left join is split by AQE
    salt = F.pmod(F.xxhash64("SeismicKey"), F.coalesce(F.col("__parts"), F.lit(1))).cast("int")
    s = s.join(hot, keys, "left").withColumn("__salt", salt).drop("__parts")
    d = (d.join(hot, keys, "left")
         .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1)))
         .drop("__parts"))
    return d, s, [*keys, "__salt"]


def without_links(disasters: DataFrame, bridge: DataFrame) -> DataFrame:
    """Disasters that have no bridge row. A disaster has many links, so their keys are made distinct before the shuffle."""
    return keep_where_missing(disasters, bridge.select("DisasterKey").distinct(), "DisasterKey")


def links_per(disasters: DataFrame, bridge: DataFrame) -> DataFrame:
    """Number of links per disaster, zero included.

    Pre-aggregates the bridge per disaster before the join, so the join moves one
    row per disaster instead of one row per link.
    """
    per = bridge.groupBy("DisasterKey").agg(F.count("SeismicKey").alias("__n"))
    return (disasters.select("DisasterKey").join(per, "DisasterKey", "left")
            .select("DisasterKey", F.coalesce(F.col("__n"), F.lit(0)).cast("bigint").alias("n")))
