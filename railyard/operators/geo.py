"""Event windows, geography and expected demand.

* J6  interval join: both sides are cut into time buckets and meet on the
      station and the bucket, so a station with many windows or taps is spread
      over its buckets; a pair that shares several buckets counts in the one
      where the later of the two begins.  An equi-join, never a nested loop.
      ``overlap_totals`` counts the pairs of two such sides without forming them.
* J7  exact nearest station without a cross join, on cells of the unit
      sphere's 3-D coordinates, which know no date line and no poles.  Points
      near the network meet the stations of the 27 cells around theirs, ring by
      ring of larger cells, and are done when no station outside can be nearer.
      Points farther off descend a tree of the occupied cells: at each level
      only cells whose nearest corner is not farther than some station already
      known are opened, so no cell meets all stations.
* J11 / N9  distances and expected shares for *observed* origin-destination
      pairs only (equi-joins to the station dimension; the normaliser of the
      expected share is computed in closed form), never all pairs.
* N7, N8, N10  event days, expected demand shares, demand profiles.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard import constants as C
from railyard.functions import columns as X
from railyard.session import scratch_path

def exploded_events(calendar: DataFrame) -> DataFrame:
    return calendar.select("event_id", F.explode("station_ids").alias("_ev_station"),
                           "start_ts", "end_ts", "uplift_multiplier")


def _bucket(ts, seconds: int):
    return F.floor(ts.cast("timestamp").cast("bigint") / seconds)


def interval_join(left: DataFrame, right: DataFrame, keys, left_span, right_span, seconds: int = 6 * 3600) -> DataFrame:
    """Pairs of rows with equal ``keys`` (names of both sides, no nulls) whose
    closed time spans, pairs of column names, overlap; a span of one column
    twice is an instant.  All other column names must differ.  Each side gives a
    row per bucket of ``seconds`` that its span touches; a span that ends before
    it starts, or has a null end, matches nothing."""
    (ls, le), (rs, re) = left_span, right_span

    def cut(df, start, end):
        if start == end:
            return df.withColumn("_b", _bucket(F.col(start), seconds))
        whole = df.where(F.col(start) <= F.col(end))
        return whole.withColumn("_b", F.explode(F.sequence(_bucket(F.col(start), seconds), _bucket(F.col(end), seconds))))

    both = cut(left, ls, le).join(cut(right, rs, re), [*keys, "_b"])
    met = both.where((F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)))
    if ls != le and rs != re:
        met = met.where(F.col("_b") == _bucket(F.greatest(ls, rs), seconds))
    return met.drop("_b")


def overlap_totals(left: DataFrame, right: DataFrame, keys, left_span, right_span, left_id: str, right_id: str,
                   seconds: int = 6 * 3600) -> DataFrame:
    """What the pairs of ``interval_join`` add up to, per ``keys`` and day on
    which the left span begins: (*keys, day, pairs, lefts, rights, first), the
    number of pairs, of distinct ``left_id`` and ``right_id`` in them, and the
    first moment that a pair shares.  Pairs are counted and never formed, so the
    work grows with the rows and not with the pairs:

    * a span meets as many others as have begun by its end, less those that
      ended before its start.  Both ends of every span are put in order within
      a bucket, and sums over the buckets (one row each) carry what lies before;
    * the first moment is the left start if a right span is open then, else the
      next right start;
    * a right span meets a day on which it does not end if the day's last left
      end is not before its start: an interval join with one span per day.  On
      the day on which it ends, only left spans begun by then count."""
    (ls, le), (rs, re) = left_span, right_span
    left = left.where(F.col(ls) <= F.col(le)).dropna(subset=keys)
    right = right.where(F.col(rs) <= F.col(re)).dropna(subset=keys)

    def marks(df, at, order, **more):
        return df.select(*keys, F.col(at).alias("_t"), F.lit(order).alias("_o"), F.to_date(at).alias("_d"),
                         _bucket(F.col(at), seconds).alias("_b"), *[c.alias(n) for n, c in more.items()])

    # at one moment right spans begin first and end last: bounds are closed
    day = F.to_date(ls)
    all_marks = marks(right, rs, 0)
    for m in (marks(left, ls, 1, _day=day, _left=F.col(left_id), _until=F.col(le)), marks(left, le, 1, _day=day),
              marks(right, re, 2, _right=F.col(right_id), _since=F.col(rs))):
        all_marks = all_marks.unionByName(m, allowMissingColumns=True)
    begins, ends = F.when(F.col("_o") == 0, F.col("_t")), F.when(F.col("_o") == 2, F.col("_t"))

    cell, upto, before = [*keys, "_d", "_b"], (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)
    forth = Window.partitionBy(*keys).orderBy("_d", "_b").rowsBetween(*before)
    back = Window.partitionBy(*keys).orderBy(F.desc("_d"), F.desc("_b")).rowsBetween(*before)
    today = Window.partitionBy(*keys, "_d").orderBy("_b").rowsBetween(*before)
    cells = (all_marks.groupBy(*cell).agg(F.count(begins).alias("_begun"), F.count(ends).alias("_ended"),
                                          F.min(begins).alias("_next"), F.max("_until").alias("_last"))
             .select(*cell, F.coalesce(F.sum("_begun").over(forth), F.lit(0)).alias("_begun0"),
                     F.coalesce(F.sum("_ended").over(forth), F.lit(0)).alias("_ended0"),
                     F.min("_next").over(back).alias("_next0"), F.max("_last").over(today).alias("_last0")))
    forth = Window.partitionBy(*cell).orderBy("_t", "_o").rowsBetween(*upto)
    back = Window.partitionBy(*cell).orderBy(F.desc("_t"), F.desc("_o")).rowsBetween(*upto)
    placed = (all_marks.withColumn("_begun", F.count(begins).over(forth)).withColumn("_ended", F.count(ends).over(forth))
              .withColumn("_last", F.max("_until").over(forth)).withColumn("_next", F.min(begins).over(back))
              .join(cells, cell)
              .select(*keys, "_o", "_t", "_d", "_day", "_left", "_until", "_right", "_since",
                      (F.col("_begun") + F.col("_begun0")).alias("_begun"), (F.col("_ended") + F.col("_ended0")).alias("_ended"),
                      F.least("_next", "_next0").alias("_next"), F.greatest("_last", "_last0").alias("_last")))

    at_start = F.col("_until").isNotNull()
    first = F.when(F.col("_begun") > F.col("_ended"), F.col("_t")).when(F.col("_next") <= F.col("_until"), F.col("_next"))
    first = F.when(at_start, first)
    of_left = (placed.where("_o = 1").groupBy(*keys, F.col("_day").alias("day"))
               .agg(F.sum(F.when(at_start, -F.col("_ended")).otherwise(F.col("_begun"))).alias("pairs"),
                    F.countDistinct(F.when(first.isNotNull(), F.col("_left"))).alias("lefts"), F.min(first).alias("first"))
               .where("pairs > 0"))

    days = left.groupBy(*keys, day.alias("_day")).agg(F.min(ls).alias("_from"), F.max(le).alias("_to"))
    spans = right.select(*keys, F.col(right_id).alias("_right"), F.col(rs).alias("_since"), F.col(re).alias("_till"))
    earlier = (interval_join(days, spans, keys, ("_from", "_to"), ("_since", "_till"), seconds)
               .where(F.col("_day") < F.to_date("_till")).select(*keys, "_day", "_right"))
    last_day = placed.where("_o = 2 AND _last >= _since").select(*keys, F.col("_d").alias("_day"), "_right")
    of_right = (earlier.unionByName(last_day).groupBy(*keys, F.col("_day").alias("day"))
                .agg(F.countDistinct("_right").alias("rights")))
    return of_left.join(of_right, [*keys, "day"]).select(*keys, "day", "pairs", "lefts", "rights", "first")


def event_hours(station_hours: DataFrame, calendar: DataFrame) -> DataFrame:
    """(station_id, tap_hour_utc) rows inside an event window at one of the
    event's stations, both bounds closed; one row per matching event."""
    ev = exploded_events(calendar).withColumnRenamed("_ev_station", "station_id")
    sh = station_hours.select("station_id", "tap_hour_utc").distinct()
    met = interval_join(sh, ev, ["station_id"], ("tap_hour_utc", "tap_hour_utc"), ("start_ts", "end_ts"))
    return met.select("station_id", "tap_hour_utc", "event_id", "uplift_multiplier")


def event_interval_join(silver: DataFrame, calendar: DataFrame) -> DataFrame:
    """Taps that fall in an event window at one of its stations."""
    ev = exploded_events(calendar).withColumnRenamed("_ev_station", "station_id")
    met = interval_join(silver, ev, ["station_id"], ("tap_timestamp_utc", "tap_timestamp_utc"), ("start_ts", "end_ts"))
    return (met.groupBy("event_id", "station_id")
            .agg(F.count(F.lit(1)).alias("event_taps"),
                 F.countDistinct("card_token").alias("event_riders"),
                 F.min("tap_timestamp_utc").alias("first_tap"),
                 F.max("tap_timestamp_utc").alias("last_tap")))


def event_days(calendar: DataFrame) -> DataFrame:
    """Calendar days touched by any event window."""
    d = calendar.select(F.explode(F.sequence(F.to_date("start_ts"), F.to_date("end_ts"),
                                             F.expr("INTERVAL 1 DAY"))).alias("service_date"))
    return d.distinct().withColumn("is_event_day", F.lit(True))


def event_station_bridge(calendar: DataFrame, stations: DataFrame) -> DataFrame:
    """Event -> station bridge from explicit station lists (N5), kept only for
    stations the dimension knows."""
    ev = exploded_events(calendar).withColumnRenamed("_ev_station", "station_id")
    return ev.join(stations.select("station_id", "name"), "station_id", "inner") \
             .select("event_id", "station_id", "name", "start_ts", "end_ts", "uplift_multiplier")


# --- nearest station (J7, N6) ------------------------------------------------------
#: Cell sides (chords of the unit sphere) of the rings around a point, about 12 and 100 km, and of the tree's levels.
RINGS, LEVELS = (1 / 512, 1 / 64), (1 / 2, 1 / 8, 1 / 32, 1 / 128, 1 / 512, 1 / 2048)
#: Slack of distance bounds against rounding.
SLACK = 1e-9
_XYZ = ("x", "y", "z")


def _on_sphere(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    """Unit-sphere coordinates ``<prefix>x``, ``y``, ``z``."""
    phi, theta = F.radians(lat), F.radians(lon)
    return (df.withColumn(prefix + "x", F.cos(phi) * F.cos(theta)).withColumn(prefix + "y", F.cos(phi) * F.sin(theta))
            .withColumn(prefix + "z", F.sin(phi)))


def _cell(prefix: str, side: float):
    return [F.floor(F.col(prefix + c) / side) for c in _XYZ]


def _cells(names, prefix: str, side: float):
    return [c.alias(n) for c, n in zip(_cell(prefix, side), names)]


def _chord(a: str, b: str):
    return F.sqrt(sum((F.col(a + c) - F.col(b + c)) ** 2 for c in _XYZ))


def _box_distance(prefix: str, cell, side: float):
    """Distance of a point to the nearest place of a cell."""
    gaps = [F.greatest(F.col(c) * side - F.col(prefix + k), F.col(prefix + k) - (F.col(c) + 1) * side, F.lit(0.0))
            for c, k in zip(cell, _XYZ)]
    return F.sqrt(sum(g * g for g in gaps))


def _nearest_of(pairs: DataFrame) -> DataFrame:
    """The nearest station of each point among its pairs (station_id may be null)."""
    distance = F.when(F.col("station_id").isNotNull(), X.haversine_km("lat", "lon", "s_lat", "s_lon"))
    return (pairs.withColumn("_d", distance).groupBy("point_id", "lat", "lon")
            .agg(F.min(F.when(F.col("_d").isNotNull(), F.struct(F.col("_d").alias("distance_km"), "station_id")))
                 .alias("_b"))
            .select("point_id", "lat", "lon", "_b.station_id", "_b.distance_km"))


def _in_ring(points: DataFrame, stations: DataFrame, side: float) -> DataFrame:
    """Points with the nearest station of the 27 cells around theirs, if any."""
    names = ("_ci", "_cj", "_ck")
    around = stations.select("station_id", "s_lat", "s_lon", *_cells(names, "s_", side))
    for n in names:
        around = around.withColumn(n, F.explode(F.array(*[F.col(n) + i for i in (-1, 0, 1)])))
    placed = points.select("point_id", "lat", "lon", *_cells(names, "p_", side))
    return _nearest_of(placed.join(around, list(names), "left"))


def _cell_tree(stations: DataFrame, side: float) -> DataFrame:
    """Occupied cells of a level, each with one of its stations and its parent
    cell, whose side is four times as long."""
    cell = ("_ci", "_cj", "_ck")
    out = (stations.select("station_id", "s_x", "s_y", "s_z", *_cells(cell, "s_", side)).groupBy(*cell)
           .agg(F.min(F.struct("station_id", "s_x", "s_y", "s_z")).alias("_s")))
    return out.select(*cell, *[F.floor(F.col(c) / 4).alias("_p" + c[2:]) for c in cell], "_s.s_x", "_s.s_y", "_s.s_z")


def _descend(points: DataFrame, stations: DataFrame) -> DataFrame:
    """Nearest stations by branch and bound over the tree of occupied cells."""
    cell, point = ["_ci", "_cj", "_ck"], ["point_id", "lat", "lon", "p_x", "p_y", "p_z"]
    per_point = Window.partitionBy("point_id", "lat", "lon")

    def opened(rows: DataFrame, side: float) -> DataFrame:
        """Cells not farther than the nearest of the stations known."""
        rows = rows.withColumn("_low", _box_distance("p_", cell, side)).withColumn("_up", _chord("p_", "s_"))
        rows = rows.withColumn("_best", F.min("_up").over(per_point)).where(F.col("_low") <= F.col("_best") + SLACK)
        return rows.select(*point, *cell)

    # the sphere passes through at most 98 cells of side 1/2, whatever the number of stations
    top = _cell_tree(stations, LEVELS[0]).select(*cell, "s_x", "s_y", "s_z").collect()
    if not top:
        return points.select("point_id", "lat", "lon", F.lit(None).cast("double").alias("distance_km"))
    first = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in (*cell, "s_x", "s_y", "s_z")]) for r in top])
    rows = opened(points.withColumn("_c", F.explode(first)).select(*point, "_c.*"), LEVELS[0])
    for side in LEVELS[1:]:
        rows = rows.select(*point, *[F.col(c).alias("_p" + c[2:]) for c in cell])
        rows = opened(rows.join(_cell_tree(stations, side), ["_pi", "_pj", "_pk"]), side)
    leaves = stations.select("station_id", "s_lat", "s_lon", *_cells(cell, "s_", LEVELS[-1]))
    return _nearest_of(rows.join(leaves, cell))


def nearest_station(points: DataFrame, stations: DataFrame, rings=RINGS) -> DataFrame:
    """For every (point_id, lat, lon) the nearest station by great-circle
    distance; ties go to the smaller station_id.  Exact: see module doc.  Points
    and stations without coordinates have no part in it.

    Each ring is staged once and the next step reads only its undecided points,
    so the points themselves are read a single time."""
    spark = points.sparkSession
    st = stations.select("station_id", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon")).dropna()
    st = _on_sphere(st, "s_lat", "s_lon", "s_")
    left, out = _on_sphere(points.select("point_id", "lat", "lon").dropna(subset=["lat", "lon"]), "lat", "lon", "p_"), None
    for side in rings:
        best, path = _in_ring(left, st, side), scratch_path(spark, "nearest")
        best.write.parquet(path)
        best = spark.read.schema(best.schema).parquet(path)
        # a station outside the 27 cells is farther than one side, as a chord
        reach_km = 2 * C.EARTH_RADIUS_KM * math.asin(side / 2) * (1 - SLACK)
        ok = F.coalesce(F.col("distance_km") < reach_km, F.lit(False))
        found = best.filter(ok).select("point_id", "station_id", "distance_km")
        left = _on_sphere(best.filter(~ok).select("point_id", "lat", "lon"), "lat", "lon", "p_")
        out = found if out is None else out.unionByName(found)
        if left.isEmpty():  # read from the staged ring: nothing is left for larger cells
            return out
    far = _descend(left, st)
    if "station_id" not in far.columns:
        return out
    far = far.select("point_id", "station_id", "distance_km")
    return far if out is None else out.unionByName(far)


def venue_stations(events: DataFrame, stations: DataFrame) -> DataFrame:
    """(event_id, station_id, distance_km): the nearest station of every venue
    event (N6), in the form that ``calendar_of`` and J6 take."""
    points = events.select(F.col("event_id").alias("point_id"), F.col("venue_latitude").alias("lat"),
                           F.col("venue_longitude").alias("lon")).filter(F.col("lat").isNotNull())
    return nearest_station(points, stations).withColumnRenamed("point_id", "event_id")


def dim_event(events: DataFrame, bridge: DataFrame) -> DataFrame:
    """Event dimension (N4): one row per venue event with its station."""
    return (events.select("event_id", "name", "venue_name", "start_ts", "end_ts", "expected_attendance")
            .join(bridge, "event_id", "left"))


def customer_points(customers: DataFrame) -> DataFrame:
    """Card-holder home points derived from the customer key (the test tables
    carry no coordinates); some fall far west of the network."""
    return customers.select(
        F.col("c_custkey").alias("point_id"),
        F.expr("CAST(42.8 + (c_custkey % 41) * 0.02 AS DOUBLE)").alias("lat"),
        F.expr("CAST(-79.0 - (c_custkey % 43) * 0.02 AS DOUBLE)").alias("lon"))


# --- observed origin-destination pairs (J11, N9) ------------------------------------
def od_pairs(trips: DataFrame) -> DataFrame:
    """Observed (origin, destination) pairs with trip counts: one grouped
    aggregate over the trips, so only pairs that occur are ever built."""
    return trips.groupBy("origin", "destination").agg(F.count(F.lit(1)).alias("trips"))


def station_distance_matrix(pairs: DataFrame, stations: DataFrame) -> DataFrame:
    """Great-circle distance for every observed station pair (J11): two
    equi-joins to the size-checked station dimension, no pair enumeration."""
    st = stations.select("station_id", "lat", "lon")
    o = st.select(F.col("station_id").alias("origin"), F.col("lat").alias("o_lat"),
                                    F.col("lon").alias("o_lon"))
    d = st.select(F.col("station_id").alias("destination"), F.col("lat").alias("d_lat"),
                                    F.col("lon").alias("d_lon"))
    j = pairs.join(o, "origin").join(d, "destination")
    return j.select("origin", "destination", "trips",
                    X.r6(X.haversine_km("o_lat", "o_lon", "d_lat", "d_lon")).alias("km_haversine"))


def od_share(pairs: DataFrame, priors: DataFrame) -> DataFrame:
    """Observed share of each OD pair against the expected share
    prior(o) x prior(d) / sum over o != d of prior x prior (N9).  The
    normaliser is (sum p)^2 - sum p^2, taken from the station-level priors,
    so no pair is enumerated; the observed total comes from per-origin
    totals (one row per station).  Priors and per-origin totals are station-
    level aggregates; AQE broadcasts them at run time when small."""
    everything = Window.partitionBy()                                # one row per station
    p = priors.select("station_id", "prior",
                      (F.pow(F.sum("prior").over(everything), 2)
                       - F.sum(F.pow("prior", 2)).over(everything)).alias("_z"))
    per_origin = pairs.groupBy("origin").agg(F.sum("trips").alias("_o"))
    per_origin = per_origin.withColumn("_all", F.sum("_o").over(everything))
    po = p.select(F.col("station_id").alias("origin"), F.col("prior").alias("_po"), "_z")
    pd = p.select(F.col("station_id").alias("destination"), F.col("prior").alias("_pd"))
    j = (pairs.join(per_origin.select("origin", "_all"), "origin")       # AQE broadcasts it if small
              .join(po, "origin", "left").join(pd, "destination", "left"))
    expected = F.when(F.col("origin") != F.col("destination"), F.col("_po") * F.col("_pd") / F.col("_z"))
    return j.select("origin", "destination", "trips",
                    X.r6(F.col("trips") / F.col("_all")).alias("observed_share"),
                    X.r6(expected).alias("expected_share"))


# --- priors, expected demand, profiles (A20, N8, N10) ------------------------------
def station_priors(silver: DataFrame) -> DataFrame:
    """Ridership prior per station = its share of all taps, renormalised so
    the priors sum to 1 (A20, D14)."""
    per = silver.groupBy("station_id").agg(F.count(F.lit(1)).alias("taps"))
    total = F.sum("taps").over(Window.partitionBy())     # one row per station
    return per.select("station_id", "taps", (F.col("taps") / total).alias("prior"))


def expected_demand(fact: DataFrame, priors: DataFrame, calendar: DataFrame) -> DataFrame:
    """Expected station share per observed hour: prior x demand curve x the
    product of active event multipliers, normalised over the hour (N8)."""
    hits = event_hours(fact.select("station_id", "tap_hour_utc"), calendar)
    mult = hits.groupBy("station_id", "tap_hour_utc").agg(
        F.exp(F.sum(F.log(F.col("uplift_multiplier")))).alias("_m"))
    f = (fact.select("station_id", "tap_hour_utc", "total_taps")
         .join(priors.select("station_id", "taps", "prior"), "station_id", "inner")   # AQE sizes it at run time
         .join(mult, ["station_id", "tap_hour_utc"], "left")
         .withColumn("event_multiplier", F.coalesce(F.col("_m"), F.lit(1.0)))
         .withColumn("_w", F.col("prior") * X.demand_curve(X.hour_of_day("tap_hour_utc")) * F.col("event_multiplier"))
         # the curve and the prior's denominator are common to every station of
         # an hour, so the normalised share is taps x multiplier over its hour sum
         .withColumn("_s", F.col("taps") * F.col("event_multiplier")))
    w = Window.partitionBy("tap_hour_utc")  # one hour holds at most one row per station
    return f.select("station_id", "tap_hour_utc",
                    X.r6("event_multiplier").alias("event_multiplier"),
                    X.r6("_w").alias("weight"),
                    X.r6(F.col("_s") / F.sum("_s").over(w)).alias("expected_share"),
                    X.r6(F.col("total_taps") / F.sum("total_taps").over(w)).alias("observed_share"))


def demand_profile(fact: DataFrame) -> DataFrame:
    """Hour-of-day share of taps and weekday factor (mean daily taps of the
    weekday over the mean daily taps), as one long table (N10)."""
    f = fact.select(X.hour_of_day("tap_hour_utc").alias("h"), F.to_date("tap_hour_utc").alias("d"), "total_taps")
    everything = Window.partitionBy()      # 24 hour rows / 7 weekday rows: tiny
    by_h = f.groupBy("h").agg(F.sum("total_taps").alias("_t"))
    hours = by_h.select(F.lit("hour_share").alias("profile"), F.col("h").alias("bucket"),
                        X.r6(F.col("_t") / F.sum("_t").over(everything)).alias("value"))
    daily = f.groupBy("d").agg(F.sum("total_taps").alias("_t")).withColumn("dw", X.dow_sunday0("d"))
    by_dw = daily.groupBy("dw").agg(F.sum("_t").alias("_s"), F.count(F.lit(1)).alias("_c"))
    overall = F.sum("_s").over(everything) / F.sum("_c").over(everything)   # mean daily taps
    days = by_dw.select(F.lit("weekday_factor").alias("profile"), F.col("dw").alias("bucket"),
                        X.r6((F.col("_s") / F.col("_c")) / overall).alias("value"))
    return hours.unionByName(days)
