"""Row filters, trims and membership joins used before counting flows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgrid.functions.columns import duration_minutes, haversine_km, normalize_station_id
from flowgrid.operators.joins import bounded_broadcast
from flowgrid.operators import sketches
from flowgrid.operators.scan import exact_quantiles
from flowgrid.session import materialize

TRIP_REQUIRED = ["started_at", "ended_at", "start_station_id", "end_station_id", "rideable_type", "member_casual"]
STATION_REQUIRED = ["id", "short_name", "station_id", "name", "capacity", "lat"]
WEATHER_REQUIRED = ["temp", "relative_humidity", "precipitation_total", "average_wind_speed", "coco"]


def filter_complete_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where all ``cols`` are non-null (pushed to the scan as
    IsNotNull filters)."""
    return df.dropna(how="any", subset=list(cols))


def normalize_ids(df: DataFrame, cols: Sequence[str] = ("start_station_id", "end_station_id")) -> DataFrame:
    """Normalise station ids *in place*, so raw and padded spellings count as
    one station."""
    return df.withColumns({c: normalize_station_id(c) for c in cols})


def semi_valid_stations(trips: DataFrame, stations: DataFrame, key: str = "short_name",
                        cols: Sequence[str] = ("start_station_id", "end_station_id"),
                        max_broadcast_rows: int = 5_000_000) -> DataFrame:
    """Keep trips whose start and end stations exist (two EXISTS predicates).

    The station key set is a dimension; it is broadcast only after its row
    count is checked, otherwise the semi joins shuffle."""
    keys = bounded_broadcast(stations.select(F.col(key).alias("_k")).distinct(), max_broadcast_rows)
    out = trips
    for c in cols:
        out = out.join(keys, out[c] == keys["_k"], "left_semi")
    return out


def anti_unknown_stations(trips: DataFrame, stations: DataFrame, key: str = "short_name",
                          cols: Sequence[str] = ("start_station_id", "end_station_id")) -> DataFrame:
    """Station ids seen in trips (start or end) that the dimension lacks."""
    seen = None
    for c in cols:
        s = trips.select(F.col(c).alias("station_id")).where(F.col("station_id").isNotNull())
        seen = s if seen is None else seen.unionByName(s)
    return seen.distinct().join(stations.select(F.col(key).alias("station_id")), "station_id", "left_anti")


def with_duration(df: DataFrame, start: str = "started_at", end: str = "ended_at",
                  out: str = "duration_minutes", round_to: int | None = None) -> DataFrame:
    return df.withColumn(out, duration_minutes(start, end, round_to))


def filter_duration_range(df: DataFrame, col: str = "duration_minutes", lo: float = 1, hi: float = 80) -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


def trim_quantiles(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99, method: str = "ordered") -> DataFrame:
    """Keep rows with q_lo <= col <= q_hi.  The two statistics come back as
    literals, so the filter is a plain predicate.  ``method`` is ``ordered``
    (exact interpolated quantiles by an ordered scan), ``bounds`` (the same
    values; a sketch limits what is ordered) or ``approximate`` (the sketch's
    quantiles, within its rank error)."""
    how = {"ordered": exact_quantiles, "bounds": sketches.quantiles_by_rank_bounds, "approximate": sketches.approx_quantiles}
    q_lo, q_hi = how[method](df, col, [lo, hi])
    if q_lo is None:
        return df.where(F.lit(False))
    return df.where(F.col(col).between(F.lit(q_lo), F.lit(q_hi)))


def trim_sigma(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Keep mu - k*sigma <= col <= mu + k*sigma (sample sigma).  One partial +
    final aggregate; with a single row sigma is null and nothing is kept."""
    mu, sigma = df.agg(F.avg(col), F.stddev_samp(col)).first()
    if mu is None or sigma is None:
        return df.where(F.lit(False))
    return df.where(F.col(col).between(F.lit(mu - k * sigma), F.lit(mu + k * sigma)))


def with_distance(df: DataFrame, out: str = "distance_km_rounded") -> DataFrame:
    return df.withColumn(out, haversine_km("start_lat", "start_lng", "end_lat", "end_lng", 2))


def clean_trips(trips: DataFrame, stations: DataFrame, *, min_minutes: float = 1, max_minutes: float = 80,
                q_lo: float = 0.01, q_hi: float = 0.99, sigma_k: float = 3.0,
                order: str = "range_then_quantiles", trims: bool = True) -> DataFrame:
    """Staging -> cleaned -> features chain of the trip models.

    ``order='range_then_quantiles'`` is the SQL order (1-80 min first, then
    quantiles); ``'quantiles_then_range'`` is the notebook order, which also
    rounds minutes to 2 decimals first."""
    t = filter_complete_rows(trips, TRIP_REQUIRED)
    st = filter_complete_rows(stations, STATION_REQUIRED)
    if order == "range_then_quantiles":
        # the range goes first: ids are rewritten and looked up for the trips inside it alone
        t = with_duration(t)
        t = filter_duration_range(t, "duration_minutes", min_minutes, max_minutes)
        t = semi_valid_stations(normalize_ids(t), st)
        if trims:
            # read by two statistics passes and the final filter: write once
            t = materialize(t, "trips-in-range")
            t = trim_quantiles(t, "duration_minutes", q_lo, q_hi)
    elif order == "quantiles_then_range":
        t = semi_valid_stations(normalize_ids(t), st)
        t = with_duration(t, round_to=2)
        if trims:
            t = materialize(t, "trips-timed")
            t = trim_quantiles(t, "duration_minutes", q_lo, q_hi)
        t = filter_duration_range(t, "duration_minutes", min_minutes, max_minutes)
    else:
        raise ValueError(order)
    if trims:
        t = with_distance(t)
        t = trim_sigma(t, "distance_km_rounded", sigma_k)
    return t
