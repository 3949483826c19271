"""Column expressions used across the engine.

All of these are plain Catalyst expressions (no Python UDFs), so they stay
inside whole-stage code generation and run on every executor.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Weekday names in French, Sunday first (the grid's `jour_semaine`).
WEEKDAYS_FR_SUNDAY_FIRST = ["Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi"]
# Weather-code groups: codes 1-6 no rain, 17 shower, 8-16 and 18-27 rain/snow, anything else "Autre".
COCO_NO_RAIN = [1, 2, 3, 4, 5, 6]
COCO_SHOWER = [17]
COCO_RAIN_SNOW = [8, 9, 10, 11, 12, 13, 14, 15, 16, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27]
COCO_GROUP_NO_RAIN = "Pas de pluie"
COCO_GROUP_SHOWER = "Averse de pluie"
COCO_GROUP_RAIN_SNOW = "Pluie/Neige"
COCO_GROUP_OTHER = "Autre"
# Weather-code labels (code 1..27).
COCO_LABELS = {
    1: "Ciel dégagé - 1",
    2: "Temps clair - 2",
    3: "Nuageux - 3",
    4: "Ciel couvert - 4",
    5: "Brouillard - 5",
    6: "Brouillard givrant - 6",
    7: "Pluie légère - 7",
    8: "Pluie - 8",
    9: "Pluie forte - 9",
    10: "Pluie verglaçante - 10",
    11: "Pluie verglaçante forte - 11",
    12: "Grésil - 12",
    13: "Grêle forte - 13",
    14: "Chutes de neige légères - 14",
    15: "Chutes de neige - 15",
    16: "Fortes chutes de neige - 16",
    17: "Averse de pluie - 17",
    18: "Fortes averses de pluie - 18",
    19: "Averse de grésil - 19",
    20: "Fortes averses de grésil - 20",
    21: "Averse de neige - 21",
    22: "Fortes averses de neige - 22",
    23: "Foudre - 23",
    24: "Grêle - 24",
    25: "Orage - 25",
    26: "Fort orage - 26",
    27: "Tempête - 27",
}
# Hour bands: morning peak [6, 10), evening peak [16, 20), rest of the day.
HOUR_BAND_MORNING = "Heure de\npointe matin\n6h-10h"
HOUR_BAND_EVENING = "Heure de\npointe soir\n16h-20h"
HOUR_BAND_REST = "Reste\njournée"
WEEKEND_DAYS_FR = ["Samedi", "Dimanche"]
# Earth radius: 6371 km for the trip-distance model, 3961 miles in the macro library.
EARTH_RADIUS_KM = 6371.0
EARTH_RADIUS_MI = 3961.0
MI_TO_KM = 1.60934


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Station ids, durations, distances
# ---------------------------------------------------------------------------
def normalize_station_id(c) -> Column:
    """Text id; when exactly one character follows the first dot, append '0'
    (``5980.1`` -> ``5980.10``).  Only part 2 of a dotted id is kept, as in the
    SQL model."""
    s = _c(c).cast("string")
    head = F.substring_index(s, ".", 2)  # the first two parts: one character after the first dot ends them
    dot = F.instr(s, ".")
    return F.when((dot > 0) & (F.length(head) == dot + 1), F.concat(head, F.lit("0"))).otherwise(s)


def duration_minutes(start, end, round_to: int | None = None) -> Column:
    """Minutes between two TIMESTAMP_NTZ values (exact, microsecond based)."""
    d = F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(60000000.0)
    return F.round(d, round_to) if round_to is not None else d


def haversine_km(lat1, lon1, lat2, lon2, round_to: int | None = 2) -> Column:
    """Great-circle distance with R = 6371 km (trip model), rounded to 2."""
    la1, lo1, la2, lo2 = map(_c, (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians(la2 - la1) / 2), 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.pow(F.sin(F.radians(lo2 - lo1) / 2), 2))
    d = F.lit(EARTH_RADIUS_KM) * 2 * F.asin(F.sqrt(a))
    return F.round(d, round_to) if round_to is not None else d


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Macro-library variant: R = 3961 miles; ``unit='km'`` multiplies by 1.60934."""
    if unit not in ("mi", "km"):
        raise ValueError("unit must be 'mi' or 'km'")
    la1, lo1, la2, lo2 = map(_c, (lat1, lon1, lat2, lon2))
    d = F.lit(2 * EARTH_RADIUS_MI) * F.asin(F.sqrt(
        F.pow(F.sin((F.radians(la2) - F.radians(la1)) / 2), 2)
        + F.cos(F.radians(la1)) * F.cos(F.radians(la2))
        * F.pow(F.sin((F.radians(lo2) - F.radians(lo1)) / 2), 2)))
    return d * F.lit(MI_TO_KM) if unit == "km" else d


# ---------------------------------------------------------------------------
# Time parts (time-zone free on TIMESTAMP_NTZ)
# ---------------------------------------------------------------------------
def hour_floor(c) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, staying NTZ (``date_trunc``
    would return a zoned TIMESTAMP)."""
    x = _c(c)
    return F.make_timestamp_ntz(F.year(x), F.month(x), F.dayofmonth(x), F.hour(x),
                                F.lit(0), F.lit(0))


def day_floor(c) -> Column:
    x = _c(c)
    return F.make_timestamp_ntz(F.year(x), F.month(x), F.dayofmonth(x), F.lit(0), F.lit(0), F.lit(0))


def weekday_label(c, names: Sequence[str] = WEEKDAYS_FR_SUNDAY_FIRST) -> Column:
    """Weekday name from a timestamp/date; ``names`` is Sunday-first."""
    arr = F.array(*[F.lit(n) for n in names])
    return F.element_at(arr, F.dayofweek(_c(c)))


def hour_band(hour) -> Column:
    h = _c(hour)
    return (F.when((h >= 6) & (h < 10), F.lit(HOUR_BAND_MORNING))
            .when((h >= 16) & (h < 20), F.lit(HOUR_BAND_EVENING))
            .otherwise(F.lit(HOUR_BAND_REST)))


def calendar_features(hour="hour", day="day", month="month", weekday="jour_semaine") -> dict[str, Column]:
    h, d, m, wd = map(_c, (hour, day, month, weekday))
    two_pi = 2 * math.pi
    return {
        "hour_sin": F.sin(F.lit(two_pi) * h / 24), "hour_cos": F.cos(F.lit(two_pi) * h / 24),
        "day_sin": F.sin(F.lit(two_pi) * d / 31), "day_cos": F.cos(F.lit(two_pi) * d / 31),
        "month_sin": F.sin(F.lit(two_pi) * m / 12), "month_cos": F.cos(F.lit(two_pi) * m / 12),
        "is_weekend": wd.isin(*WEEKEND_DAYS_FR).cast("int"),
        "is_peak": (((h >= 6) & (h < 10)) | ((h >= 16) & (h < 20))).cast("int"),
    }


def weather_flags(temp="temp", precip="precipitation_total") -> dict[str, Column]:
    """Comparisons cast to int; a null input gives 0 (pandas semantics)."""
    t, p = _c(temp), _c(precip)
    z = lambda cond: F.coalesce(cond.cast("int"), F.lit(0))
    return {"is_rain": z(p > 0), "cold_weather": z(t < 5), "hot_weather": z(t > 30),
            "heavy_rain": z(p > 5)}


# ---------------------------------------------------------------------------
# Weather codes
# ---------------------------------------------------------------------------
def weather_code_parse(c) -> Column:
    """Text code kept only when it looks like a number; then rounded (not
    truncated) to an integer, as a numeric->integer cast does in Postgres."""
    s = _c(c)
    return F.when(s.rlike(r"^\d+(\.\d+)?$"),
                  F.round(s.try_cast("double")).cast("int"))


def weather_code_group(c, unmapped: str | None = COCO_GROUP_OTHER) -> Column:
    x = _c(c)
    e = (F.when(x.isin(*COCO_NO_RAIN), F.lit(COCO_GROUP_NO_RAIN))
         .when(x.isin(*COCO_SHOWER), F.lit(COCO_GROUP_SHOWER))
         .when(x.isin(*COCO_RAIN_SNOW), F.lit(COCO_GROUP_RAIN_SNOW)))
    return e.otherwise(F.lit(unmapped)) if unmapped is not None else e


def weather_code_label(c) -> Column:
    m = F.create_map(*[v for k, lab in COCO_LABELS.items() for v in (F.lit(k), F.lit(lab))])
    return F.element_at(m, _c(c).cast("int"))


# ---------------------------------------------------------------------------
# Macro-library scalar helpers
# ---------------------------------------------------------------------------
def nullif_empty(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def safe_add(*cols) -> Column:
    out = F.lit(0)
    for c in cols:
        out = out + F.coalesce(_c(c), F.lit(0))
    return out


def surrogate_key(*cols) -> Column:
    """md5 of the text forms joined with '-', null as ''."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def width_bucket(x, lo, hi, n: int, mode: str = "edge_mod") -> Column:
    """``native``: Spark's width_bucket.  ``edge_mod``: the macro arithmetic,
    ceil((x-min)/bin) capped at n+1, plus one when mod(x, bin) = 0."""
    xc, loc, hic = _c(x), _c(lo), _c(hi)
    if mode == "native":
        return F.width_bucket(xc, loc, hic, F.lit(n))
    if mode != "edge_mod":
        raise ValueError("mode must be 'native' or 'edge_mod'")
    bin_size = (hic - loc) / F.lit(n)
    base = F.least(F.ceil((xc - loc) / bin_size), F.lit(n + 1))
    return (base + F.when(F.pmod(xc, bin_size) == 0, 1).otherwise(0)).cast("int")


def array_to_text(c) -> Column:
    """``[1,2,3]`` with no blanks (Spark's cast adds blanks)."""
    return F.concat(F.lit("["), F.array_join(_c(c).cast("array<string>"), ","), F.lit("]"))


def right_chars(c, n: int) -> Column:
    """Rightmost n chars; negative n drops the first |n| chars (Postgres)."""
    s = _c(c)
    if n >= 0:
        return F.right(s, F.lit(n))
    return F.substring(s, -n + 1, 2147483647)


def bool_text(c) -> Column:
    return _c(c).cast("string")


def coalesce_defaults(cols: Iterable[str], default) -> dict[str, Column]:
    return {c: F.coalesce(F.col(c), F.lit(default)) for c in cols}
