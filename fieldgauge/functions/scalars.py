"""Column functions: bands, seasons, calendar buckets, encodings, guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from fieldgauge.schemas import SITE_ID_PATTERN, VERSION_PATTERN

# fixed values: band edges and names, seasons, monsoon regimes
ELEVATION_BANDS = ((200, "lowland"), (1000, "midland"), (3000, "highland"))
TOP_BAND = "alpine"
NORTHERN = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "autumn": (9, 10, 11)}
OPPOSITE = {"winter": "summer", "spring": "autumn", "summer": "winter", "autumn": "spring"}
METEOROLOGICAL = {"DJF": (12, 1, 2), "MAM": (3, 4, 5), "JJA": (6, 7, 8), "SON": (9, 10, 11)}
MONSOONS = {
    "northeast_monsoon": (12, 1, 2),
    "first_intermonsoon": (3, 4),
    "southwest_monsoon": (5, 6, 7, 8, 9),
    "second_intermonsoon": (10, 11),
}
GRAINS = ("hour", "day", "week", "month", "year")
PERIOD_GRAIN = {"daily": "day", "weekly": "week", "monthly": "month", "yearly": "year"}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(key: Column, table: dict[str, tuple[int, ...]]) -> Column:
    """First label whose list holds the key, in the order given."""
    return F.coalesce(*[F.when(key.isin(*keys), F.lit(label)) for label, keys in table.items()])


def elevation_band(elevation: Column | str) -> Column:
    """lowland / midland / highland / alpine; an unknown height counts as alpine."""
    height = col(elevation)
    chain = reduce(
        lambda acc, edge: acc.when(height < edge[0], edge[1]),
        ELEVATION_BANDS[1:],
        F.when(height < ELEVATION_BANDS[0][0], ELEVATION_BANDS[0][1]),
    )
    return chain.otherwise(TOP_BAND)


def local_season(month: Column | str, latitude: Column | str) -> Column:
    """Season as felt at the site: flipped south of the equator (the equator is north)."""
    south = {OPPOSITE[name]: months for name, months in NORTHERN.items()}
    month = col(month)
    return F.when(col(latitude) >= 0, _lookup(month, NORTHERN)).otherwise(_lookup(month, south))


def met_season(day: Column | str) -> Column:
    return _lookup(F.month(col(day)), METEOROLOGICAL)


def season_year(day: Column | str) -> Column:
    """Year a meteorological season is counted in: December opens the next one."""
    day = col(day)
    return F.year(day) + (F.month(day) == 12).cast("int")


def season_start(season: Column | str, year: Column | str) -> Column:
    """First day of a meteorological season."""
    season, year = col(season), col(year)
    first_month = F.coalesce(
        *[F.when(season == name, F.lit(months[0])) for name, months in METEOROLOGICAL.items()]
    )
    return F.make_date(year - (season == "DJF").cast("int"), first_month, F.lit(1))


def monsoon(month: Column | str) -> Column:
    return _lookup(col(month), MONSOONS)


def bucket(ts: Column | str, grain: str) -> Column:
    """Start of the hour (timestamp) or of the day, ISO week, month or year (date)."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; use one of {GRAINS}")
    start = F.date_trunc(grain, col(ts))
    return start if grain == "hour" else start.cast("date")


def days_in_year(year: Column | str) -> Column:
    year = col(year)
    return F.datediff(F.make_date(year + 1, F.lit(1), F.lit(1)), F.make_date(year, F.lit(1), F.lit(1)))


def iso_week(day: Column | str) -> Column:
    """ISO label such as ``2020-W53``."""
    day = col(day)
    return F.format_string(
        "%d-W%02d", F.extract(F.lit("YEAROFWEEK"), day).cast("int"), F.weekofyear(day)
    )


def from_iso_week(label: Column | str) -> Column:
    """Monday of an ISO week label; week 1 is the one that holds 4 January."""
    parts = F.split(col(label), "-W")
    first = bucket(F.make_date(parts[0].cast("int"), F.lit(1), F.lit(4)), "week")
    return F.date_add(first, (parts[1].cast("int") - 1) * 7)


def period_dates(start: Column | str, end: Column | str, period: str) -> Column:
    """Array with the start of every period touched by the closed day range."""
    grain = PERIOD_GRAIN[period]
    return F.sequence(
        bucket(start, grain), col(end).cast("date"), F.expr(f"interval 1 {grain}")
    )


def equal_width_edges(low: Column, high: Column) -> Column:
    """Edges of 4 equal-width classes, or 5 once the highest site reaches 3000 m."""
    n = F.when(high >= 3000, 5).otherwise(4)
    top = F.when(high > low, high).otherwise(low + n)
    return F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.when(i == n, top).otherwise(low + i * ((top - low) / n)),
    )


def class_of(value: Column | str, edges: Column) -> Column:
    """Index of the class that holds the value; an edge belongs to the class above it."""
    v = col(value)
    last = F.size(edges) - 2
    return F.greatest(
        F.lit(0), F.least(F.size(F.filter(edges, lambda e: e <= v)) - 1, last)
    )


def digitize(value: Column | str, edges: tuple[float, ...]) -> Column:
    """Number of edges at or below the value (edges ascending)."""
    v = col(value)
    return reduce(lambda acc, e: acc + (v >= e).cast("int"), edges, F.lit(0))


def cyclic(value: Column | str, period: float) -> tuple[Column, Column]:
    angle = col(value) * (2.0 / period) * F.pi()
    return F.sin(angle), F.cos(angle)


def rescale(value: Column | str, factor: float) -> Column:
    """Change of unit by a constant, e.g. metres to km or hourly mean rain to a day."""
    return col(value) * F.lit(float(factor))


def as_utc(ts: Column | str, zone: Column | str | None = None) -> Column:
    """UTC instant: naive readings are UTC already unless a zone is given."""
    stamp = col(ts).cast("timestamp")
    return stamp if zone is None else F.to_utc_timestamp(stamp, zone)


def epoch_seconds(ts: Column | str) -> Column:
    return col(ts).cast("timestamp").cast("long")


def valid_id(value: Column | str, pattern: str = VERSION_PATTERN) -> Column:
    return F.coalesce(col(value).rlike(pattern), F.lit(False))


def valid_site_id(value: Column | str) -> Column:
    return valid_id(value, SITE_ID_PATTERN)


def is_finite(value: Column | str) -> Column:
    v = col(value)
    return F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))


def safe_div(a: Column | str, b: Column | str) -> Column:
    """NULL instead of a failure or a non-finite value."""
    q = F.try_divide(col(a), col(b))
    return F.when(is_finite(q), q)
