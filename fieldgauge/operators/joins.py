"""Joins: site attributes, dense coverage grid, self and parity joins, neighbours.

No join is force-broadcast: site tables are usually small, and the runtime
switches to a broadcast once it has measured them.  A site table that has grown
too large, or a site that holds a third of all readings, falls to a sort-merge
join whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.functions.scalars import (
    elevation_band, local_season, met_season, season_year,
)
from fieldgauge.schemas import SITE_COLUMNS

EARTH_DIAMETER_KM = 12742.0  # fixed value


def enrich(
    readings: DataFrame, sites: DataFrame, site: str = "location_id", ts: str = "timestamp",
    how: str = "inner",
) -> DataFrame:
    """Attach the site attributes and derive band, date, year and local season."""
    attributes = sites.select(*SITE_COLUMNS)
    return readings.join(attributes, site, how).withColumns(
        {
            "elevation_band": elevation_band("elevation_m"),
            "date": F.to_date(ts),
            "year": F.year(ts),
            "season": local_season(F.month(ts), "latitude"),
        }
    )


def enrich_left(readings: DataFrame, sites: DataFrame, site: str = "location_id",
                ts: str = "timestamp") -> DataFrame:
    """:func:`enrich` that keeps readings of unknown sites (their attributes are NULL)."""
    return enrich(readings, sites, site, ts, how="left")


def join_many_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that fails when a right key repeats or a left row finds no partner.

    The guard is part of the plan: no extra pass, and no row can slip through.
    """
    keys = list(keys)
    rest = [c for c in right.columns if c not in keys]
    unique = right.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_partners"), *[F.first(c).alias(c) for c in rest]
    )
    fail = lambda text: F.raise_error(F.lit(text)).cast("boolean")
    return (
        left.join(unique, keys, "left")
        .filter(
            F.when(F.col("_partners").isNull(), fail("many-to-one join: unmatched row"))
            .when(F.col("_partners") > 1, fail("many-to-one join: right key repeats"))
            .otherwise(F.lit(True))
        )
        .drop("_partners")
    )


def join_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: left rows, rows a join would give, unmatched rows, repeated right keys."""
    partners = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_partners"))
    per_key = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).join(
        partners, list(keys), "full_outer"
    )
    rows, mates = F.coalesce("_rows", F.lit(0)), F.coalesce("_partners", F.lit(0))
    return per_key.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum(rows * F.greatest(mates, F.lit(1))), F.lit(0)).alias("output_rows"),
        F.coalesce(F.sum(F.when(mates == 0, rows)), F.lit(0)).alias("unmatched_rows"),
        F.count_if(mates > 1).alias("repeated_keys"),
    )


def calendar(start: Column, end: Column) -> Column:
    """Array of every day in the closed range (at most 36,600)."""
    days = F.datediff(end, start) + 1
    return F.when(
        days.between(1, 36600), F.sequence(start, end, F.expr("interval 1 day"))
    ).otherwise(F.raise_error(F.lit("coverage must span 1 to 36600 days")).cast("array<date>"))


def densify(
    sites: DataFrame,
    start: Column,
    end: Column,
    catalogue: Sequence[tuple[str, str, str]],
    observed: DataFrame,
    site: str = "location_id",
    day: str = "date",
    metric: str = "metric",
) -> DataFrame:
    """Coverage grid: every site x day x metric, with what was observed.

    ``catalogue`` holds (metric, unit, daily_aggregation).  Days and metrics are
    generated on each site row, so the grid needs no cross join and spreads over the
    cluster with the sites; the one shuffle is the left join on the grid key.
    """
    entries = F.array(
        *[
            F.struct(F.lit(m).alias(metric), F.lit(u).alias("unit"), F.lit(a).alias("daily_aggregation"))
            for m, u, a in catalogue
        ]
    )
    grid = (
        sites.withColumn(day, F.explode(calendar(start, end)))
        .withColumn("_entry", F.explode(entries))
        .select(*[F.col(c) for c in sites.columns], day, "_entry.*")
    )
    fact = grid.join(observed, [site, day, metric], "left")
    return fact.withColumns(
        {
            "observed_hours": F.coalesce("observed_hours", F.lit(0).cast("bigint")),
            "valid_hours": F.coalesce("valid_hours", F.lit(0).cast("bigint")),
            "is_complete": F.coalesce("is_complete", F.lit(False)),
            "calendar_year": F.year(day),
            "season": met_season(day),
            "season_year": season_year(day),
        }
    )


def change_vs_previous(
    df: DataFrame, value: str, keys: Sequence[str], year: str = "calendar_year",
    complete: str = "is_complete_year", output: str = "year_over_year_change",
) -> DataFrame:
    """Change against the year before, only where both years are complete.

    The year-minus-one self join as one window: a key has one row per year.
    """
    years = Window.partitionBy(*keys).orderBy(year)
    consecutive = F.lag(year).over(years) == F.col(year) - 1
    both = F.col(complete) & F.lag(complete).over(years)
    return df.withColumn(
        output, F.when(consecutive & both, F.col(value) - F.lag(value).over(years))
    )


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows without a parent."""
    return child.join(parent.select(*keys).distinct(), list(keys), "left_anti")


def reconcile(
    a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float
) -> DataFrame:
    """One row per column: largest absolute difference, rows on one side only, verdict."""
    keys = list(keys)
    left = a.select(*keys, F.lit(True).alias("_a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    right = b.select(*keys, F.lit(True).alias("_b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    joined = left.join(right, keys, "full_outer")
    # a value missing on one side only counts as an infinite difference
    gap = {
        c: F.when(F.col(f"{c}_a").isNull() & F.col(f"{c}_b").isNull(), 0.0)
        .when(F.col(f"{c}_a").isNull() | F.col(f"{c}_b").isNull(), float("inf"))
        .otherwise(F.abs(F.col(f"{c}_a") - F.col(f"{c}_b")))
        for c in columns
    }
    both = F.col("_a") & F.col("_b")
    measured = joined.agg(
        F.count_if(both).alias("matched"),
        F.count_if(F.col("_b").isNull()).alias("only_left"),
        F.count_if(F.col("_a").isNull()).alias("only_right"),
        *[F.max(F.when(both, g)).alias(c) for c, g in gap.items()],
    )
    return measured.unpivot(
        ["matched", "only_left", "only_right"], list(columns), "metric", "max_abs_difference"
    ).withColumn(
        "agrees",
        (F.col("only_left") == 0) & (F.col("only_right") == 0)
        & (F.coalesce("max_abs_difference", F.lit(0.0)) <= tolerance),
    )


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return EARTH_DIAMETER_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def neighbours(sites: DataFrame, km: float = 250.0, site: str = "location_id") -> DataFrame:
    """Pairs of sites at most ``km`` apart (``site_a`` < ``site_b``), with the distance.

    An equi-join on grid cells: latitude bands of ``km`` height, and within a band
    longitude cells at least ``km`` wide.  One side is copied to the cells around it,
    so only nearby sites ever meet; coordinates are unique per site by contract.
    """
    degree = EARTH_DIAMETER_KM * 3.141592653589793 / 360.0
    height = km / degree
    lat, lon = F.col("latitude"), F.col("longitude")
    band = lambda y: F.floor((y + 90) / height)
    # Cells of a band must be wide enough at the edge of the band farthest from the
    # equator.  Near the poles every longitude falls into one cell.
    far = F.least(
        F.lit(90.0),
        F.greatest(
            F.abs(F.col("_band") * height - 90), F.abs((F.col("_band") + 1) * height - 90)
        ) + height,
    )
    # chord bound: two points km apart span at most this many degrees of longitude
    ratio = F.sin(F.lit(height / 2) * F.pi() / 180) / F.greatest(F.cos(F.radians(far)), F.lit(1e-12))
    width = F.when(ratio >= 1, 360.0).otherwise(
        F.greatest(2 * F.degrees(F.asin(F.least(F.lit(1.0), ratio))), F.lit(height))
    )
    cells = F.greatest(F.lit(1), F.floor(360.0 / F.col("_width")).cast("int"))
    cell_of = F.least(
        F.floor((F.col("_lon") + 180) / 360.0 * F.col("_cells")).cast("int"), F.col("_cells") - 1
    )
    point = sites.select(F.col(site).alias("_id"), lat.alias("_lat"), lon.alias("_lon"))

    def placed(rows: DataFrame) -> DataFrame:
        return (
            rows.withColumn("_width", width).withColumn("_cells", cells)
            .withColumn("_cell", cell_of)
        )

    own = placed(point.withColumn("_band", band(F.col("_lat")))).select(
        F.col("_id").alias("site_a"), F.col("_lat").alias("lat_a"), F.col("_lon").alias("lon_a"),
        "_band", "_cell",
    )
    around = placed(
        point.withColumn(
            "_band", F.explode(F.transform(F.array(*[F.lit(k) for k in (-1, 0, 1)]),
                                           lambda k: band(F.col("_lat")) + k))
        )
    )
    reach = F.array_distinct(
        F.transform(
            F.array(*[F.lit(k) for k in (-1, 0, 1)]),
            lambda k: F.pmod(F.col("_cell") + k, F.col("_cells")),
        )
    )
    around = around.select(
        F.col("_id").alias("site_b"), F.col("_lat").alias("lat_b"), F.col("_lon").alias("lon_b"),
        "_band", F.explode(reach).alias("_cell"),
    )
    distance = great_circle_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    return (
        own.join(around, ["_band", "_cell"])
        .filter(F.col("site_a") < F.col("site_b"))
        .select("site_a", "site_b", distance.alias("distance_km"))
        .filter(F.col("distance_km") <= km)
    )


def change_from_base(
    df: DataFrame, value: str, base: int, site: str = "location_id", month: str = "month",
    output: str = "change", by: Sequence[str] = (),
) -> DataFrame:
    """Each other month minus the site's value in the base month (base rows drop out).

    ``by`` names further columns that a base belongs to, such as the year.
    """
    sites = Window.partitionBy(site, *by)
    start = F.max(F.when(F.col(month) == base, F.col(value))).over(sites)
    return df.withColumn(output, F.col(value) - start).filter(F.col(month) != base)
