"""The four bindings of the operators to the test tables, on Spark and as SQL views.

S  sensor hours   ``events`` by event type: hourly mean ``reading`` and total ``volume``
U  user readings  ``events`` by user, with ``customer`` as the site table
W  wide metrics   ``lineitem`` by supplier and ship date, with ``supplier`` as site table
Y  years          ``orders`` by customer region and order date

A value under the detection limit counts as missing: the tables hold no NULL of their own.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fieldgauge.session import configure

DETECTION_LIMIT = 5.0
S_CATALOGUE = (("reading", "units", "mean"), ("volume", "units/day", "sum"))
W_METRICS = ("quantity", "price", "discount", "tax")


class Tables:
    """Readers of one scale-factor folder; nothing is read until a query runs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def places(self) -> DataFrame:
        nation, region = self("nation"), self("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region")
        )

    def _sites(self, table: str, key: str, name: str, nation: str, height: str) -> DataFrame:
        df = self(table)
        return df.join(self.places, df[nation] == F.col("n_nationkey")).select(
            F.col(key).alias("location_id"),
            F.col(name).alias("name"),
            "country",
            "region",
            (F.col(nation) - 12).cast("double").alias("latitude"),
            (F.col(key) % 360 - 180).cast("double").alias("longitude"),
            F.col(height).alias("elevation_m"),
        )

    # -- S ------------------------------------------------------------------------
    @cached_property
    def s_raw(self) -> DataFrame:
        value = F.when(F.col("value") >= DETECTION_LIMIT, F.col("value"))
        return self("events").select(
            F.col("event_type").alias("location_id"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            value.alias("value"),
            "event_id",
        )

    @cached_property
    def s(self) -> DataFrame:
        return self.s_raw.groupBy(
            "location_id", F.date_trunc("hour", "timestamp").alias("timestamp")
        ).agg(F.avg("value").alias("reading"), F.sum("value").alias("volume"))

    @cached_property
    def s_sites(self) -> DataFrame:
        return self.s_raw.select("location_id").distinct()

    # -- U ------------------------------------------------------------------------
    @cached_property
    def u(self) -> DataFrame:
        v = F.col("value")
        stamp = F.col("ts").cast("timestamp")
        return self("events").select(
            "event_id",
            F.col("user_id").alias("location_id"),
            stamp.alias("timestamp"),
            F.date_trunc("hour", stamp).alias("hour"),
            (v - 20).alias("temperature_2m"),
            F.when(v >= DETECTION_LIMIT, v).alias("precipitation"),
            (v / 10).alias("wind_speed_10m"),
            (v / 2).alias("relative_humidity_2m"),
            F.year(stamp).alias("source_year"),
            stamp.alias("ingested_at"),
            "event_type",
        )

    @cached_property
    def u_sites(self) -> DataFrame:
        return self._sites("customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")

    # -- W ------------------------------------------------------------------------
    @cached_property
    def w(self) -> DataFrame:
        q = F.col("l_quantity")
        return self("lineitem").select(
            F.col("l_suppkey").alias("location_id"),
            F.col("l_shipdate").cast("timestamp").alias("timestamp"),
            F.when(q >= DETECTION_LIMIT, q).alias("quantity"),
            (F.col("l_extendedprice") / 1000).alias("price"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
        )

    @cached_property
    def w_sites(self) -> DataFrame:
        return self._sites("supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")

    @cached_property
    def w_daily(self) -> DataFrame:
        return self.w.groupBy("location_id", F.to_date("timestamp").alias("date")).agg(
            F.avg("quantity").alias("quantity"), F.sum("price").alias("price"),
            F.avg("discount").alias("discount"), F.avg("tax").alias("tax"),
            F.count(F.lit(1)).alias("observed"),
        )

    @cached_property
    def w_at_sites(self) -> DataFrame:
        return self.w.join(self.w_sites, "location_id")

    @cached_property
    def w_daily_at_sites(self) -> DataFrame:
        return self.w_daily.join(self.w_sites, "location_id")

    # -- Y ------------------------------------------------------------------------
    @cached_property
    def y(self) -> DataFrame:
        orders, customer = self("orders"), self("customer")
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(self.places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("region").alias("location_id"), "country",
                F.col("o_orderdate").cast("timestamp").alias("timestamp"),
                F.to_date("o_orderdate").alias("date"),
                (F.col("o_totalprice") / 1000).alias("value"),
            )
        )

    @cached_property
    def y_daily(self) -> DataFrame:
        return self.y.groupBy("location_id", "date").agg(
            F.avg("value").alias("value"), F.count(F.lit(1)).alias("observed")
        )

    @cached_property
    def y_global(self) -> DataFrame:
        """Daily values over all orders as one site (the only one with complete years)."""
        return self("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
            F.avg(F.col("o_totalprice") / 1000).alias("value"), F.count(F.lit(1)).alias("observed")
        ).select(F.lit("all").alias("location_id"), "date", "value", "observed")


SQL_VIEWS = f"""
WITH places AS (
  SELECT n_nationkey, n_name AS country, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
), s_raw AS (
  SELECT event_type AS location_id, ts AS timestamp,
         CASE WHEN value >= {DETECTION_LIMIT} THEN value END AS value, event_id
  FROM events
), s AS (
  SELECT location_id, date_trunc('hour', timestamp) AS timestamp,
         avg(value) AS reading, sum(value) AS volume
  FROM s_raw GROUP BY 1, 2
), s_sites AS (SELECT DISTINCT location_id FROM s_raw
), u AS (
  SELECT event_id, user_id AS location_id, ts AS timestamp, date_trunc('hour', ts) AS hour,
         value - 20 AS temperature_2m,
         CASE WHEN value >= {DETECTION_LIMIT} THEN value END AS precipitation,
         value / 10 AS wind_speed_10m, value / 2 AS relative_humidity_2m,
         year(ts) AS source_year, ts AS ingested_at, event_type
  FROM events
), u_sites AS (
  SELECT c_custkey AS location_id, c_name AS name, country, region,
         CAST(c_nationkey - 12 AS DOUBLE) AS latitude,
         CAST(c_custkey % 360 - 180 AS DOUBLE) AS longitude, c_acctbal AS elevation_m
  FROM customer JOIN places ON c_nationkey = n_nationkey
), w AS (
  SELECT l_suppkey AS location_id, l_shipdate AS timestamp,
         CASE WHEN l_quantity >= {DETECTION_LIMIT} THEN l_quantity END AS quantity,
         l_extendedprice / 1000 AS price, l_discount AS discount, l_tax AS tax,
         l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line
  FROM lineitem
), w_sites AS (
  SELECT s_suppkey AS location_id, s_name AS name, country, region,
         CAST(s_nationkey - 12 AS DOUBLE) AS latitude,
         CAST(s_suppkey % 360 - 180 AS DOUBLE) AS longitude, s_acctbal AS elevation_m
  FROM supplier JOIN places ON s_nationkey = n_nationkey
), w_daily AS (
  SELECT location_id, CAST(timestamp AS DATE) AS date, avg(quantity) AS quantity,
         sum(price) AS price, avg(discount) AS discount, avg(tax) AS tax, count(*) AS observed
  FROM w GROUP BY 1, 2
), w_at_sites AS (SELECT * FROM w JOIN w_sites USING (location_id)
), w_daily_at_sites AS (SELECT * FROM w_daily JOIN w_sites USING (location_id)
), y AS (
  SELECT region AS location_id, country, o_orderdate AS timestamp,
         CAST(o_orderdate AS DATE) AS date, o_totalprice / 1000 AS value
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN places ON c_nationkey = n_nationkey
), y_daily AS (
  SELECT location_id, date, avg(value) AS value, count(*) AS observed FROM y GROUP BY 1, 2
), y_global AS (
  SELECT 'all' AS location_id, CAST(o_orderdate AS DATE) AS date,
         avg(o_totalprice / 1000) AS value, count(*) AS observed
  FROM orders GROUP BY 2
)"""

BAND_SQL = (
    "CASE WHEN elevation_m < 200 THEN 'lowland' WHEN elevation_m < 1000 THEN 'midland' "
    "WHEN elevation_m < 3000 THEN 'highland' ELSE 'alpine' END"
)


def season_sql(month: str = "month(timestamp)", latitude: str = "latitude") -> str:
    return (
        f"CASE WHEN {latitude} >= 0 THEN CASE WHEN {month} IN (12,1,2) THEN 'winter' "
        f"WHEN {month} IN (3,4,5) THEN 'spring' WHEN {month} IN (6,7,8) THEN 'summer' "
        f"ELSE 'autumn' END ELSE CASE WHEN {month} IN (12,1,2) THEN 'summer' "
        f"WHEN {month} IN (3,4,5) THEN 'autumn' WHEN {month} IN (6,7,8) THEN 'winter' "
        "ELSE 'spring' END END"
    )


MET_SEASON_SQL = (
    "CASE WHEN month(date) IN (12,1,2) THEN 'DJF' WHEN month(date) IN (3,4,5) THEN 'MAM' "
    "WHEN month(date) IN (6,7,8) THEN 'JJA' ELSE 'SON' END"
)


def r(expression: str) -> str:
    """Six decimals.  The nudge moves exact half-way cases off the rounding edge, where the
    last bit of a sum would decide."""
    return f"round(({expression}) + 1e-9, 6)"


def finish(df: DataFrame) -> DataFrame:
    """Comparable output: rounded doubles as in :func:`r`, wide integers, naive timestamps."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c + 1e-9, 6)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(field.name))
    return df.select(*out)
