"""Sinks and the versioned release store.

A release is a directory of Parquet tables with a manifest; a one-row pointer table,
appended last, names the active version.  Nothing published is ever replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from fieldgauge.operators.coverage import coverage_vs_window
from fieldgauge.operators.filters import require_columns
from fieldgauge.schemas import PUBLISHED_TABLES, VERSION_PATTERN
from fieldgauge.session import path_exists


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table, optionally by low-cardinality directories.

    Each task writes the directories its rows fall into, so a directory that holds a
    third of the rows is still written by all tasks.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether a finished Parquet write lies there (its success marker is written last)."""
    return path_exists(spark, f"{path}/_SUCCESS")


def finished_attempt(spark: SparkSession, path: str) -> str | None:
    """The finished write below ``path``, where every attempt has a directory of its own."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return None
    below = sorted(f"{path}/{s.getPath().getName()}" for s in files.listStatus(target) if s.isDirectory())
    return next((p for p in below if is_table(spark, p)), None)


def fresh_attempt(path: str) -> str:
    return f"{path}/attempt-{uuid.uuid4().hex}"


def write_once(df: DataFrame, path: str) -> int:
    """Write a result that must not exist yet; the row count comes from the same pass."""
    if path_exists(df.sparkSession, path):
        raise FileExistsError(path)
    seen = Observation("written")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    return seen.get["rows"]


def export(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if fmt == "parquet":
        df.write.parquet(path)
    elif fmt == "csv":
        df.write.option("header", True).csv(path)
    else:
        raise ValueError("export as parquet or csv")


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Order-insensitive content digest: row count, xor and exact sum of row hashes.

    Column names are part of the hash; partitioning and row order are not.
    """
    fields = [F.concat_ws("\x1f", F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("\x00")))
              for c in sorted(df.columns)]
    row = F.xxhash64(*fields)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.bit_xor(row), F.lit(0).cast("bigint")).alias("hash_xor"),
        F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("hash_sum"),
    )


def fingerprint_text(df: DataFrame) -> str:
    row = fingerprint(df).first()
    return f"{row.n_rows}-{row.hash_xor & (2**64 - 1):016x}-{row.hash_sum}"


def release_problems(tables: Mapping[str, DataFrame], plan: DataFrame | None = None) -> DataFrame:
    """Gates of a release as rows (gate, violations); all zero = may be published.

    Every key of the three keyed tables becomes one marked row; the rows are counted by key,
    the keys by site, and the sites once more, so each table is read once for all gates.  A
    study ``plan`` (``location_id`` and ``hours`` per chunk) adds its own: the release must hold
    the planned sites, no others, and as many readings as planned.
    """
    sites, readings, daily = (tables[n] for n in ("locations", "enriched_weather", "daily_metrics"))

    def marked(df: DataFrame, kind: str, at: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col("location_id").cast("string").alias("site"),
                         at.cast("string").alias("at"), F.lit(1).cast("bigint").alias("n"))

    rows = [marked(sites, "site", F.lit("")), marked(readings, "hour", F.col("timestamp")), marked(daily, "day", F.col("date"))]
    if plan is not None:
        rows.append(plan.select(F.lit("plan"), F.col("location_id").cast("string"), F.lit(""), F.col("hours").cast("bigint")))
    keys = reduce(DataFrame.unionAll, rows).groupBy("kind", "site", "at").agg(F.sum("n").alias("n"))
    without_key = F.col("site").isNull() | F.col("at").isNull()
    of = lambda kind, c=None: (F.col("kind") == kind) & c if c is not None else F.col("kind") == kind
    names = {"site": "site", "hour": "hour", "day": "day"}
    by_site = keys.groupBy("site").agg(
        *[F.count_if(of(k, F.col("n") > 1)).alias(f"repeated_{k}") for k in names],
        *[F.coalesce(F.sum(F.when(of(k, without_key), F.col("n"))), F.lit(0)).alias(f"without_key_{k}") for k in names],
        *[F.coalesce(F.sum(F.when(of(k), F.col("n"))), F.lit(0)).alias(f"n_{k}") for k in [*names, "plan"]],
        *[F.bool_or(of(k)).alias(f"has_{k}") for k in ("site", "hour", "plan")],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    named = F.col("site").isNotNull()
    gates = {
        "repeated_site": total("repeated_site"), "repeated_hour": total("repeated_hour"), "repeated_day": total("repeated_day"),
        "site_without_id": total("without_key_site"), "hour_without_key": total("without_key_hour"),
        "day_without_key": total("without_key_day"),
        "unknown_site": F.count_if(named & F.col("has_hour") & ~F.col("has_site")),
        "empty_locations": (total("n_site") == 0).cast("bigint"),
        "empty_enriched_weather": (total("n_hour") == 0).cast("bigint"),
        "empty_daily_metrics": (total("n_day") == 0).cast("bigint"),
    }
    if plan is not None:
        gates |= {
            "planned_site_missing": F.count_if(F.col("has_plan") & ~F.col("has_site")),
            "site_not_planned": F.count_if(named & F.col("has_site") & ~F.col("has_plan")),
            "readings_against_plan": F.abs(total("n_hour") - total("n_plan")),
        }
    counted = by_site.agg(*[c.alias(g) for g, c in gates.items()])
    return counted.unpivot([], list(gates), "gate", "violations")


def check_version(version: str) -> str:
    if not isinstance(version, str) or not re.fullmatch(VERSION_PATTERN.strip("^$"), version):
        raise ValueError("a version has 1 to 80 letters, digits, underscores or hyphens")
    return version


def publish(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, version: str,
    require_full_coverage: bool = False, plan: DataFrame | None = None,
) -> DataFrame:
    """Publish the six tables as an immutable version and make it active.

    With a study ``plan`` (chunks as :func:`planning.expected_chunks` makes them) the release
    must be the whole study: its sites, its number of readings, and no missing hour.

    Order: required columns, then the tables, gates on what was written, the manifest,
    and the pointer last.  A failure before that leaves the old version active.  Every
    attempt writes below a directory of its own, which the manifest names: files of a failed
    attempt are never read, and the version can be published again with mended tables.
    """
    check_version(version)
    release = f"{root}/releases/{version}"
    if is_table(spark, f"{release}/manifest"):
        raise FileExistsError(f"version {version} is published already")
    for name, required in PUBLISHED_TABLES.items():
        if name not in tables:
            raise ValueError(f"table {name} is missing")
        require_columns(tables[name], required, name)
    attempt = fresh_attempt(release)
    rows: dict[str, int] = {}
    written: dict[str, DataFrame] = {}
    for name in PUBLISHED_TABLES:
        rows[name] = write_once(tables[name], f"{attempt}/{name}")
        written[name] = spark.read.schema(tables[name].schema).parquet(f"{attempt}/{name}")
    failed = [r.gate for r in release_problems(written, plan).filter("violations > 0").collect()]
    if failed:
        raise ValueError(f"release {version} fails {sorted(failed)}")
    cover = coverage_vs_window(written["enriched_weather"], written["locations"])
    if (require_full_coverage or plan is not None) and not cover.filter("missing_hours > 0").isEmpty():
        raise ValueError("the study has missing hours")
    cover.write.parquet(f"{attempt}/coverage")
    span = written["enriched_weather"].agg(
        F.min("timestamp").alias("coverage_start"), F.max("timestamp").alias("coverage_end")
    )
    described = reduce(
        DataFrame.unionByName,
        [
            fingerprint(df).select(
                F.lit(name).alias("table_name"),
                F.lit(rows[name]).cast("bigint").alias("written_rows"),
                "n_rows", "hash_xor", "hash_sum",
                F.lit(df.schema.simpleString()).alias("schema"),
            )
            for name, df in written.items()
        ],
    )
    ends = span.agg(F.struct(F.first("coverage_start").alias("a"), F.first("coverage_end").alias("b"))).scalar()
    described.select(
        F.lit(version).alias("version"), "*",
        ends["a"].alias("coverage_start"), ends["b"].alias("coverage_end"),
        F.current_timestamp().alias("created_at"),
        F.lit(attempt.rpartition("/")[2]).alias("attempt"),
    ).write.mode("overwrite").parquet(f"{release}/manifest")  # it was seen unfinished above
    activate(spark, root, version)
    return spark.read.parquet(f"{release}/manifest")


def activate(spark: SparkSession, root: str, version: str) -> None:
    """Append the pointer row; the newest row counts, so the flip is one small commit."""
    spark.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().alias("activated_at")
    ).write.mode("append").parquet(f"{root}/active")


def active_version(spark: SparkSession, root: str) -> str:
    if not is_table(spark, f"{root}/active"):
        raise FileNotFoundError("nothing has been published")
    newest = spark.read.parquet(f"{root}/active").agg(F.max_by("version", "activated_at").alias("v"))
    return newest.first().v


class ReleaseStore:
    """Reads of one resolved version: all tables a caller sees belong together."""

    def __init__(self, spark: SparkSession, root: str, version: str | None = None):
        self.spark, self.root = spark, root
        self.version = check_version(version or active_version(spark, root))
        self.path = f"{root}/releases/{self.version}"
        if not is_table(spark, f"{self.path}/manifest"):
            raise FileNotFoundError(f"version {self.version} is not published")
        self.attempt = self.manifest().first().attempt

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/manifest")

    def read(
        self, name: str, columns: Sequence[str] | None = None, where: Column | None = None
    ) -> DataFrame:
        """Projection and filter are part of the plan, so both reach the Parquet reader."""
        if name not in PUBLISHED_TABLES:
            raise ValueError(f"unknown table {name!r}")
        df = self.spark.read.parquet(f"{self.path}/{self.attempt}/{name}")
        if where is not None:
            df = df.filter(where)
        return df.select(*columns) if columns else df

    def fingerprint(self) -> str:
        """One text for the whole release, from the manifest."""
        parts = self.manifest().orderBy("table_name").select(
            F.concat_ws(":", "table_name", "n_rows", "hash_xor", "hash_sum").alias("p")
        )
        return "|".join(r.p for r in parts.collect())  # six rows

    def verify(self) -> DataFrame:
        """Tables whose content no longer matches the manifest."""
        now = reduce(
            DataFrame.unionByName,
            [
                fingerprint(self.read(n)).select(F.lit(n).alias("table_name"), "n_rows", "hash_xor", "hash_sum")
                for n in PUBLISHED_TABLES
            ],
        )
        return now.exceptAll(self.manifest().select(*now.columns))
