"""Readers for the hourly lake, committed files, JSON payloads and site catalogues."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fieldgauge.operators.filters import require_columns
from fieldgauge.functions.scalars import valid_site_id
from fieldgauge.schemas import (
    CATALOGUE_SCHEMA, HOURLY_VARIABLES, METRIC_CATALOGUE, SITE_CSV_SCHEMA,
)
from fieldgauge.session import path_exists


def read_lake(spark: SparkSession, root: str, files: Sequence[str] | None = None) -> DataFrame:
    """Hive-partitioned hourly Parquet (``location_id=<id>/year=<yyyy>/...``).

    With a file list the base path still supplies the partition columns.
    """
    reader = spark.read.option("basePath", root)
    return reader.parquet(*files) if files else reader.parquet(root)


RECORD_SCHEMA = T.StructType(
    [
        T.StructField("sha256", T.StringType()),
        T.StructField(
            "request",
            T.StructType(
                [
                    T.StructField("location_id", T.StringType()),
                    T.StructField("start", T.DateType()),
                    T.StructField("end", T.DateType()),
                ]
            ),
        ),
    ]
)


def sidecars(spark: SparkSession, root: str) -> DataFrame:
    """Commit records: for each data file ``weather<x>.parquet`` with a ``_source<x>.json``
    beside it, the request, the recorded digest and the data file.

    Spark's listing hides names that start with an underscore.  The records are small and
    sit beside their data files, so the tasks that hold the file names open them, through a
    library that knows local, HDFS, S3, GCS and Azure paths.  Lakes in other stores keep their
    records in a journal (:func:`commit_chunks`), which Spark itself reads.
    """

    def read(batches):
        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch["path"]:
                folder, name = path.rsplit("/", 1)
                record = name.replace("weather", "_source", 1).replace(".parquet", ".json")
                # the same store under the names that Hadoop gives its connectors
                uri = re.sub("^s3[an]:", "s3:", f"{folder}/{record}")
                system, target = fs.FileSystem.from_uri(uri)
                if system.get_file_info(target).type == fs.FileType.File:
                    with system.open_input_stream(target) as stream:
                        found.append((path, stream.read().decode()))
            yield pd.DataFrame(found, columns=["path", "text"])

    texts = data_files(spark, root).mapInPandas(read, "path string, text string")
    record = F.from_json("text", RECORD_SCHEMA).alias("r")
    return texts.select("path", record).select(
        F.col("r.request.location_id").alias("location_id"),
        F.col("r.request.start").alias("start"),
        F.col("r.request.end").alias("end"),
        F.col("r.sha256").alias("recorded_sha256"),
        "path",
    )


DATA_PATTERN = "location_id=*/year=*/weather*.parquet"


def local_path(path: Column | str) -> Column:
    """File names as both readers and records write them: local ones without a scheme."""
    return F.regexp_replace(path, "^file:/+", "/")


def data_files(spark: SparkSession, root: str, digest: bool = False, pattern: str = DATA_PATTERN) -> DataFrame:
    """Paths of the data files (and their SHA-256 when asked; otherwise no content is read).

    A digest is made by the task that reads the file; a file above 2 GB is refused by the source.
    """
    files = spark.read.format("binaryFile").load(f"{root}/{pattern}")
    name = local_path("path")
    out = [name.alias("path")]
    if digest:
        out.append(F.sha2("content", 256).alias("sha256"))
    return files.select(*out)


#: a record of a published file: what it holds, its digest and where it lies
COMMIT_SCHEMA = T.StructType([T.StructField("path", T.StringType()), *RECORD_SCHEMA.fields])


def write_chunks(df: DataFrame, root: str, site: str = "location_id", ts: str = "timestamp") -> None:
    """Readings as one data file per site and year, below directories of those names.

    A file is visible by its name only when it is whole, but counts only with its record.
    """
    chunks = df.withColumn("year", F.year(ts)).repartition(site, "year")
    chunks.write.mode("append").partitionBy(site, "year").parquet(root)


def commit_chunks(
    spark: SparkSession, root: str, journal: str, pattern: str = DATA_PATTERN, where: Column | None = None,
    site: str = "location_id", ts: str = "timestamp",
) -> None:
    """Append a record for each data file below ``root`` that has none yet and fulfils ``where``.

    Records are JSON lines in the folder ``journal``, written after the data.  Their names are
    not hidden, so Spark's file sources, batch or streaming, read them from any file system, and
    the digests are made where the files are read; nothing of a file passes through the driver.
    """
    held = commit_records(spark, journal)
    open_files = data_files(spark, root, digest=True, pattern=pattern).join(held.select("path"), "path", "left_anti")
    rows = spark.read.option("basePath", root).parquet(f"{root}/{pattern}")
    if where is not None:
        rows = rows.filter(where)
    asked = rows.withColumn("path", local_path(F.col("_metadata.file_path"))).groupBy("path").agg(
        F.struct(F.first(F.col(site).cast("string")).alias("location_id"), F.to_date(F.min(ts)).alias("start"),
                 F.to_date(F.max(ts)).alias("end")).alias("request")
    )
    open_files.join(asked, "path").select("path", "sha256", "request").write.mode("append").json(journal)


def commit_records(spark: SparkSession, journal: str) -> DataFrame:
    """path, location_id, start, end, recorded_sha256 of each record; none before the first commit."""
    found = (
        spark.read.schema(COMMIT_SCHEMA).json(journal) if path_exists(spark, journal)
        else spark.createDataFrame([], COMMIT_SCHEMA)
    )
    return found.select(
        "path", "request.location_id", "request.start", "request.end", F.col("sha256").alias("recorded_sha256")
    )


def committed_scan(
    spark: SparkSession, root: str, commits: DataFrame | None = None, pattern: str = DATA_PATTERN,
) -> DataFrame:
    """Readings of committed files only: a data file without its record is ignored.

    ``commits`` has a ``path`` column and defaults to the sidecar records.  Each row knows
    its file, so a semi join keeps the committed ones and no list of paths passes through
    the driver; partition columns and column pruning still apply.
    """
    records = sidecars(spark, root) if commits is None else commits
    done = records.select(local_path("path").alias("_file")).distinct()
    rows = spark.read.option("basePath", root).parquet(f"{root}/{pattern}")
    return (
        rows.withColumn("_file", local_path(F.col("_metadata.file_path")))
        .join(done, "_file", "left_semi")
        .drop("_file")
    )


def payload_schema(variables: Sequence[str]) -> T.StructType:
    series = T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    )
    return T.StructType(
        [T.StructField("location_id", T.StringType()), T.StructField("hourly", series)]
    )


def explode_hourly(
    payloads: DataFrame, variables: Sequence[str] = HOURLY_VARIABLES, ids: Sequence[str] = ("location_id",)
) -> DataFrame:
    """Columnar payloads (``hourly.time[]``, ``hourly.<variable>[]``) to hourly rows.

    Every variable becomes a double, also one that is all NULL; a payload without a
    required field fails, and so does one whose arrays differ in length.
    """
    fields = {f.name for f in payloads.schema["hourly"].dataType.fields}
    require_columns(payloads, [*ids, "hourly"], "payload")
    absent = sorted({"time", *variables} - fields)
    if absent:
        raise ValueError(f"payload lacks hourly fields {absent}")
    n = F.size("hourly.time")
    whole = F.lit(True)
    for v in variables:
        whole = whole & F.coalesce(F.size(f"hourly.{v}") == n, F.lit(False))
    checked = payloads.filter(
        F.when(whole, F.lit(True)).otherwise(
            F.raise_error(F.lit("payload arrays must be present and of equal length")).cast("boolean")
        )
    )
    zipped = F.arrays_zip(
        F.col("hourly.time").alias("time"), *[F.col(f"hourly.{v}").alias(v) for v in variables]
    )
    rows = checked.select(*ids, F.inline(zipped))
    stamp = F.col("time").cast("timestamp")
    return rows.select(
        *ids,
        stamp.alias("timestamp"),
        *[F.col(v).cast("double").alias(v) for v in variables],
        F.year(stamp).alias("source_year"),
        F.current_timestamp().alias("ingested_at"),
    )


def site_problems(sites: DataFrame, required: Sequence[str] = SITE_CSV_SCHEMA.names) -> DataFrame:
    """One row of defect counts of a site catalogue (all zero = usable)."""
    require_columns(sites, required, "site")
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    n = F.count(F.lit(1))
    return sites.agg(
        n.alias("sites"),
        F.count_if(missing).alias("incomplete"),
        (F.count("location_id") - F.count_distinct("location_id")).alias("repeated_ids"),
        (n - F.count_distinct(F.struct("latitude", "longitude"))).alias("repeated_coordinates"),
        F.count_if(~valid_site_id("location_id")).alias("bad_ids"),
        F.count_if(
            ~F.col("latitude").between(-90, 90) | ~F.col("longitude").between(-180, 180)
        ).alias("bad_coordinates"),
    )


def load_sites(spark: SparkSession, path: str) -> DataFrame:
    """Site catalogue from CSV; fails on the first kind of defect found.

    The checks are one aggregation; only its single row reaches the driver.
    """
    header = spark.read.option("header", True).csv(path).columns
    absent = sorted(set(SITE_CSV_SCHEMA.names) - set(header))
    if absent:
        raise ValueError(f"site catalogue lacks columns {absent}")
    raw = spark.read.option("header", True).csv(path)
    sites = raw.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in SITE_CSV_SCHEMA.fields],
        *[c for c in header if c not in SITE_CSV_SCHEMA.names],
    )
    report = site_problems(sites).first().asDict()
    if report.pop("sites") == 0:
        raise ValueError("site catalogue is empty")
    found = {k: v for k, v in report.items() if v}
    if found:
        raise ValueError(f"site catalogue defects: {found}")
    return sites


def metric_catalogue(spark: SparkSession, rows=METRIC_CATALOGUE) -> DataFrame:
    """The metric dimension: identifier, label, unit and the value of a day (mean or sum)."""
    return spark.createDataFrame(list(rows), CATALOGUE_SCHEMA)


def register(spark: SparkSession, **tables: DataFrame) -> None:
    """Make tables visible to :func:`run_sql` under their keyword names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, **args) -> DataFrame:
    """Read-only SQL over registered tables; values go in as parameters, not as text."""
    if not sql.lstrip().lower().startswith(("select", "with")):
        raise ValueError("only SELECT statements are run")
    return spark.sql(sql, args=args or None)
