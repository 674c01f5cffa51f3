"""Whole jobs over tables: saved results, metadata, evidence, batch processing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from fieldgauge.operators.daily import daily_metrics, pooled_summary, yearly_metrics
from fieldgauge.operators.filters import dedupe_any, validate
from fieldgauge.operators.joins import enrich
from fieldgauge.operators.quality import observed_stages
from fieldgauge.operators.regression import lapse_rates
from fieldgauge.operators.selection import top_k
from fieldgauge.operators.summaries import location_means
from fieldgauge.operators.windows import anomaly, rolling_days, yoy_available
from fieldgauge.plans.spec import JOB_SOURCE, result_key, run_spec
from fieldgauge.schemas import METRIC_CATALOGUE
from fieldgauge.sources.store import ReleaseStore, finished_attempt, fresh_attempt, write_once, write_table


def result_for(store: ReleaseStore, spec: Mapping, results_root: str) -> tuple[DataFrame, bool]:
    """The saved result of a job if the same job ran on the same data, else a new one.

    Returns the result and whether it was reused.  Every attempt
    writes to a directory of its own; one left behind by a failed writer has no success marker,
    is not taken for a result and does not stop the next attempt.
    """
    spark = store.spark
    key = result_key(spec, store.version, store.fingerprint())
    if saved := finished_attempt(spark, f"{results_root}/{key}"):
        return spark.read.parquet(saved), True
    path = fresh_attempt(f"{results_root}/{key}")
    write_once(run_spec(store.read(JOB_SOURCE), spec), path)
    return spark.read.parquet(path), False


def feature_table(columns: Sequence[str], catalogue=METRIC_CATALOGUE) -> list[tuple]:
    """Catalogue entries whose metric is a column of the data."""
    return [entry for entry in catalogue if entry[0] in set(columns)]


def metadata(
    df: DataFrame, sites: DataFrame, catalogue=METRIC_CATALOGUE, site: str = "location_id",
    ts: str = "timestamp",
) -> DataFrame:
    """One row per available metric, with the covered days and the number of sites."""
    features = feature_table(df.columns, catalogue)
    entries = F.array(
        *[
            F.struct(*[F.lit(v).alias(n) for n, v in zip(("metric", "label", "unit", "aggregation"), f)])
            for f in features
        ]
    )
    n_sites = sites.agg(F.count_distinct(site)).scalar()
    span = df.agg(F.to_date(F.min(ts)).alias("start"), F.to_date(F.max(ts)).alias("end"))
    return span.select("start", "end", F.inline(entries)).withColumn("sites", n_sites)


def evidence(tables: Mapping[str, DataFrame], k: int = 20) -> dict[str, DataFrame]:
    """The five descriptive tables, from published daily, yearly and lapse tables."""
    daily, yearly = tables["daily_metrics"], tables["yearly_metrics"]
    places = location_means(daily)
    bands = places.groupBy("elevation_band").agg(
        F.avg("mean_daily_temperature_c").alias("mean_location_temperature_c"),
        F.avg("mean_daily_precipitation_mm").alias("mean_location_daily_precipitation_mm"),
        F.count("location_id").alias("locations"),
    )
    return {
        "location_comparison": places,
        "elevation_comparison": bands,
        "annual_anomalies": anomaly(
            yearly, "annual_avg_temperature_c", output="anomaly_vs_study_mean_c"
        ),
        "wettest_location_days": top_k(
            daily, "daily_precipitation_mm", k, ["location_id", "date"]
        ).select("location_id", "name", "date", "daily_precipitation_mm"),
        "seasonal_lapse_rates": tables["lapse_rates"],
    }


# how each evidence table is made, for a reader of the tables
EVIDENCE_METHODS = {
    "location_comparison": "mean over the days of a site; rain is the mean daily total",
    "elevation_comparison": "mean over sites of their means, so each site weighs the same",
    "annual_anomalies": "annual mean minus the site's mean over its own years",
    "wettest_location_days": "largest daily totals, ties by site and day",
    "seasonal_lapse_rates": "one pooled line of daily temperature on elevation per local season",
}


def write_evidence(tables: Mapping[str, DataFrame], output: str, version: str = "", k: int = 20) -> DataFrame:
    """Write the five tables and, last, the notes that say how each was made; returns the notes.

    The notes have one row per table: its name, method, rows and columns, and the version of the
    data.  Whoever finds notes finds all tables.
    """
    spark = tables["daily_metrics"].sparkSession
    made = evidence(tables, k)
    rows = {name: write_once(df, f"{output}/{name}") for name, df in made.items()}
    notes = [(version, name, EVIDENCE_METHODS[name], rows[name], df.columns) for name, df in made.items()]
    schema = "version string, table_name string, method string, n_rows bigint, columns array<string>"
    spark.createDataFrame(notes, schema).coalesce(1).write.json(f"{output}/notes")
    return spark.read.schema(schema).json(f"{output}/notes")


def derive(readings: DataFrame, sites: DataFrame) -> dict[str, DataFrame]:
    """All published tables from raw readings and sites, as one lazy graph."""
    kept = dedupe_any(validate(readings), ["location_id", "timestamp"])
    return derive_from(enrich(kept, sites), sites)


def derive_from(enriched: DataFrame, sites: DataFrame) -> dict[str, DataFrame]:
    daily = rolling_days(
        daily_metrics(enriched), "daily_avg_temperature_c", output="temperature_30d_rolling_avg_c"
    )
    return {
        "locations": sites,
        "enriched_weather": enriched,
        "daily_metrics": daily,
        "summaries": pooled_summary(enriched),
        "yearly_metrics": yoy_available(
            yearly_metrics(enriched), "annual_avg_temperature_c", output="temperature_yoy_change_c"
        ),
        "lapse_rates": lapse_rates(daily),
    }


def process(
    spark: SparkSession, readings: DataFrame, sites: DataFrame, output: str
) -> dict[str, int]:
    """Write the five derived tables and return the row count of every stage.

    The enriched table feeds all others.  It is written first, and the rest read the
    written table rather than a cache: the counters fire once, and a lost executor costs
    no recomputation of the join.
    """
    enriched, counters = observed_stages(readings, sites)
    write_table(enriched, f"{output}/enriched_weather", ["elevation_band"])
    stored = spark.read.parquet(f"{output}/enriched_weather")
    tables = derive_from(stored, sites)
    daily_rows = write_counted(tables["daily_metrics"], f"{output}/daily_metrics")
    stored_daily = spark.read.parquet(f"{output}/daily_metrics")
    for name, df in (
        ("summaries", tables["summaries"]),
        ("yearly_metrics", tables["yearly_metrics"]),
        ("lapse_rates", lapse_rates(stored_daily)),
    ):
        write_table(df, f"{output}/{name}")
    n = {stage: seen.get["rows"] for stage, seen in counters.items()}
    return {
        "input_rows": n["input"],
        "validated_rows": n["validated"],
        "rejected_or_duplicate_rows": n["input"] - n["validated"],
        "unmatched_site_rows": n["validated"] - n["output"],
        "output_rows": n["output"],
        "daily_rows": daily_rows,
    }


def write_counted(df: DataFrame, path: str) -> int:
    seen = Observation("written")
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]
