"""Table contracts.  The names and ranges below are fixed values of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

# -- fixed values: hourly reading contract --------------------------------------
READING_COLUMNS = (
    "location_id",
    "timestamp",
    "temperature_2m",
    "precipitation",
    "wind_speed_10m",
    "relative_humidity_2m",
    "source_year",
    "ingested_at",
)
MAX_DOUBLE = 1.7976931348623157e308
READING_BOUNDS = {
    "temperature_2m": (-100.0, 70.0),
    "precipitation": (0.0, MAX_DOUBLE),
    "wind_speed_10m": (0.0, MAX_DOUBLE),
    "relative_humidity_2m": (0.0, 100.0),
}

# -- fixed values: the 47 hourly variables ---------------------------------------
HOURLY_VARIABLES = tuple(
    """
    temperature_2m relative_humidity_2m dew_point_2m apparent_temperature
    precipitation rain snowfall snow_depth weather_code pressure_msl
    surface_pressure cloud_cover cloud_cover_low cloud_cover_mid cloud_cover_high
    et0_fao_evapotranspiration vapour_pressure_deficit wind_speed_10m
    wind_speed_100m wind_direction_10m wind_direction_100m wind_gusts_10m
    soil_temperature_0_to_7cm soil_temperature_7_to_28cm
    soil_temperature_28_to_100cm soil_temperature_100_to_255cm
    soil_moisture_0_to_7cm soil_moisture_7_to_28cm soil_moisture_28_to_100cm
    soil_moisture_100_to_255cm boundary_layer_height wet_bulb_temperature_2m
    total_column_integrated_water_vapour is_day sunshine_duration
    shortwave_radiation direct_radiation diffuse_radiation
    direct_normal_irradiance global_tilted_irradiance terrestrial_radiation
    shortwave_radiation_instant direct_radiation_instant
    diffuse_radiation_instant direct_normal_irradiance_instant
    global_tilted_irradiance_instant terrestrial_radiation_instant
    """.split()
)

# -- fixed values: metric catalogue (metric, label, unit, value of a day) --------
METRIC_CATALOGUE = (
    ("temperature_2m", "Temperature", "°C", "mean"),
    ("precipitation", "Precipitation", "mm/day", "sum"),
    ("relative_humidity_2m", "Relative humidity", "%", "mean"),
    ("wind_speed_10m", "Wind speed · 10 m", "m/s", "mean"),
    ("apparent_temperature", "Feels-like temperature", "°C", "mean"),
    ("dew_point_2m", "Dew point", "°C", "mean"),
    ("cloud_cover", "Cloud cover", "%", "mean"),
    ("surface_pressure", "Surface pressure", "hPa", "mean"),
    ("soil_temperature_0_to_7cm", "Soil temperature · 0–7 cm", "°C", "mean"),
    ("soil_moisture_0_to_7cm", "Soil moisture · 0–7 cm", "m³/m³", "mean"),
    ("shortwave_radiation", "Shortwave radiation", "W/m²", "mean"),
    ("snow_depth", "Snow depth", "m", "mean"),
)
CATALOGUE_SCHEMA = "metric string, label string, unit string, daily_aggregation string"

# -- fixed values: location attributes and published tables -----------------------
SITE_COLUMNS = (
    "location_id",
    "name",
    "country",
    "region",
    "latitude",
    "longitude",
    "elevation_m",
)
SITE_CSV_SCHEMA = T.StructType(
    [
        T.StructField("location_id", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)
LAPSE_SCHEMA = (
    "season string, slope_c_per_m double, lapse_rate_c_per_km double, "
    "intercept_c double, r2 double, rmse_c double, sample_size bigint"
)
PUBLISHED_TABLES = {
    "locations": SITE_COLUMNS,
    "enriched_weather": (
        "location_id", "timestamp", "date", "year", "season", "region", "elevation_band",
        "temperature_2m", "precipitation", "wind_speed_10m", "relative_humidity_2m",
    ),
    "daily_metrics": (
        "location_id", "name", "region", "date", "elevation_m", "elevation_band", "season",
        "daily_avg_temperature_c", "daily_precipitation_mm", "daily_avg_wind_speed_ms",
        "temperature_30d_rolling_avg_c",
    ),
    "summaries": (
        "elevation_band", "region", "season", "year", "avg_temperature_c",
        "total_precipitation_mm", "avg_wind_speed_ms", "avg_relative_humidity_pct",
        "observation_count",
    ),
    "yearly_metrics": (
        "location_id", "name", "year", "annual_avg_temperature_c", "temperature_yoy_change_c",
    ),
    "lapse_rates": (
        "season", "slope_c_per_m", "lapse_rate_c_per_km", "intercept_c", "r2", "rmse_c",
        "sample_size",
    ),
}

# -- fixed values: identifier patterns --------------------------------------------
VERSION_PATTERN = "^[A-Za-z0-9][A-Za-z0-9_-]{0,79}$"
SITE_ID_PATTERN = "^[a-z0-9_]+$"
