"""Declared record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Measurement columns of an energy record, all optional numbers.
ENERGY_VALUES = (
    "generation_biomass",
    "generation_fossil_brown_coal_lignite",
    "generation_fossil_coal_derived_gas",
    "generation_fossil_gas",
    "generation_fossil_hard_coal",
    "generation_fossil_oil",
    "generation_hydro_pumped_storage_consumption",
    "generation_hydro_run_of_river_and_poundage",
    "generation_hydro_water_reservoir",
    "generation_nuclear",
    "generation_other",
    "generation_other_renewable",
    "generation_solar",
    "generation_waste",
    "generation_wind_onshore",
    "forecast_solar_day_ahead",
    "forecast_wind_onshore_day_ahead",
    "total_load_forecast",
    "total_load_actual",
    "price_day_ahead",
    "price_actual",
)
# Measurement columns of a weather record, all optional numbers.
WEATHER_VALUES = (
    "temp", "temp_min", "temp_max", "pressure", "humidity", "wind_speed", "wind_deg",
    "rain_1h", "rain_3h", "snow_1h", "snow_3h", "clouds_all",
)

ENERGY = T.StructType(
    [T.StructField("time", T.StringType(), False), *[T.StructField(c, T.DoubleType()) for c in ENERGY_VALUES]]
)
WEATHER = T.StructType(
    [
        T.StructField("dt_iso", T.StringType(), False),
        T.StructField("city_name", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in WEATHER_VALUES],
        T.StructField("weather_id", T.IntegerType()),
        T.StructField("weather_main", T.StringType()),
        T.StructField("weather_description", T.StringType()),
        T.StructField("weather_icon", T.StringType()),
    ]
)

# Texts that stand for a missing value in a CSV field.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
