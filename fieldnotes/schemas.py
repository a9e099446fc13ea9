"""Explicit schemas for every stored or landed dataset (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One taxon as the API returns it inside an observation.
TAXON = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("rank", T.StringType()),
        T.StructField("preferred_common_name", T.StringType()),
        T.StructField("wikipedia_url", T.StringType()),
        T.StructField("endemic", T.BooleanType()),
        T.StructField("native", T.BooleanType()),
        T.StructField("introduced", T.BooleanType()),
        T.StructField("threatened", T.BooleanType()),
    ]
)

OBSERVED_ON_DETAILS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)

API_RESULT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("species_guess", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("place_ids", T.ArrayType(T.IntegerType())),
        T.StructField("updated_at", T.StringType()),
        T.StructField("out_of_range", T.BooleanType()),
        T.StructField("captive", T.BooleanType()),
        T.StructField("identifications_most_disagree", T.BooleanType()),
        T.StructField("observed_on_details", OBSERVED_ON_DETAILS),
        T.StructField("taxon", TAXON),
    ]
)

# One landed page of the observations API (one JSON document per line).
RAW_API = T.StructType(
    [
        T.StructField("total_results", T.LongType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("per_page", T.IntegerType()),
        T.StructField("place_id", T.IntegerType()),
        T.StructField("results", T.ArrayType(API_RESULT)),
    ]
)

# The append-only log of observation versions.
RAW_OBSERVATION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("inaturalist_id", T.LongType()),
        T.StructField("taxon_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("preferred_common_name", T.StringType()),
        T.StructField("observed_date", T.TimestampNTZType()),
        T.StructField("observed_month", T.DoubleType()),
        T.StructField("observed_hour", T.DoubleType()),
        T.StructField("observed_week", T.DoubleType()),
        T.StructField("observed_year", T.DoubleType()),
        T.StructField("observed_day", T.DoubleType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("species_guess", T.StringType()),
        T.StructField("place_ids", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("endemic", T.BooleanType()),
        T.StructField("native", T.BooleanType()),
        T.StructField("introduced", T.BooleanType()),
        T.StructField("threatened", T.BooleanType()),
        T.StructField("rank", T.StringType()),
        T.StructField("wikipedia_url", T.StringType()),
        T.StructField("out_of_range", T.BooleanType()),
        T.StructField("identifications_most_disagree", T.BooleanType()),
        T.StructField("_data_loaded_date", T.DateType()),
    ]
)

# Columns of one forecast step before stamping.
FORECAST_CORE = T.StructType(
    [
        T.StructField("unique_id", T.StringType()),
        T.StructField("ds", T.TimestampNTZType()),
        T.StructField("y_hat", T.DoubleType()),
        T.StructField("y_hat_lo", T.DoubleType()),
        T.StructField("y_hat_hi", T.DoubleType()),
    ]
)

# The stored forecast history. unique_id is text because location series
# are keyed by an MD5 surrogate.
FORECAST = T.StructType(
    [
        T.StructField("ds", T.TimestampNTZType()),
        T.StructField("unique_id", T.StringType()),
        T.StructField("auto_arima", T.DoubleType()),
        T.StructField("auto_arima_lo_90", T.DoubleType()),
        T.StructField("auto_arima_hi_90", T.DoubleType()),
        T.StructField("forecast_type", T.StringType()),
        T.StructField("_date_forecasted", T.DateType()),
    ]
)

def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to exactly the fields of ``schema``, in order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
