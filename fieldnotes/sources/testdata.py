"""The TPC-H-like test tables, and their mapping to raw observation versions.

One line item becomes one observation version. The mapping joins line items
with orders, parts and suppliers (and the 25-row nation code table); every
key resolves, so no row is lost. Column recipes are the fixed mapping the
test oracle also uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldnotes.functions.keys import row_id
from fieldnotes.params import Params
from fieldnotes.schemas import RAW_OBSERVATION, conform
from fieldnotes.session import sent

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed values of the mapping: ranks by brand number modulo 5, the common-name
# prefix, the URL prefix and the coordinate recipe.
RANK_BY_BRAND_MOD5 = {0: "genus", 1: "subspecies"}  # every other remainder: "species"
COMMON_PREFIX = "common "
URL_PREFIX = "https://example.org/"
LAT_BASE, LAT_STEP = "42", "0.137"
LON_BASE, LON_STEP = "-117", "0.291"


def raw_observations(spark: SparkSession, sf_dir: str, params: Params) -> DataFrame:
    """Raw observation log (schema ``RAW_OBSERVATION``) built from the tables.

    Suppliers and parts are sent to the line items while they are few, so that these are moved once, to meet their orders.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part = sent(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name"))
    nation = sent(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    supplier = sent(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
    joined = (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    brand_no = F.col("p_brand").substr(F.lit(7), F.length("p_brand")).cast("int")
    common = F.concat(F.lit(COMMON_PREFIX), F.col("p_brand"))
    suppmod = F.col("l_suppkey") % 3
    lat = F.expr(f"cast({LAT_BASE} + s_nationkey * {LAT_STEP} as decimal(12,6))")
    lon = F.expr(f"cast({LON_BASE} - s_nationkey * {LON_STEP} as decimal(12,6))")
    rank = F.when(brand_no % 5 == 0, F.lit(RANK_BY_BRAND_MOD5[0])).when(
        brand_no % 5 == 1, F.lit(RANK_BY_BRAND_MOD5[1])
    ).otherwise(F.lit("species"))
    native = F.col("l_linestatus") == F.lit("F")
    ship = F.col("l_shipdate")
    out = joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("inaturalist_id"),
        brand_no.alias("taxon_id"),
        F.col("p_brand").alias("name"),
        common.alias("preferred_common_name"),
        ship.alias("observed_date"),
        F.month(ship).cast("double").alias("observed_month"),
        F.lit(0.0).alias("observed_hour"),
        F.weekofyear(ship).cast("double").alias("observed_week"),
        F.year(ship).cast("double").alias("observed_year"),
        F.dayofmonth(ship).cast("double").alias("observed_day"),
        F.greatest(ship, F.col("o_orderdate")).alias("updated_at"),
        F.when(suppmod == 0, common).when(suppmod == 1, F.col("p_name")).alias("species_guess"),
        F.concat(F.lit("{"), F.col("s_nationkey").cast("string"), F.lit(","),
                 F.col("n_regionkey").cast("string"), F.lit("}")).alias("place_ids"),
        F.concat(lat.cast("string"), F.lit(","), lon.cast("string")).alias("location"),
        F.when(F.col("l_returnflag") == "A", F.lit(True))
        .when(F.col("l_returnflag") == "R", F.lit(False)).alias("endemic"),
        native.alias("native"),
        (~native).alias("introduced"),
        F.when(F.col("l_quantity") > 40, F.lit(True))
        .when(F.col("l_quantity") > 10, F.lit(False)).alias("threatened"),
        rank.alias("rank"),
        F.concat(F.lit(URL_PREFIX), F.col("p_brand")).alias("wikipedia_url"),
        F.lit(None).cast("boolean").alias("out_of_range"),
        F.lit(None).cast("boolean").alias("identifications_most_disagree"),
        F.lit(params.as_of).alias("_data_loaded_date"),
    )
    out = out.withColumn("id", row_id("inaturalist_id", "updated_at", "name"))
    return conform(out, RAW_OBSERVATION)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
