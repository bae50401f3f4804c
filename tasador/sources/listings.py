"""Listings and a gazetteer derived from the star-schema tables.

Line items become listings: the natural duplicates of (order, line) are copies
of a listing, and texts are rendered the way portals write them.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records in Bronze's columns, one per line item."""
    items = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    has_place = F.col("l_quantity") != 50
    price = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    return items.select(
        F.when(F.col("l_suppkey") % 2 == 0, "portal_a").otherwise("portal_b").alias("source"),
        F.concat_ws(
            "/", F.lit("https://listings.example"), "l_orderkey", "l_linenumber"
        ).alias("url"),
        F.col("p_name").alias("title"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_tax") == 0), "A consultar")
        .otherwise(F.concat(price, F.lit(" €"))).alias("raw_price"),
        F.concat(F.col("l_quantity").cast("int"), F.lit(" m²")).alias("raw_area"),
        F.when(F.col("l_tax") < 0.07, F.concat("l_linenumber", F.lit(" hab."))).alias("raw_rooms"),
        F.concat_ws(" ", "n_name", "p_type").alias("neighborhood"),
        F.col("n_name").alias("district"),
        F.when(has_place, F.col("l_partkey") % 1000 * F.lit(0.00018) + F.lit(40.35)).alias("latitude"),
        F.when(has_place, F.col("l_orderkey") % 1000 * F.lit(0.00022) + F.lit(-3.80)).alias("longitude"),
        F.col("l_shipdate").alias("scraped_at"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("scrape_date"),
    )


def gazetteer_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A district per nation, with centre and reference price from its key."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.initcap("n_name").alias("district"),
        (key % 5 * F.lit(0.03) + F.lit(40.37)).alias("lat"),
        (F.floor(key / 5) * F.lit(0.04) + F.lit(-3.78)).alias("lon"),
        (key * 40.0 + F.lit(1500.0)).alias("avg_price_sqm"),
    )


def gazetteer_barrios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A barrio per nation and part type that occur together by key."""
    kinds = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 25).cast("int").alias("n_nationkey"), "p_type"
    ).distinct()
    named = kinds.join(table(spark, sf_dir, "nation"), "n_nationkey")
    key = F.col("n_nationkey")
    return named.select(
        F.concat_ws(" ", "n_name", "p_type").alias("barrio"),
        F.initcap("n_name").alias("district"),
        (key % 5 * F.lit(0.03) + F.length("p_type") * F.lit(0.002) + F.lit(40.36)).alias("lat"),
        (F.floor(key / 5) * F.lit(0.04) + F.lit(-3.785)).alias("lon"),
        (key * 30 + 800).cast("int").alias("price_min"),
        (key * 50 + F.length("p_type") * 100 + 1800).cast("int").alias("price_max"),
    )
