"""Scans. Every schema is declared, so an all-null column keeps its type."""

from pyspark.sql import DataFrame, SparkSession

from tasador.schemas import BRONZE, BRONZE_CSV, GAZETTEER_BARRIO, GAZETTEER_DISTRICT, GOLD, SILVER


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail on an empty input; reads one row, not all."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path)


def read_bronze_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE_CSV).option("header", True).csv(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SILVER).parquet(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GOLD).parquet(path)


def read_gazetteer(
    spark: SparkSession, districts_path: str, barrios_path: str
) -> tuple[DataFrame, DataFrame]:
    """Districts and barrios from headed CSV files."""
    reader = spark.read.option("header", True)
    return (
        reader.schema(GAZETTEER_DISTRICT).csv(districts_path),
        reader.schema(GAZETTEER_BARRIO).csv(barrios_path),
    )
