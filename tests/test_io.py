"""Round trips of every sink and source, each in its own folder."""

import pytest
from pyspark.sql import functions as F

from tasador.layers import gold_layer, silver_layer
from tasador.schemas import SILVER
from tasador.sources import readers, writers


def record(url, **changes):
    base = {
        "source": "Portal X", "url": url, "title": "t", "raw_price": "100 €", "raw_area": "10 m²",
        "scraped_at": "2024-01-15T10:00:00", "extra": "ignored",
    }
    return {**base, **changes}


def test_ingest_splits_appends_and_counts(spark, tmp_path):
    good, bad = str(tmp_path / "bronze"), str(tmp_path / "rejected")
    batch = [record("u1", latitude="40.5"), record("u2", raw_price=None), record("u3", longitude="x")]
    counts = writers.ingest_records(spark, batch, good, bad, "Mi Portal", "2024-01-15")
    assert counts == {"valid": 1, "rejected": 2}
    writers.ingest_records(spark, [record("u4")], good, bad, "Mi Portal", "2024-01-15")
    rows = readers.read_bronze(spark, good).orderBy("url").collect()
    assert [(r.url, r.source, r.date, r.scrape_date) for r in rows] == [
        ("u1", "mi_portal", "2024-01-15", "2024-01-15"), ("u4", "mi_portal", "2024-01-15", "2024-01-15")
    ]
    assert (rows[0].latitude, rows[1].latitude) == (40.5, None)
    assert (tmp_path / "bronze" / "source=mi_portal" / "date=2024-01-15").is_dir()
    reasons = {r.url: r.reject_reason for r in spark.read.parquet(bad).collect()}
    assert reasons == {"u2": "raw_price missing", "u3": "longitude not a number"}


@pytest.mark.parametrize("batch", [[], [record("u", title=None)]])
def test_ingest_without_a_good_record_fails(spark, tmp_path, batch):
    with pytest.raises(ValueError):
        writers.ingest_records(spark, batch, str(tmp_path / "b"), str(tmp_path / "r"), "x")


def test_default_directory_date_is_today(spark, tmp_path):
    writers.ingest_records(spark, [record("u")], str(tmp_path / "b"), str(tmp_path / "r"), "x")
    row = readers.read_bronze(spark, str(tmp_path / "b")).first()
    assert row.scrape_date == "2024-01-15" and row.date > "2024-01-15"


def test_types_and_offsets(spark, tmp_path):
    good, bad = str(tmp_path / "bronze"), str(tmp_path / "rejected")
    batch = [
        record("u1", scraped_at="2024-01-15T23:30:00+05:00"), record("u2", scraped_at="2024-01-15T23:30:00Z"),
        record("u3", scraped_at="2024-01-15 23:30:00"), record("u4", scraped_at="2024-01-15T23:30:00-05:00"),
        record(["x"]), record("u5", title=5, raw_area={"a": 1}), record("u6", latitude=40.5),
        record("u7", longitude=True),
    ]
    assert writers.ingest_records(spark, batch, good, bad, "x") == {"valid": 5, "rejected": 3}
    rows = {r.url: str(r.scraped_at) for r in readers.read_bronze(spark, good).collect()}
    assert rows["u1"] == "2024-01-15 18:30:00" and rows["u4"] == "2024-01-16 04:30:00"
    assert rows["u2"] == rows["u3"] == "2024-01-15 23:30:00"
    reasons = {r.url: r.reject_reason for r in spark.read.parquet(bad).collect()}
    assert reasons["['x']"] == "url not a text"
    assert reasons["u5"] == "title not a text; raw_area not a text"
    assert reasons["u7"] == "longitude not a number; longitude not a number"


def test_full_replacement(spark, tmp_path):
    path = str(tmp_path / "silver")
    writers.write_silver(silver_row(spark, "a", "1", "old").union(silver_row(spark, "a", "2", "gone")), path)
    assert writers.write_silver(silver_row(spark, "a", "1", "new"), path, replace_all=True) == 1
    assert [r.url for r in readers.read_silver(spark, path).collect()] == ["new"]


def silver_row(spark, source, date, url):
    return spark.createDataFrame(
        [(source, url, "t", 1.0, 1.0, 1, 1.0, "n", "d", None, None, None, date)], SILVER
    )


def test_silver_replaces_only_written_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    first = silver_row(spark, "a", "1", "old").union(silver_row(spark, "a", "2", "kept"))
    assert writers.write_silver(first, path) == 2
    assert writers.write_silver(silver_row(spark, "a", "1", "new"), path) == 1
    rows = readers.read_silver(spark, path).orderBy("scrape_date").collect()
    assert [r.url for r in rows] == ["new", "kept"]
    assert rows[0].latitude is None and dict(readers.read_silver(spark, path).dtypes)["latitude"] == "double"


def test_writes_of_nothing_count_zero(spark, tmp_path):
    empty = silver_row(spark, "a", "1", "x").filter("false")
    assert writers.write_silver(empty, str(tmp_path / "silver")) == 0


def test_gold_files_are_ordered(spark, sf_dir, tmp_path):
    path = str(tmp_path / "gold")
    gold = gold_layer(spark, sf_dir)
    assert writers.write_gold(gold, path) == gold.count()
    written = readers.read_gold(spark, path)
    where = written.select("rank", F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("b"))
    ranks = {}
    for r in where.collect():
        ranks.setdefault(r.file, []).append(r["rank"])
    assert all(v == sorted(v) for v in ranks.values())
    assert writers.publish(spark, path, "published_gold") == gold.count()
    assert spark.table("published_gold").columns == written.columns
    # Another session of the catalog reads it, too, and a rebuilt table replaces it.
    assert spark.newSession().table("published_gold").count() == gold.count()
    assert writers.publish(spark, path, "published_gold") == gold.count()


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    writers.write_csv(spark.createDataFrame([("a, b", 1)], "title string, price int"), path)
    assert spark.read.option("header", True).csv(path).first().title == "a, b"


def test_save_replaces_and_ignores_nothing(spark):
    assert writers.save(spark, [{"a": 1}, {"a": 2}], "saved_records") == 2
    assert writers.save(spark, [{"a": 3}], "saved_records") == 1
    assert writers.save(spark, [], "saved_records") == 0
    assert [r.a for r in spark.table("saved_records").collect()] == [3]


def test_gazetteer_csv(spark, tmp_path):
    (tmp_path / "d.csv").write_text("district,lat,lon,avg_price_sqm\nCentro,40.4,-3.7,5500\n")
    (tmp_path / "b.csv").write_text("barrio,district,lat,lon,price_min,price_max\nSol,Centro,40.4,-3.7,4800,6200\n")
    districts, barrios = readers.read_gazetteer(spark, str(tmp_path / "d.csv"), str(tmp_path / "b.csv"))
    assert districts.first().avg_price_sqm == 5500.0 and barrios.first().price_max == 6200


def test_require_rows(spark, sf_dir):
    silver = silver_layer(spark, sf_dir)
    assert readers.require_rows(silver, "Silver") is silver
    with pytest.raises(ValueError, match="Silver is empty"):
        readers.require_rows(silver.filter("false"), "Silver")


@pytest.fixture
def small_tasks(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    yield
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def one_day(spark, rows):
    """Silver rows of one source and one day, all alike but for the url."""
    return spark.range(rows).select(
        F.lit("s").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("url"),
        F.lit("t").alias("title"), F.lit(1.0).alias("price_eur"), F.lit(1.0).alias("area_sqm"),
        F.lit(1).alias("rooms"), F.lit(1.0).alias("price_per_sqm"), F.lit("n").alias("neighborhood"),
        F.lit("d").alias("district"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"),
        F.lit(None).cast("timestamp_ntz").alias("scraped_at"), F.lit("1").alias("scrape_date"),
    )


def test_a_huge_day_is_split_over_tasks(spark, small_tasks, tmp_path):
    path = str(tmp_path / "silver")
    assert writers.write_silver(one_day(spark, 40_000), path) == 40_000
    assert len(readers.read_silver(spark, path).inputFiles()) > 3


def test_rows_of_one_rank_are_split_over_tasks(spark, tmp_path):
    path = str(tmp_path / "gold")
    gold = one_day(spark, 40_000).withColumns({
        "neighborhood_avg_price_per_sqm": F.lit(1.0), "opportunity_index": F.lit(-1.0),
        "rank": F.lit(1).cast("bigint"),
    })
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert writers.write_gold(gold, path, tasks=6) == 40_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(readers.read_gold(spark, path).inputFiles()) == 6


def test_layers_serve_other_sessions(spark, sf_dir):
    other = spark.newSession()
    layer = gold_layer(other, sf_dir)
    layer.createOrReplaceTempView("seen_by_other")
    assert other.sql("SELECT * FROM seen_by_other").count() == gold_layer(spark, sf_dir).count()
