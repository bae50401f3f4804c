"""Operators on small fixtures, against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tasador.functions.hashing import hash60
from tasador.operators import (
    cleaning, extraction, indexes, lookups, radius, sampling, serving, validation,
)
from tasador.schemas import GAZETTEER_BARRIO, GAZETTEER_DISTRICT, INCOMING, SILVER


def silver_rows(spark, rows):
    """(url, date, neighborhood, price, area) as Silver rows."""
    return spark.createDataFrame([
        ("s", url, "t", float(price), float(area), 2, price / area, hood, "D", 40.0, -3.7, None, date)
        for url, date, hood, price, area in rows
    ], SILVER)


def test_index_a_keeps_gaps_unless_ranked_after(spark):
    silver = silver_rows(spark, [
        ("a", "1", "X", 100, 1), ("b", "1", "X", 300, 1), ("c", "1", "Lone", 50, 1),
        ("d", "1", "X", 100, 1), ("e", "2", "X", 10, 1),
    ])
    ranks = {r.url: (round(r.opportunity_index, 6), r["rank"]) for r in indexes.index_a(silver).collect()}
    assert ranks == {"a": (0.4, 1), "d": (0.4, 1), "b": (-0.8, 4)}
    after = {r.url: r["rank"] for r in indexes.index_a(silver, rank_after_filter=True).collect()}
    assert after == {"a": 1, "d": 1, "b": 3}


def test_index_b_over_all_days(spark):
    silver = silver_rows(spark, [("a", "1", "X", 100, 10), ("a", "2", "X", 300, 10)])
    rows = {r.url: r for r in indexes.index_b(silver).collect()}
    assert rows["https://listings.example/inmueble/a-1/"].opportunity_index == 0.5
    assert rows["https://listings.example/inmueble/a-2/"].opportunity_index == -0.5
    assert {r.area_m2 for r in rows.values()} == {10.0}


def test_latest_copy_prefers_time_then_values(spark):
    rows = spark.createDataFrame(
        [("u", "1", "2024-01-01", 5), ("u", "1", "2024-01-02", 1), ("u", "1", "2024-01-02", 3),
         ("u", "1", None, 9), ("v", "1", None, 1)],
        "url string, scrape_date string, scraped_at string, v int",
    )
    kept = {r.url: r.v for r in cleaning.latest_copy(rows).collect()}
    assert kept == {"u": 3, "v": 1}
    assert tuple(cleaning.copy_counts(rows).first()) == (5, 2, 3)


def test_check_records(spark):
    good = ("s", "u", "t", "", "85 m²", None, None, None, "40.5", None, "2024-01-15T10:00:00", "")
    cases = [
        (good, ""),
        ((None, *good[1:]), "source missing"),
        ((*good[:3], None, *good[4:]), "raw_price missing"),
        ((*good[:8], "north", *good[9:]), "latitude not a number"),
        ((*good[:10], "ayer", ""), "scraped_at not a time"),
    ]
    incoming = spark.createDataFrame([c for c, _ in cases], INCOMING).coalesce(1)
    rows = validation.check_records(incoming).collect()
    assert [r.reject_reason for r in rows] == [reason for _, reason in cases]
    assert rows[0].scrape_date == "2024-01-15" and rows[0].latitude == 40.5


def test_absent_time_is_now(spark):
    incoming = spark.createDataFrame([("s", "u", "t", "", "") + (None,) * 7], INCOMING)
    row = validation.check_records(incoming).first()
    assert row.is_valid and row.scraped_at is not None
    assert row.scrape_date == row.scraped_at.strftime("%Y-%m-%d")


def test_gazetteer_prefers_barrios(spark):
    districts = spark.createDataFrame(
        [("Centro", 40.4, -3.7, 5500.0), ("Sol", 1.0, 1.0, 1.0)], GAZETTEER_DISTRICT
    )
    barrios = spark.createDataFrame([("Sol", "Centro", 40.41, -3.70, 4800, 6200)], GAZETTEER_BARRIO)
    places = lookups.place_names(districts, barrios)
    names = spark.createDataFrame([("SOL",), ("centro",), ("Marte",), (None,)], "name string")
    found = {r.name: tuple(r)[1:] for r in lookups.locate(names, places, "name", ["name"]).collect()}
    assert found["SOL"] == ("Centro", 40.41, -3.70, 4800, 6200)
    assert found["centro"] == ("Centro", 40.4, -3.7, 4675, 6324)
    assert found["Marte"] == found[None] == (None,) * 5
    centers = lookups.district_center(
        spark.createDataFrame([("Centro",), ("centro",)], "district string"), districts, ["district"]
    )
    assert {r.district: r.center_lat for r in centers.collect()} == {"Centro": 40.4, "centro": None}


def brute_distance(a, b):
    (la, lo), (lb, mo) = a, b
    cosine = math.cos(math.radians(la)) * math.cos(math.radians(lb)) * math.cos(
        math.radians(mo) - math.radians(lo)
    ) + math.sin(math.radians(la)) * math.sin(math.radians(lb))
    return 6371.0 * math.acos(max(-1.0, min(1.0, cosine)))


@pytest.mark.parametrize("radius_km", [0.5, 5.0, 50.0])
def test_radius_join_equals_brute_force(spark, radius_km):
    """Around the equator, the date line, high latitudes and both poles."""
    rng = random.Random(7)
    anchors = [(0.0, 0.0), (40.4, -3.7), (10.0, 180.0), (-10.0, -180.0), (89.95, 20.0), (-90.0, 0.0), (70.0, 179.99)]
    spread = math.degrees(radius_km / 6371.0) * 1.6
    points, centers = [], []
    for lat, lon in anchors:
        for _ in range(25):
            stretch = 1 / max(math.cos(math.radians(lat)), 0.02)
            points.append((
                max(-90.0, min(90.0, lat + rng.uniform(-spread, spread))),
                (lon + rng.uniform(-spread, spread) * stretch + 180) % 360 - 180,
            ))
        centers.append((lat, lon))
    listings = spark.createDataFrame(
        [(str(i), "1", *p) for i, p in enumerate(points)],
        "url string, scrape_date string, latitude double, longitude double",
    )
    center_table = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(centers)], "c int, center_lat double, center_lon double"
    )
    got = sorted((r.c, int(r.url)) for r in radius.radius_join(listings, center_table, radius_km).collect())
    want = sorted(
        (i, j) for i, c in enumerate(centers) for j, p in enumerate(points)
        if brute_distance(c, p) <= radius_km
    )
    assert got == want and want
    for i, (lat, lon) in enumerate(centers):
        near = radius.within_radius(listings, lat, lon, radius_km).collect()
        assert sorted(int(r.url) for r in near) == [j for c, j in want if c == i]


@pytest.mark.parametrize("bad", [0.05, 51])
def test_radius_bounds(spark, bad):
    with pytest.raises(ValueError):
        radius.within_radius(spark.range(1), 0, 0, bad)


@pytest.mark.parametrize("rows, fraction, size", [(1, 0.05, 1), (50, 0.05, 2), (70, 0.05, 4), (1000, 0.3, 300), (10, 1.0, 10)])
def test_exact_sample(spark, rows, fraction, size):
    table = spark.range(rows)
    tagged = sampling.tag_exact_sample(table, "id", fraction)
    chosen = {r.id for r in tagged.filter("is_sampled").collect()}
    order = table.select("id", hash60(F.col("id")).alias("h")).orderBy("h", "id").collect()
    assert tagged.count() == rows
    assert chosen == {r.id for r in order[:size]} and len(chosen) == size


def test_sample_of_nothing(spark):
    assert sampling.tag_exact_sample(spark.range(0), "id", 0.5).count() == 0


def gold_rows(spark, rows):
    silver = silver_rows(spark, [(u, d, "X", 100, 1) for u, d, _ in rows]).drop("scraped_at")
    indexed = spark.createDataFrame([(u, d, float(i)) for u, d, i in rows], "url string, scrape_date string, opportunity_index double")
    return silver.join(indexed, ["url", "scrape_date"]).withColumn(
        "neighborhood_avg_price_per_sqm", F.lit(1.0)
    )


def test_top_deals_order_and_bounds(spark):
    gold = gold_rows(spark, [("b", "2", 0.5), ("a", "2", 0.5), ("c", "2", 0.9), ("d", "2", 0.0), ("e", "1", 0.99)])
    assert [r.url for r in serving.top_deals(gold).collect()] == ["c", "a", "b"]
    assert [r.url for r in serving.top_deals(gold, 1, "1").collect()] == ["e"]
    for n in (0, 101):
        with pytest.raises(ValueError):
            serving.top_deals(gold, n)


def test_filters(spark):
    deals = spark.createDataFrame(
        [("a", 10.0, 50.0, 2, "X"), ("b", 10.0, 50.0, None, "X"), ("c", 99.0, 50.0, 3, "Y"), ("d", 10.0, 5.0, 3, "X")],
        "url string, price_eur double, area_sqm double, rooms int, district string",
    )

    def urls(**filters):
        return sorted(r.url for r in serving.apply_filters(deals, **filters).collect())

    assert urls() == urls(district="All Districts", min_rooms=0) == ["a", "b", "c", "d"]
    assert urls(min_rooms=1) == ["a", "c", "d"]
    assert urls(max_price=10, min_area=10, district="X") == ["a", "b"]


def test_envelope(spark):
    gold = gold_rows(spark, [("b", "2", 0.5), ("a", "2", 0.5), ("c", "2", 0.9)])
    row = serving.deals_envelope(serving.top_deals(gold)).first()
    assert (row.total, row.scrape_date) == (3, "2")
    assert [d.url for d in row.deals] == ["c", "a", "b"]
    empty = serving.deals_envelope(serving.top_deals(gold, scrape_date="9")).first()
    assert (empty.total, empty.scrape_date, empty.deals) == (0, None, [])


def test_envelope_of_dates(spark):
    gold = gold_rows(spark, [("a", "2024-01-15", 0.5)]).withColumn("scrape_date", F.to_date("scrape_date"))
    assert serving.deals_envelope(serving.top_deals(gold)).first().scrape_date == "2024-01-15"


def test_query_parameters(spark):
    spark.range(10).createOrReplaceTempView("numbers")
    run = lambda sql, params=None: [r.id for r in serving.query(spark, sql, params).collect()]
    assert len(run("SELECT id FROM numbers")) == 10
    assert run("SELECT id FROM numbers WHERE id > ? AND id < ?", {"low": 3, "high": 5}) == [4]
    assert run("SELECT id FROM numbers WHERE id > ? AND id < ?", [3, 5]) == [4]
    assert run("SELECT id FROM numbers WHERE id = :wanted", {"wanted": 7}) == [7]


def test_dataset_summary(spark):
    rows = spark.createDataFrame(
        [("D", "a", 5.0, 10.0), ("D", "b", 0.0, 20.0), ("E", "a", 0.0, 30.0)],
        "district string, neighborhood string, opportunity_index double, price_per_sqm double",
    )
    assert serving.dataset_summary(rows).first().asDict() == {
        "listings": 3, "districts": 2, "neighborhoods": 2, "opportunity_deals": 1,
        "avg_price_per_sqm": 20.0, "opportunity_share_pct": 33.3,
    }


def test_sample_ignores_null_keys(spark):
    rows = spark.createDataFrame([(i if i % 3 else None,) for i in range(30)], "k int")
    tagged = sampling.tag_exact_sample(rows, "k", 0.5)
    assert tagged.filter("is_sampled").count() == 10
    assert tagged.filter("k IS NULL AND is_sampled").count() == 0
    none = spark.createDataFrame([(None,)], "k int")
    assert sampling.tag_exact_sample(none, "k", 0.5).filter("is_sampled").count() == 0


def test_parameter_styles(spark):
    assert serving.query(spark, "SELECT '10:now' AS a, ? AS b", {"n": 0}).first() == ("10:now", 0)
    assert serving.query(spark, "SELECT 'why?' AS a, :n AS b", {"n": 1}).first() == ("why?", 1)


def test_a_district_listed_twice_multiplies_nothing(spark):
    twice = spark.createDataFrame([("d", 1.0, 2.0), ("d", 1.5, 0.0)], "district string, lat double, lon double")
    named = spark.createDataFrame([("d", 1), ("e", 2)], "district string, id int")
    rows = lookups.district_center(named, twice, ["id"]).orderBy("id").collect()
    assert [(r.id, r.center_lat, r.center_lon) for r in rows] == [(1, 1.5, 0.0), (2, None, None)]


def test_unknown_sources_are_reported_and_refused(spark):
    pages = spark.createDataFrame(
        [(1, "Fotocasa ", ""), (2, "habitaclia", ""), (3, None, "")], "page_id int, source string, html string")
    found = extraction.unknown_sources(pages, ["fotocasa", "idealista"])
    assert sorted(r.page_id for r in found.collect()) == [2, 3]
    with pytest.raises(Exception, match="habitaclia|null"):
        extraction.extract_cards(pages).collect()
