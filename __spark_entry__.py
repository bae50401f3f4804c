"""

Every query reads the whole tables of ``sf_dir``, or layers that Spark derives
from them.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from tasador.functions import geo, markup, parsing, scoring
from tasador.functions.markup import Element
from tasador.layers import bronze_layer, gold_layer, place_layer, refreshed_store, silver_layer
from tasador.operators import (
    cleaning, extraction, indexes, lookups, radius, sampling, serving, validation,
)
from tasador.plans.workspace import fresh_path, materialize
from tasador.schemas import BRONZE_CSV, INCOMING, SILVER
from tasador.sources import listings, readers, snapshots, writers

KEY = ["url", "scrape_date"]
CENTER = (40.4168, -3.7038)

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def _register(query: Query) -> Query:
    _queries[query.__name__] = query
    return query


def entry(spark: SparkSession) -> DataFrame:
    return q_top_deals(spark, "/root/testdata/sf0.001")


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the subpackage ``llm`` and of the pipeline, where they can be
    imported; what is missing otherwise is told in a warning."""
    try:
        import corpus_pipeline
        from tasador.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "tasador.llm"):
            warnings.warn(f"no queries of tasador.llm: {missing}", stacklevel=2)
        return {}, {}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, llm.ORACLES


def queries() -> dict[str, Query]:
    return {**_queries, **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    return {**oracles.statements(), **_llm()[1]}


def _steady(df: DataFrame, *averages: str) -> DataFrame:
    """Averages to four places: the last digits of a sum of doubles depend on the order of
    the rows. They are cut at 0.63 of a place, where unlike at 0.5 no average of prices lies."""
    return df.withColumns({c: F.floor(F.col(c) * 10000 + 0.37) / 10000 for c in averages})


AVERAGE = "neighborhood_avg_price_per_sqm"


# --- Sources and sinks ------------------------------------------------------


def _incoming(spark, sf_dir) -> DataFrame:
    """Raw listings as unchecked text, some of them incomplete or unreadable."""
    raw = bronze_layer(spark, sf_dir)
    asking = F.col("raw_price") == "A consultar"
    texts = raw.select(*[F.col(c).cast("string") for c in INCOMING.fieldNames()])
    return texts.withColumns({
        "raw_price": F.when(~asking, F.col("raw_price")),
        "latitude": F.coalesce("latitude", F.lit("n/a")),
        "scraped_at": F.when(F.col("raw_area") == "49 m²", "ayer").otherwise(F.col("scraped_at")),
    })


def _places(spark, sf_dir) -> DataFrame:
    return materialize(
        lookups.place_names(
            listings.gazetteer_districts(spark, sf_dir), listings.gazetteer_barrios(spark, sf_dir)
        ),
        "places",
    )


@_register
def q_raw_listings(spark, sf_dir):
    """The adapter: raw listings from the star-schema tables."""
    return listings.raw_listings(spark, sf_dir)


@_register
def q_csv_scan(spark, sf_dir):
    """Write the synthetic Bronze form as CSV and scan it."""
    silver = silver_layer(spark, sf_dir)
    scored = indexes.index_c(silver, listings.gazetteer_districts(spark, sf_dir))
    path = fresh_path(spark, "bronze-csv")
    writers.write_csv(scored.withColumns({
        "price": F.col("price_eur").cast("int"),
        "area_sqm": F.col("area_sqm").cast("int"),
        "bathrooms": parsing.bathrooms(F.col("rooms")),
    }).select(*BRONZE_CSV.fieldNames()), path)
    return readers.read_bronze_csv(spark, path)


@_register
def q_bronze_scan(spark, sf_dir):
    """Ingest, then scan the partitioned Bronze files."""
    good, bad = fresh_path(spark, "bronze"), fresh_path(spark, "rejected")
    writers.ingest(_incoming(spark, sf_dir), good, bad, scrape_date="2001-08-01")
    return readers.read_bronze(spark, good).select(
        "source", "date", *KEY, "title", "raw_price", "raw_area", "raw_rooms", "latitude"
    )


@_register
def q_ingest_retry(spark, sf_dir):
    """K1: a batch that is ingested twice has the rows of one, in both folders; a batch of
    another id adds its own."""
    good, bad = fresh_path(spark, "bronze"), fresh_path(spark, "rejected")
    incoming = _incoming(spark, sf_dir)
    late = incoming.filter("scrape_date < '1996'")
    for batch, rows in (("first", incoming), ("first", incoming), ("late", late), ("first", late)):
        writers.ingest(rows, good, bad, scrape_date="2001-08-01", batch_id=batch)
    kept = readers.read_bronze(spark, good).groupBy("source", "scrape_date").agg(
        F.count(F.lit(1)).alias("n")
    ).select(F.lit("bronze").alias("sink"), "source", "scrape_date", F.lit("").alias("reason"), "n")
    refused = spark.read.parquet(bad).groupBy("source", "scrape_date", "reject_reason").agg(
        F.count(F.lit(1)).alias("n")
    )
    return kept.unionAll(refused.select(F.lit("rejected"), "source", "scrape_date", "reject_reason", "n"))


@_register
def q_validate_split(spark, sf_dir):
    """K1: which records are accepted, and why the others are not."""
    checked = validation.check_records(_incoming(spark, sf_dir))
    return checked.select("url", "scrape_date", "is_valid", "reject_reason")


@_register
def q_cleaned_bounds(spark, sf_dir):
    """bounds of cleaned values, on all parsed rows, some of them negative or zero."""
    rooms = F.col("rooms")
    parsed = cleaning.parse_values(bronze_layer(spark, sf_dir)).withColumns({
        "price_eur": F.when(rooms == 1, -F.col("price_eur")).otherwise(F.col("price_eur")),
        "area_sqm": F.when(rooms == 2, 0.0).when(rooms == 3, -F.col("area_sqm"))
        .otherwise(F.col("area_sqm")),
    }).withColumns({
        "rooms": F.when(rooms == 4, -rooms).otherwise(rooms),
        "price_per_sqm": parsing.price_per_sqm(F.col("price_eur"), F.col("area_sqm")),
    })
    return validation.check_cleaned(parsed).groupBy("is_valid", "reject_reason").agg(
        F.count(F.lit(1)).alias("n")
    )


@_register
def q_source_slug(spark, sf_dir):
    """K2: directory-safe names, from supplier and brand names."""
    foreign = F.when(F.col("p_size") % 3 == 0, " España").when(
        F.col("p_size") % 3 == 1, " Espaßa 日本"
    ).otherwise("")
    names = listings.table(spark, sf_dir, "part").select(
        F.concat(F.concat_ws(". ", "p_brand", "p_name"), foreign).alias("source")
    )
    return names.groupBy("source").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "slug", parsing.source_slug(F.col("source"))
    )


@_register
def q_silver_roundtrip(spark, sf_dir):
    """K3: write Silver by source and date, read it back."""
    path = fresh_path(spark, "silver-out")
    writers.write_silver(silver_layer(spark, sf_dir), path)
    return readers.read_silver(spark, path).groupBy("source", "scrape_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("price_eur").cast("decimal(18,2)")).cast("double").alias("price_sum"),
        F.max("scraped_at").cast("date").cast("string").alias("last_day"),
    )


@_register
def q_gold_roundtrip(spark, sf_dir):
    """K4: write Gold by date in rank order, read it back."""
    path = fresh_path(spark, "gold-out")
    writers.write_gold(gold_layer(spark, sf_dir), path)
    return readers.read_gold(spark, path).select(*KEY, "rank", "opportunity_index")


@_register
def q_gold_scan(spark, sf_dir):
    """S3: scan Gold with its date keys."""
    return gold_layer(spark, sf_dir).groupBy("scrape_date").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").alias("first_rank"),
        F.max("opportunity_index").alias("best"),
    )


@_register
def q_publish_count(spark, sf_dir):
    """K6: publish Gold as the serving table and count it."""
    path = fresh_path(spark, "gold-published")
    writers.write_gold(gold_layer(spark, sf_dir), path)
    writers.publish(spark, path)
    return serving.query(spark, "SELECT count(*) AS n FROM gold_listings")


@_register
def q_publish_rollback(spark, sf_dir):
    """K6: Gold in three versions: whole, with changed and without some dates, whole again;
    the second is published last. A reader of the first keeps its rows."""
    root, gold = fresh_path(spark, "gold-versions"), gold_layer(spark, sf_dir)
    snapshots.write_version(gold, root)
    snapshots.publish_version(spark, root, "gold_versions")
    running = spark.table("gold_versions")
    changed = gold.filter("scrape_date < '1996'").withColumn("opportunity_index", -F.col("opportunity_index"))
    second = snapshots.write_version(changed, root, removed=("1998-03",))
    snapshots.write_version(gold, root, replace_all=True)
    snapshots.publish_version(spark, root, "gold_versions")
    snapshots.publish_version(spark, root, "gold_versions", second)

    def per_date(table, name):
        return table.groupBy("scrape_date").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.round(F.col("opportunity_index") * 1_000_000).cast("long")).alias("total"),
        ).select(F.lit(name).alias("reader"), "scrape_date", "n", "total")

    return per_date(running, "first").unionAll(per_date(spark.table("gold_versions"), "second"))


@_register
def q_refreshed_silver(spark, sf_dir):
    """D1 over several runs: the latest copies, as of one run over all rows."""
    return refreshed_store(spark, sf_dir).table("silver")


@_register
def q_refreshed_gold(spark, sf_dir):
    """W4 over several runs: index A and ranks, as of a full rebuild."""
    return _steady(refreshed_store(spark, sf_dir).table("gold"), AVERAGE)


@_register
def q_adhoc_sql(spark, sf_dir):
    """SQL with bound values on the published table."""
    gold_layer(spark, sf_dir).createOrReplaceTempView(writers.GOLD_TABLE)
    return serving.query(
        spark,
        "SELECT district, count(*) AS n, max(opportunity_index) AS best FROM gold_listings "
        "WHERE opportunity_index > ? AND price_eur <= ? GROUP BY district",
        {"least_index": 0.5, "max_price": 50000.0},
    )


# --- Scalar functions -------------------------------------------------------


def _parsed(spark, sf_dir, name, parse):
    raw = bronze_layer(spark, sf_dir)
    texts = ["raw_price", "raw_area", "raw_rooms"]
    return raw.select(*KEY, *texts, *[
        parse(F.col(t)).alias(f"{name}_of_{t}") for t in texts
    ])


@_register
def q_parse_price(spark, sf_dir):
    """P1, applied to all three texts of a listing."""
    return _parsed(spark, sf_dir, "price", parsing.parse_price)


@_register
def q_parse_area(spark, sf_dir):
    """P2."""
    return _parsed(spark, sf_dir, "area", parsing.parse_area)


@_register
def q_parse_rooms(spark, sf_dir):
    """P3."""
    return _parsed(spark, sf_dir, "rooms", parsing.parse_rooms)


@_register
def q_price_per_sqm(spark, sf_dir):
    """P4, null where the area is missing or zero."""
    parsed = cleaning.parse_values(bronze_layer(spark, sf_dir))
    area = F.when(F.col("rooms") == 7, 0.0).otherwise(F.col("area_sqm"))
    return parsed.select(*KEY, "scraped_at", parsing.price_per_sqm(
        F.col("price_eur"), area
    ).alias("price_per_sqm"))


@_register
def q_normalize_text(spark, sf_dir):
    """P5, on padded, blank and missing names."""
    part = listings.table(spark, sf_dir, "part")
    text = (
        F.when(F.col("p_size") <= 5, None)
        .when(F.col("p_size") <= 10, "   ")
        .when(F.col("p_size") <= 30, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))
        .otherwise(F.col("p_name"))
    )
    return part.select("p_partkey", parsing.normalize_text(text).alias("title"))


@_register
def q_split_location(spark, sf_dir):
    """P6, with whole, partial, empty and missing locations."""
    raw = bronze_layer(spark, sf_dir)
    text = (
        F.when(F.col("raw_rooms").isNull(), F.col("neighborhood"))
        .when(F.col("latitude").isNull(), "")
        .when(F.col("raw_price") == "A consultar", None)
        .otherwise(F.concat_ws(" , ", "neighborhood", "district", "source"))
    )
    neighborhood, district = parsing.split_location(text)
    return raw.select(
        *KEY, text.alias("location"), neighborhood.alias("neighborhood"), district.alias("district")
    )


@_register
def q_absolute_url(spark, sf_dir):
    """P7, on the first link of each page and on its own address."""
    pages = listings.table(spark, sf_dir, "pages")
    link = F.regexp_extract("html", '<a href="([^"]*)"', 1)
    host = "https://listings.example"
    return pages.select(
        "page_id", parsing.absolute_url(link, host).alias("link_url"),
        parsing.absolute_url(F.col("url"), host).alias("own_url"),
    )


@_register
def q_synthetic_url(spark, sf_dir):
    """P8, from the order key."""
    return listings.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        parsing.synthetic_url("https://listings.example/inmueble/", F.col("o_orderkey")).alias("url"),
    )


@_register
def q_default_date(spark, sf_dir):
    """The given date, else the day of the scrape."""
    raw = bronze_layer(spark, sf_dir)
    given = (
        F.when(F.col("raw_rooms").isNull(), "")
        .when(F.col("latitude").isNull(), None)
        .otherwise(F.col("scrape_date"))
    )
    return raw.select("url", parsing.default_date(given, F.col("scraped_at")).alias("scrape_date"))


@_register
def q_opportunity_color(spark, sf_dir):
    """P12."""
    return gold_layer(spark, sf_dir).select(
        *KEY, scoring.opportunity_color(F.col("opportunity_index")).alias("color")
    )


@_register
def q_room_band(spark, sf_dir):
    """P13, on areas up to 200 m²."""
    silver = silver_layer(spark, sf_dir)
    area = F.col("area_sqm") * 4
    low, high = parsing.room_band(area)
    return silver.select(
        *KEY, area.alias("area"), low.alias("min_rooms"), high.alias("max_rooms"),
        parsing.bathrooms(F.col("rooms")).alias("bathrooms"),
    )


@_register
def q_distance(spark, sf_dir):
    """P15, to a fixed centre."""
    distance = geo.distance_km(
        F.lit(CENTER[0]), F.lit(CENTER[1]), F.col("latitude"), F.col("longitude")
    )
    return silver_layer(spark, sf_dir).select(*KEY, scoring.tidy(distance, 2).alias("distance_km"))


@_register
def q_geo_jitter(spark, sf_dir):
    """P16, fixed per listing."""
    lat, lon = geo.jitter(
        F.col("latitude"), F.col("longitude"), F.concat_ws("@", *KEY), radius_m=250
    )
    mappable = radius.mappable(silver_layer(spark, sf_dir))
    return mappable.select(*KEY, F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


# --- Filters and duplicates -------------------------------------------------


@_register
def q_valid_rows(spark, sf_dir):
    """all copies with a price and an area."""
    valid = cleaning.keep_valid(cleaning.parse_values(bronze_layer(spark, sf_dir)))
    return valid.select(*KEY, "scraped_at", "price_eur", "area_sqm", "rooms")


@_register
def q_silver(spark, sf_dir):
    """Silver in one plan: parse, filter, normalise, remove copies."""
    return cleaning.silver(bronze_layer(spark, sf_dir))


@_register
def q_dedup_latest(spark, sf_dir):
    """D1 on the raw records."""
    return cleaning.latest_copy(bronze_layer(spark, sf_dir)).select(
        *KEY, "scraped_at", "raw_price", "raw_area", "raw_rooms", "source"
    )


@_register
def q_dedup_stats(spark, sf_dir):
    """Rows before, remaining and removed."""
    return cleaning.copy_counts(cleaning.clean(bronze_layer(spark, sf_dir)))


@_register
def q_mappable(spark, sf_dir):
    """F5."""
    return radius.mappable(gold_layer(spark, sf_dir)).select(*KEY, "latitude", "longitude")


# --- Indexes and ranks ------------------------------------------------------


@_register
def q_index_a(spark, sf_dir):
    """Index A and rank."""
    return _steady(indexes.index_a(silver_layer(spark, sf_dir)), AVERAGE)


@_register
def q_index_a_ranked_after(spark, sf_dir):
    """Index A with ranks of the published rows alone."""
    ranked = indexes.index_a(silver_layer(spark, sf_dir), rank_after_filter=True)
    return ranked.select(*KEY, "opportunity_index", "rank")


@_register
def q_deal_rank(spark, sf_dir):
    """Rank of every listing of a day, single ones included."""
    scored = indexes.score(silver_layer(spark, sf_dir))
    return indexes.with_deal_rank(scored).select(*KEY, "listing_count", "opportunity_index", "rank")


@_register
def q_index_b(spark, sf_dir):
    """Index B."""
    scored = indexes.index_b(silver_layer(spark, sf_dir))
    return _steady(scored, "avg_neighborhood_price").select(
        "source", "url", "title", "price_eur", "area_sqm", "area_m2", "price_per_sqm",
        "neighborhood", "scrape_date", "opportunity_index",
        "avg_neighborhood_price",
    )


@_register
def q_index_c(spark, sf_dir):
    """Percent below the district's reference price."""
    scored = indexes.index_c(
        silver_layer(spark, sf_dir), listings.gazetteer_districts(spark, sf_dir)
    )
    return scored.select(*KEY, "district", "reference_price_sqm", "opportunity_index")


# --- Lookups and geography --------------------------------------------------


@_register
def q_gazetteer_lookup(spark, sf_dir):
    """Places named by listings, as barrio, as district and unknown."""
    silver = silver_layer(spark, sf_dir)
    names = extraction.union_records(*[
        silver.groupBy(F.col(c).alias("name")).agg(F.count(F.lit(1)).alias("listings"))
        for c in ("neighborhood", "district", "source")
    ])
    located = lookups.locate(names, _places(spark, sf_dir), "name", ["name"])
    return located.withColumns(
        {c: F.round(c, 6) for c in ("place_lat", "place_lon")}
    )


@_register
def q_district_center(spark, sf_dir):
    """J3, per listing; a name in other case has no centre."""
    named = silver_layer(spark, sf_dir).select(
        *KEY, F.when(F.col("rooms") == 3, F.upper("district")).otherwise(F.col("district"))
        .alias("district"),
    )
    centers = lookups.district_center(named, listings.gazetteer_districts(spark, sf_dir), KEY)
    return centers.withColumns({c: F.round(c, 6) for c in ("center_lat", "center_lon")})


@_register
def q_price_band(spark, sf_dir):
    """Price per m² against the barrio's range."""
    return lookups.price_band(silver_layer(spark, sf_dir), _places(spark, sf_dir)).select(
        *KEY, "price_min", "price_max", "price_band"
    )


@_register
def q_radius(spark, sf_dir):
    """The best 50 listings within 2 km."""
    near = serving.nearby_deals(place_layer(spark, sf_dir), *CENTER, radius_km=2.0, n=50)
    return _steady(near, AVERAGE)


@_register
def q_radius_all(spark, sf_dir):
    """every listing within 2 km, without a limit."""
    near = radius.within_radius(place_layer(spark, sf_dir), *CENTER, radius_km=2.0)
    return near.select(*KEY, scoring.tidy(F.col("distance_km"), 2).alias("distance_km"))


@_register
def q_radius_join(spark, sf_dir):
    """Listings within 1 km of every district centre."""
    centers = listings.gazetteer_districts(spark, sf_dir).select(
        F.col("district").alias("center"), F.col("lat").alias("center_lat"),
        F.col("lon").alias("center_lon"),
    )
    pairs = radius.radius_join(silver_layer(spark, sf_dir), centers, radius_km=1.0)
    return pairs.select("center", *KEY, scoring.tidy(F.col("distance_km"), 2).alias("distance_km"))


# --- Serving ----------------------------------------------------------------


@_register
def q_top_deals(spark, sf_dir):
    """The ten best deals of the newest snapshot."""
    return _steady(serving.top_deals(gold_layer(spark, sf_dir), n=10), AVERAGE)


@_register
def q_top_deals_on_date(spark, sf_dir):
    """O1 for a given date."""
    deals = serving.top_deals(gold_layer(spark, sf_dir), n=100, scrape_date="1998-03")
    return _steady(deals, AVERAGE)


@_register
def q_search_deals(spark, sf_dir):
    """filters before the limit."""
    found = serving.search_deals(
        gold_layer(spark, sf_dir), n=50, max_price=60000.0, min_area=10.0, min_rooms=2
    )
    return _steady(found, AVERAGE)


@_register
def q_search_district(spark, sf_dir):
    """F4 in one district, rooms not asked for."""
    found = serving.search_deals(
        gold_layer(spark, sf_dir), n=20, max_price=60000.0, min_area=5.0, district="Nation_4"
    )
    return _steady(found, AVERAGE)


@_register
def q_latest_snapshot(spark, sf_dir):
    """Rows of the newest date, which the catalog's partitions tell."""
    path = fresh_path(spark, "silver-served")
    snapshots.write_version(silver_layer(spark, sf_dir), path, order=("scrape_date", "url"))
    version = snapshots.publish_version(spark, path, "silver_served", schema=SILVER)
    table = snapshots.table_of("silver_served", version)
    return snapshots.latest_snapshot(spark, table).select(*KEY, "price_eur", "area_sqm")


@_register
def q_latest_snapshot_of_rows(spark, sf_dir):
    """J4 for rows that no catalog knows: a scalar subquery."""
    return serving.snapshot(silver_layer(spark, sf_dir)).select(*KEY, "price_eur", "area_sqm")


@_register
def q_neighborhood_avg(spark, sf_dir):
    """A1."""
    averages = indexes.neighborhood_average_price(silver_layer(spark, sf_dir))
    return _steady(averages, "avg_neighborhood_price")


@_register
def q_neighborhood_stats(spark, sf_dir):
    """A2."""
    return _steady(serving.neighborhood_stats(gold_layer(spark, sf_dir)), "avg_price_per_sqm")


@_register
def q_kpis(spark, sf_dir):
    """A3, over the newest snapshot's deals."""
    totals = serving.kpis(serving.positive_deals(gold_layer(spark, sf_dir)))
    return _steady(totals, "avg_price_eur", "avg_price_per_sqm")


@_register
def q_top_neighborhoods(spark, sf_dir):
    """A4."""
    return _steady(serving.top_neighborhoods(gold_layer(spark, sf_dir)), "avg_price_per_sqm")


@_register
def q_dataset_summary(spark, sf_dir):
    """A5, over index C."""
    summary = serving.dataset_summary(indexes.index_c(
        silver_layer(spark, sf_dir), listings.gazetteer_districts(spark, sf_dir)
    ))
    return _steady(summary, "avg_price_per_sqm")


@_register
def q_districts(spark, sf_dir):
    """A6, U2."""
    return serving.districts(gold_layer(spark, sf_dir))


@_register
def q_deals_envelope(spark, sf_dir):
    """The combined query without a point; the list as text."""
    envelope = serving.deals(gold_layer(spark, sf_dir), n=10)
    index = F.transform("deals", lambda d: F.concat_ws(
        "=", d["url"], F.round(d["opportunity_index"] * 1_000_000).cast("long").cast("string")
    ))
    return envelope.withColumn("deals", F.array_join(index, ";"))


@_register
def q_require_rows(spark, sf_dir):
    """A table that must not be empty."""
    part = listings.table(spark, sf_dir, "part")
    return readers.require_rows(part, "part").select("p_partkey", "p_name")


@_register
def q_save_records(spark, sf_dir):
    """K7: records of a small table, saved and read by name."""
    nation = listings.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    writers.save_rows(nation, "saved_nations")
    return spark.table("saved_nations")


@_register
def q_gold_replaced(spark, sf_dir):
    """K4: a full rebuild that has lost a day leaves nothing of that day."""
    path, gold = fresh_path(spark, "gold-replaced"), gold_layer(spark, sf_dir)
    writers.write_gold(gold, path, laid_out=True)
    writers.write_gold(gold.filter("scrape_date <> '1998-03'"), path, replace_all=True, laid_out=True)
    return readers.read_gold(spark, path).groupBy("scrape_date").agg(F.count("*").alias("n"))


@_register
def q_all_places(spark, sf_dir):
    """All barrios and all districts of the gazetteer."""
    barrios = lookups.all_barrios(listings.gazetteer_barrios(spark, sf_dir))
    districts = lookups.all_districts(listings.gazetteer_districts(spark, sf_dir))
    return barrios.withColumnRenamed("barrio", "place").unionAll(
        districts.select("district", F.lit(None).cast("string"))
    )


# --- Extraction -------------------------------------------------------------


#: A source whose cards are menu entries.
WEB = extraction.Portal(
    source="web",
    host="https://listings.example",
    cards=(Element("article", "listing"), Element("li")),
    link=(Element("a", "main"), Element("a")),
    title=(Element("h2"), Element("a")),
    next_page=(Element("a", "/the", "href"), Element("a")),
)


#: A source with one card for each menu; its values are the places of the menu's entries.
MENU = extraction.Portal(
    source="menu",
    host="https://menus.example",
    cards=(Element("ul", "results"), Element("ul")),
    link=(Element("a", "first"), Element("a")),
    title=(Element("li", child=1),),
    price=(Element("li", child=2),),
    area=(Element("span", child=1), Element("a", child=1)),
    rooms=(Element("p"),),
    location=(Element("nav"), Element("a")),
    next_page=(Element("a", "next"), Element("a")),
)
#: A source whose one card is the page.
BODY = extraction.Portal(
    source="body",
    host="https://articles.example",
    cards=(Element("section"), Element("body")),
    link=(Element("a"),),
    title=(Element("h3"), Element("h1")),
    price=(Element("li", child=2),),
    next_page=(Element("a", "/the", "href"),),
)
SITES = [WEB, MENU, BODY]


def _site_pages(spark, sf_dir) -> DataFrame:
    """The stored web pages, as pages of the source ``web``."""
    return listings.table(spark, sf_dir, "pages").withColumn("source", F.lit("Web "))


def _pages_by_host(spark, sf_dir) -> DataFrame:
    """The stored web pages, each of the source that its host's domain stands for."""
    domain = F.regexp_extract("url", r"^https?://[^/]*\.([a-z]+)(?:[/:]|$)", 1)
    return listings.table(spark, sf_dir, "pages").withColumn(
        "source", F.when(domain == "com", "Web ").when(domain == "net", " MENU").otherwise("Body")
    )


@_register
def q_extract_cards(spark, sf_dir):
    """E1, F8 on the stored web pages."""
    return extraction.extract_cards(_site_pages(spark, sf_dir), [WEB]).select(
        "page_id", "position", "source", "url", "title", "raw_price", "raw_rooms",
        "neighborhood", "district",
    )


@_register
def q_extract_listings(spark, sf_dir):
    """E1, E2, F8 on the stored pages of three sources with their own markup."""
    return extraction.extract_cards(_pages_by_host(spark, sf_dir), SITES).select(
        "page_id", "position", "source", "url", "title", "raw_price", "raw_area", "raw_rooms",
        "neighborhood", "district",
    )


@_register
def q_extract_fallback(spark, sf_dir):
    """Links to one address where a page has any, else its headline."""
    pages = listings.table(spark, sf_dir, "pages")
    found = extraction.cards(F.col("html"), (Element("a", "/and", "href"), Element("h1")))
    return pages.select(
        "page_id", F.size(found).alias("cards"),
        markup.text_content(F.get(found, F.lit(0))).alias("first_card"),
    )


@_register
def q_next_page(spark, sf_dir):
    """E3 on the stored web pages."""
    pages = _site_pages(spark, sf_dir)
    return extraction.next_page(pages, [WEB]).select("page_id", "next_url")


@_register
def q_next_listing_page(spark, sf_dir):
    """E3 on the stored pages of three sources."""
    return extraction.next_page(_pages_by_host(spark, sf_dir), SITES).select(
        "page_id", "source", "next_url"
    )


@_register
def q_blocked_pages(spark, sf_dir):
    """E4 with signs, texts and title words that occur in the stored pages."""
    flagged = extraction.detect_blocking(
        listings.table(spark, sf_dir, "pages"),
        captcha_signs=(("div[class*='sponsor']", r"<div\b[^>]*\bclass=[\"'][^\"'>]*sponsor"),
                       ("html[lang='de']", r"<html\b[^>]*\blang=[\"']de[\"']")),
        texts=("Ofthe", "tionthat", "acceso"),
        titles=("403", "The"),
    )
    return flagged.select("page_id", "blocked", "reason")


#: Markup that carries one sign of the standard lists each, or two, of which the first counts.
_SIGNS = (
    '<iframe src="/x/captcha/1"></iframe>', "<iframe data-x='a>b' src=//h/recaptcha></iframe>",
    '<div class="my-captcha box"></div>', '<div id="captcha-9"></div>',
    '<p id="challenge-running"></p>', "<form id=challenge-form></form>",
    '<span class="a cf-turnstile b"></span>', "<p>ACCESS <b>DENIED</b></p>", "<p>Acceso&#32;denegado</p>",
    "<p>has sido bloqueado</p>", "<p>You have been blocked</p>", "<p>Too many requests</p>",
    "<p>Demasiadas solicitudes</p>", "<p>Error 403</p>", "<p>error 429</p>", "<p>Rate limit</p>",
    "<p>Please verify you are a human</p>", "<p>Verifica que eres humano</p>",
    "<p>Rate limit</p><p>error 403</p>", '<p>rate limit</p><form id="challenge-form">',
    "<!-- <div class='captcha'> access denied --><script>\"<div class='captcha'>\"</script>",
)


def _marked_pages(spark, sf_dir) -> DataFrame:
    """The stored pages; most of them get a sign, and some a title, by their number."""
    pages, n = listings.table(spark, sf_dir, "pages"), len(_SIGNS)
    kind = (F.col("page_id") % (n + 3)).cast("int")
    sign = F.coalesce(F.get(F.array(*map(F.lit, _SIGNS)), kind), F.lit(""))
    html = F.replace(F.col("html"), F.lit("<article>"), F.concat(F.lit("<article>"), sign))
    return pages.withColumn("html", F.when(
        kind == n, F.replace(html, F.lit("<title>"), F.lit("<title> 403 "))
    ).when(kind == n + 1, F.replace(html, F.lit("<title>"), F.lit("<title>Blocked: "))).otherwise(html))


@_register
def q_blocked_defaults(spark, sf_dir):
    """E4 with the standard lists, on the stored pages with a sign in most of them."""
    flagged = extraction.detect_blocking(_marked_pages(spark, sf_dir))
    return flagged.select("page_id", "blocked", "reason")


@_register
def q_block_reasons(spark, sf_dir):
    """E4 with the standard lists: how many of the stored pages, as they are, have a notice."""
    flagged = extraction.detect_blocking(listings.table(spark, sf_dir, "pages"))
    return flagged.groupBy("blocked", "reason").agg(F.count(F.lit(1)).alias("n"))


@_register
def q_source_dispatch(spark, sf_dir):
    """Records per source, of pages that come in two batches."""
    pages = _pages_by_host(spark, sf_dir)
    mixed = extraction.union_records(
        pages.filter("page_id % 2 = 0").drop("url"), pages.filter("page_id % 2 = 1")
    )
    records = extraction.extract_cards(mixed, SITES)
    return records.groupBy("source").agg(
        F.count(F.lit(1)).alias("records"), F.count("raw_rooms").alias("with_rooms")
    )


@_register
def q_unknown_sources(spark, sf_dir):
    """E5: pages of a source without a portal are reported, with the known names."""
    unknown = extraction.unknown_sources(_pages_by_host(spark, sf_dir), [WEB, MENU])
    return unknown.groupBy("source", "available").agg(F.count("*").alias("pages"))


@_register
def q_readable_pages(spark, sf_dir):
    """E4 as a filter: pages without a notice, here by words of the title."""
    pages = listings.table(spark, sf_dir, "pages")
    return extraction.readable(pages, captcha_signs=(), texts=(), titles=("403", "The")).select("page_id")


@_register
def q_union_sources(spark, sf_dir):
    """Batches of both portals, one of them without coordinates."""
    raw = bronze_layer(spark, sf_dir)
    first = raw.filter(F.col("source") == "portal_a").drop("latitude", "longitude")
    second = raw.filter(F.col("source") == "portal_b")
    return extraction.union_records(first, second).select(
        "source", *KEY, "raw_price", "scraped_at", "latitude", "longitude"
    )


# --- Sampling ---------------------------------------------------------------


@_register
def q_exact_sample(spark, sf_dir):
    """Exactly 5 % of the orders, rounded half to even."""
    orders = listings.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.tag_exact_sample(orders, "o_orderkey", 0.05).filter("is_sampled")
