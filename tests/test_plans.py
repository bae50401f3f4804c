"""Lookup joins under skew, and the shape of the plans."""

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tasador import layers
from tasador.functions.geo import place_key
from tasador.layers import bronze_layer, gold_layer, place_files, place_layer, silver_layer
from tasador.operators import cleaning, indexes, lookups, radius, serving
from tasador.plans.joins import Limits, grid_join, lookup_join
from tasador.plans.workspace import LEAN, materialize, measured_bytes, shared_dir
from tasador.sources import listings, readers, writers

SPREAD = Limits(broadcast_bytes=0, hot_rows=40)
SHUFFLED = Limits(broadcast_bytes=0)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def skewed(spark):
    """1,200 rows of which a third have one key; one key is null."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (n % 37).cast("string"))
    )
    return materialize(spark.range(1200).select("id", key.alias("k")), "skewed")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limits", [SHUFFLED, SPREAD])
def test_lookup_join_forms_agree(spark, skewed, how, limits):
    lookup = spark.createDataFrame(
        [("hot", 1), ("hot", 2), (None, 3), ("k5", 4), ("unused", 5)], "k string, v int"
    )
    expected = bag(lookup_join(skewed, lookup, ["k"], ["id"], how))
    assert bag(lookup_join(skewed, lookup, ["k"], ["id"], how, limits)) == expected
    assert sum(1 for row in expected.elements() if row[1] == "hot") == 800


@pytest.mark.parametrize("limits", [
    Limits(), Limits(hot_pairs=200), Limits(hot_pairs=50, hot_rows=30), Limits(hot_pairs=10**9, hot_rows=60),
    Limits(hot_pairs=200, broadcast_bytes=0)])
def test_grid_join_equals_a_join(spark, skewed, limits):
    """Hot on both sides, on one side, null keys, and keys of one side alone."""
    right = materialize(spark.range(300).select(F.col("id").alias("v"), F.when(
        F.col("id") % 2 == 0, "hot").when(F.col("id") % 31 == 1, None).when(F.col("id") == 7, "alone")
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 37).cast("string"))).alias("k")), "other")
    joined = grid_join(skewed, right, ["k"], ["id"], ["v"], limits)
    plain = skewed.alias("l").join(right.alias("r"), F.col("l.k").eqNullSafe(F.col("r.k"))).select("id", "l.k", "v")
    assert bag(joined.select("id", "k", "v")) == bag(plain) and joined.columns == ["id", "k", "v"]


def test_many_centres_in_one_cell(spark):
    """10,000 centres and as many listings in a cell: all pairs, from many tasks."""
    lon = F.lit(-3.7038) + F.col("id") % 100 * F.lit(0.0001)
    lat = F.lit(40.4168) + F.floor(F.col("id") / 100) * F.lit(0.0001)
    places = spark.range(10_000).select("id", lat.alias("lat"), lon.alias("lon"))
    listings_ = materialize(places.select(
        F.col("id").cast("string").alias("url"), F.lit("d").alias("scrape_date"),
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude")), "near-listings")
    centers = materialize(places.select(
        F.col("id").alias("center"), F.col("lat").alias("center_lat"), F.col("lon").alias("center_lon")), "near-centers")
    limits = Limits(broadcast_bytes=0, hot_pairs=2_000_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = radius.radius_join(listings_, centers, 0.1, limits)
        tasks = pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    import numpy as np

    y, x = np.radians(40.4168 + np.arange(10_000) // 100 * 1e-4), np.radians(-3.7038 + np.arange(10_000) % 100 * 1e-4)
    found = 0
    for k in range(0, 10_000, 500):
        a, b = slice(k, k + 500), slice(None)
        cosine = np.cos(y[a, None]) * np.cos(y[None, b]) * np.cos(x[a, None] - x[None, b]) + np.sin(y[a, None]) * np.sin(y[None, b])
        found += int((6371 * np.arccos(np.clip(cosine, -1, 1)) <= 0.1).sum())
    total = sum(r["count"] for r in tasks)
    assert abs(total - found) <= 1e-4 * found and found > 500_000
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 0.4 * total


def test_place_layout_skips_row_groups(spark, sf_dir):
    """A search around a point reads a small part of the rows, and finds them all."""
    near = radius.within_radius(place_layer(spark, sf_dir), 40.4168, -3.7038, 1.0)
    gold = gold_layer(spark, sf_dir)
    assert bag(near) == bag(radius.within_radius(gold, 40.4168, -3.7038, 1.0)) != {}

    nodes = []
    near = radius.within_radius(place_layer(spark, sf_dir), 40.4168, -3.7038, 1.0)
    frame = near._jdf.queryExecution().executedPlan()
    near_df = frame.execute().count()
    stack = [frame]
    while stack:
        node = stack.pop()
        if "FileSourceScan" in node.getClass().getName():
            nodes.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    mappable = radius.mappable(gold).count()
    assert nodes and near_df > 0 and sum(nodes) < 0.35 * mappable


def test_place_key_interleaves_bits(spark):
    rows = [(a, b) for a in (-90.0, -45.0, 0.0, 40.4, 90.0) for b in (-180.0, -3.7, 0.0, 179.999, 180.0)] + [(None, 1.0)]
    keys = spark.createDataFrame(rows, "a double, b double").select("a", "b", place_key(F.col("a"), F.col("b")).alias("k"))
    for r in keys.collect():
        if r.a is None:
            assert r.k is None
            continue
        lat, lon = (max(0, min(65535, int(v * 65536))) for v in ((r.a + 90) / 180, (r.b + 180) / 360))
        assert r.k == sum((lat >> i & 1) << (2 * i + 1) | (lon >> i & 1) << (2 * i) for i in range(16))


def test_place_layout_grows_with_the_rows(spark):
    """Ranges of bounded size, and a key that holds each coordinate once."""
    assert [place_files(n) for n in (0, 43_000, 8_000_000, 157_000_000)] == [16, 16, 16, 314]
    key = spark.range(1).select(place_key(F.col("id").cast("double"), F.lit(1.5)).alias("k"))
    assert plan(key, "simple").split("== Physical Plan ==")[1].count("FLOOR") <= 1


def test_hot_key_is_spread_over_tasks(spark, skewed):
    lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(skewed, lookup, ["k"], ["id"], "inner", SPREAD)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 400
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 250


def test_measured_bytes_grows_with_text(spark):
    short = spark.createDataFrame([("a",)] * 10, "t string")
    long = spark.createDataFrame([("a" * 1000,)] * 10, "t string")
    assert measured_bytes(long) - measured_bytes(short) == 9990


def test_materialized_tables_use_the_named_folder(spark, skewed):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_dir(spark) in f for f in skewed.inputFiles())


@pytest.mark.parametrize("limits", [SHUFFLED, SPREAD])
def test_index_forms_agree(spark, sf_dir, limits):
    silver = silver_layer(spark, sf_dir)
    assert bag(indexes.index_a(silver, limits=limits).select("url", "scrape_date", "rank", "opportunity_index")) \
        == bag(gold_layer(spark, sf_dir).select("url", "scrape_date", "rank", "opportunity_index"))


def test_other_joins_agree_when_spread(spark, sf_dir):
    silver = silver_layer(spark, sf_dir)
    districts = listings.gazetteer_districts(spark, sf_dir)
    places = lookups.place_names(districts, listings.gazetteer_barrios(spark, sf_dir))
    for run in (
        lambda l: indexes.index_b(silver, limits=l).select("url", "opportunity_index"),
        lambda l: indexes.index_c(silver, districts, limits=l).select("url", "opportunity_index"),
        lambda l: lookups.price_band(silver, places, l).select("url", "scrape_date", "price_band"),
    ):
        assert bag(run(SPREAD)) == bag(run(Limits()))


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_results_do_not_depend_on_partitions(spark, sf_dir, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        raw = listings.raw_listings(spark, sf_dir).repartition(partitions)
        silver = materialize(cleaning.silver(raw), "silver-again")
        gold = indexes.index_a(silver)
        assert bag(silver) == bag(silver_layer(spark, sf_dir))
        assert bag(gold.select("url", "scrape_date", "rank")) == bag(
            gold_layer(spark, sf_dir).select("url", "scrape_date", "rank")
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_index_invariants(spark, sf_dir):
    gold = gold_layer(spark, sf_dir)
    limits = gold.agg(F.min("opportunity_index"), F.max("opportunity_index"), F.min("rank")).first()
    assert limits[0] >= -1 and limits[1] <= 1 and limits[2] == 1
    again = cleaning.latest_copy(silver_layer(spark, sf_dir))
    assert bag(again) == bag(silver_layer(spark, sf_dir))


def test_unlimited_groups_average_to_zero(spark, sf_dir):
    scored = indexes.score(silver_layer(spark, sf_dir))
    off = scored.groupBy("neighborhood", "scrape_date").agg(
        F.avg(F.lit(1) - F.col("opportunity_index")).alias("mean"),
        F.min("opportunity_index").alias("least"),
    ).filter((F.col("least") > -1) & (F.abs(F.col("mean") - 1) > 1e-6))
    assert off.isEmpty()


def test_top_deals_are_a_prefix(spark, sf_dir):
    gold = gold_layer(spark, sf_dir)
    ten = [r.url for r in serving.top_deals(gold, 10).collect()]
    assert ten == [r.url for r in serving.top_deals(gold, 50).collect()][:10]


def test_radius_results_grow(spark, sf_dir):
    gold = gold_layer(spark, sf_dir)
    counts = [radius.within_radius(gold, 40.4168, -3.7038, r).count() for r in (0.5, 1.0, 2.0, 5.0)]
    assert counts == sorted(counts) and counts[0] > 0


def test_top_deals_plan(spark, sf_dir):
    text = plan(serving.top_deals(gold_layer(spark, sf_dir)))
    assert "TakeOrderedAndProject" in text
    assert "PartitionFilters: [isnotnull(scrape_date" in text and "Subquery" in text
    assert "GreaterThan(opportunity_index,0.0)" in text


def test_radius_plan_pushes_the_box(spark, sf_dir):
    text = plan(radius.within_radius(gold_layer(spark, sf_dir), 40.4168, -3.7038, 2.0))
    assert "GreaterThanOrEqual(latitude" in text and "LessThanOrEqual(longitude" in text


def test_statistics_read_only_their_columns(spark, sf_dir):
    text = plan(indexes.group_averages(silver_layer(spark, sf_dir)))
    assert "ReadSchema: struct<price_per_sqm:double,neighborhood:string>" in text
    assert "partial_avg" in text


def test_deduplication_combines_before_its_shuffle(spark, sf_dir):
    text = plan(contract.queries()["q_silver"](spark, sf_dir), "simple")
    assert text.count("Exchange hashpartitioning(url") == 1
    assert "partial_max" in text and "Window" not in text


def test_deduplication_sorts_after_its_shuffle(spark, sf_dir):
    """A task sorts its share of the shuffle, never a whole split of a stored layer."""
    text = plan(contract.queries()["q_dedup_latest"](spark, sf_dir), "simple")
    above, below = text.split("Exchange hashpartitioning(url")
    assert "Sort" in above and "Sort" not in below


def test_hot_copies_are_combined_before_their_shuffle(spark):
    """A third of all rows are copies of one listing: one row per task of them is shuffled."""
    n = F.col("id")
    rows = materialize(spark.range(90_000).select(
        F.when(n % 3 == 0, "hot").otherwise((n % 20_000).cast("string")).alias("url"),
        F.lit("d").alias("scrape_date"), (n * 7919 % 90_000).alias("scraped_at"), n.alias("v")), "copies")
    plain = bag(cleaning.latest_copy(rows))
    found = cleaning.latest_copy(rows, hot_rows=10_000)
    text = plan(found, "simple")
    assert "Union" in text and text.count("REPARTITION_BY_COL") == 1
    assert bag(found) == plain and len(plain) == 20_001


def test_silver_is_laid_out_by_the_shuffle_that_removes_copies(spark, sf_dir):
    """One shuffle, whose order serves the aggregate and the files by date."""
    rows = cleaning.clean(bronze_layer(spark, sf_dir))
    found = cleaning.latest_copy(rows, lay_out_by="scrape_date", part_rows=300)
    text = plan(found, "simple")
    assert text.count("Exchange hashpartitioning(") == 1 and text.count("+- Sort [") == 1
    assert bag(found) == bag(cleaning.latest_copy(rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = found.select("scrape_date", F.spark_partition_id().alias("task")).distinct()
        assert max(Counter(r["scrape_date"] for r in places.collect()).values()) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "rebalance" not in plan(bronze_layer(spark, sf_dir), "simple").lower()
    assert not any("scrape_date=" in f for f in bronze_layer(spark, sf_dir).inputFiles())


@pytest.mark.parametrize("name", [q for q in sorted(contract.queries()) if q.startswith("q_")])
def test_no_query_leaves_the_engine(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir), "simple")
    for operator in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin", "ExistingRDD"):
        assert operator not in text


@pytest.mark.parametrize("part_rows", [3, 20, 100_000])
@pytest.mark.parametrize("limits", [Limits(), SPREAD])
def test_ranks_of_one_shuffle_equal_counting(spark, part_rows, limits):
    """A value with very many rows, a range with many values, missing indexes, a small day."""
    rows = [(f"a{i}", "1996-01", -1.0) for i in range(90)]
    rows += [(f"b{i}", "1996-01", (100_000 + i % 30) / 1e6) for i in range(100)]
    rows += [(f"c{i}", "1996-01", (i * 37_911 % 2_000_001 - 1_000_000) / 1e6) for i in range(80)]
    rows += [(f"d{i}", "1996-01", None) for i in range(25)] + [("e", "1996-02", 1.0), ("f", "1996-02", 0.0)]
    scored = materialize(spark.createDataFrame(rows, "url string, scrape_date string, opportunity_index double"), "scored")
    found = {r["url"]: r["rank"] for r in indexes.laid_out_by_rank(scored, part_rows, limits).collect()}
    low = -2.0
    assert found == {
        url: 1 + sum(d == day and (low if x is None else x) > (low if v is None else v) for _, d, x in rows)
        for url, day, v in rows
    }
    assert len(found) == len(rows)


def test_gold_is_ranked_and_written_without_a_shuffle_of_its_rows(spark, sf_dir, tmp_path):
    silver = silver_layer(spark, sf_dir)
    laid = indexes.index_a(silver, lay_out=True)
    # The ranks are one stored table, the averages another; both are broadcast.
    assert plan(laid, "simple").count("Exchange hashpartitioning(") == 0
    columns = ["url", "scrape_date", "rank", "opportunity_index"]
    expected = bag(indexes.index_a(silver).select(*columns))
    assert bag(laid.select(*columns)) == bag(gold_layer(spark, sf_dir).select(*columns)) == expected
    # Where they are too large, one shuffle by day and part ranks the rows.
    ranked = indexes.index_a(silver, lay_out=True, limits=Limits(broadcast_bytes=0, hot_rows=10**9))
    assert bag(ranked.select(*columns)) == expected
    path = str(tmp_path / "gold")
    assert writers.write_gold(laid, path, laid_out=True) == sum(expected.values())
    back = readers.read_gold(spark, path)
    assert bag(back.select(*columns)) == expected
    files = back.select(F.input_file_name().alias("file"), "scrape_date").distinct().count()
    assert files <= 2 * silver.select(F.input_file_name()).distinct().count()


def test_a_layer_leaves_no_shuffle_files(spark, tmp_path):
    def shuffle_files():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = {files.apply(i).getName() for i in range(files.size())}
        return {name for name in names if name.startswith("shuffle_")}

    before, settings = shuffle_files(), [spark.conf.get(name, None) for name in LEAN]
    layers._layer(spark, str(tmp_path), "numbers", lambda: spark.range(1000).repartition(3, "id"), ())
    assert [spark.conf.get(name, None) for name in LEAN] == settings
    for _ in range(50):  # the files go in the background
        if not shuffle_files() - before:
            break
        time.sleep(0.1)
    assert not shuffle_files() - before
