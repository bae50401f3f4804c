"""Tables that are refreshed run by run against a rebuild of everything."""

from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tasador.operators import cleaning, indexes
from tasador.plans.joins import Limits
from tasador.plans.workspace import materialize
from tasador.schemas import SILVER
from tasador.streaming import refresh
from tasador.streaming.refresh import ConcurrentRun, ListingStore
from test_plans import bag, plan

DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


def listing(url, day, price, at, place="Sol"):
    return ("p", url, "t", float(price), 10.0, 2, price / 10.0, place, "Centro", None, None, at, day)


def frame(spark, rows):
    return spark.createDataFrame(rows, SILVER.simpleString().replace("timestamp_ntz", "string")).withColumn(
        "scraped_at", F.col("scraped_at").cast("timestamp_ntz")).select(*SILVER.fieldNames())


def runs():
    """New listings, better and worse copies, a moved one, equal copies, one day alone."""
    first = [listing(f"u{i}", DAYS[i % 2], 100 + 7 * i, "2024-01-01 10:00:00", f"n{i % 5}") for i in range(60)]
    second = [listing(f"u{i}", DAYS[i % 2], 90 + 5 * i, "2024-01-01 11:00:00", f"n{i % 5}") for i in range(0, 60, 9)]
    second += [listing("u4", DAYS[0], 5, "2024-01-01 09:00:00"), listing("u6", DAYS[0], 77, "2024-01-02 09:00:00", "n9"),
               first[8], listing("new", DAYS[0], 300, "2024-01-01 10:00:00", "n9")]
    third = [listing(f"v{i}", DAYS[2], 100 + i % 3, "2024-01-03 10:00:00") for i in range(30)]
    third += [listing("only", DAYS[2], 10, "2024-01-03 10:00:00", "alone")]
    return [first, second, third]


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_bytes=0, hot_rows=5)])
def test_runs_equal_a_rebuild(spark, tmp_path, limits):
    store = ListingStore(spark, str(tmp_path / "store"), limits=limits)
    taken = []
    for i, rows in enumerate(runs()):
        taken.append(rows)
        store.refresh(frame(spark, rows), f"run-{i}")
        full = materialize(cleaning.latest_copy(frame(spark, sum(taken, []))), "full")
        assert bag(store.table("silver")) == bag(full)
        assert bag(store.table("gold").drop("neighborhood_avg_price_per_sqm")) == bag(
            indexes.index_a(full).drop("neighborhood_avg_price_per_sqm"))
        counts = indexes.rank_offsets(indexes.score(full)).drop("rank")
        assert bag(store.table("values").select("scrape_date", "opportunity_index", "listings")) == bag(counts)
    assert store.runs() == 3


def test_counts_and_repeated_runs(spark, tmp_path):
    store = ListingStore(spark, str(tmp_path / "store"))
    first, second, _ = [frame(spark, rows) for rows in runs()]
    assert store.refresh(first, "a") == {
        "added": 60, "replaced": 0, "unchanged": 0, "buckets_read": 0, "dates": 2}
    whole = store.refresh(second, "b")
    assert (whole["added"], whole["replaced"], whole["unchanged"]) == (1, 8, 2)
    before = bag(store.table("gold"))
    assert store.refresh(second, "b") == whole and store.runs() == 2
    again = store.refresh(second, "c")
    assert (again["added"], again["replaced"]) == (0, 0)
    assert bag(store.table("gold")) == before
    assert store.refresh(first.limit(0), "empty")["dates"] == 0


def test_only_buckets_with_the_keys_are_read(spark, tmp_path, monkeypatch):
    store = ListingStore(spark, str(tmp_path / "store"), buckets=16)
    first, _, third = runs()
    store.refresh(frame(spark, first), "a")
    parts = store._manifest()["tables"]["silver"]
    read = []
    whole = ListingStore._read

    def watched(self, tables, name, dates=None, parts=None):
        table = whole(self, tables, name, dates, parts)
        if name == "silver" and parts is not None:
            read.append(sorted(table.inputFiles()))
        return table

    monkeypatch.setattr(ListingStore, "_read", watched)
    taken = store.refresh(frame(spark, [listing("u8", DAYS[0], 1, "2024-02-01 10:00:00")]), "one")
    assert taken["buckets_read"] == 1 and taken["replaced"] == 1
    (files,) = read
    (place,) = {f.split("run=")[1].split("/", 1)[1].rsplit("/", 1)[0] for f in files}
    assert place.startswith(f"scrape_date={DAYS[0]}/bucket=") and len(parts) > 20
    # All other folders are as they were, and a new day reads nothing.
    after = store._manifest()["tables"]["silver"]
    assert {p for p in parts if parts[p] != after[p]} == {place}
    gold = store._manifest()["tables"]["gold"]
    assert store.refresh(frame(spark, third), "new-day")["buckets_read"] == 0 and read[1] == []
    assert gold[f"scrape_date={DAYS[1]}"] == store._manifest()["tables"]["gold"][f"scrape_date={DAYS[1]}"]


def test_a_failed_run_leaves_nothing(spark, tmp_path, monkeypatch):
    store = ListingStore(spark, str(tmp_path / "store"))
    first, second, _ = [frame(spark, rows) for rows in runs()]
    store.refresh(first, "a")
    before = bag(store.table("silver")), bag(store.table("gold"))
    whole = ListingStore._index
    monkeypatch.setattr(ListingStore, "_index", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.refresh(second, "b")
    assert (bag(store.table("silver")), bag(store.table("gold"))) == before and store.runs() == 1
    monkeypatch.setattr(ListingStore, "_index", whole)

    def overtaken(self, *args):
        monkeypatch.setattr(ListingStore, "_index", whole)
        store.refresh(first.limit(0), "other")
        return whole(self, *args)

    monkeypatch.setattr(ListingStore, "_index", overtaken)
    with pytest.raises(ConcurrentRun):
        store.refresh(second, "b")
    assert store.refresh(second, "b")["replaced"] == 8 and store.runs() == 3


def test_published_gold(spark, tmp_path):
    store = ListingStore(spark, str(tmp_path / "store"))
    first, second, _ = [frame(spark, rows) for rows in runs()]
    store.refresh(first, "a")
    store.publish("refreshed_gold")
    old = spark.table("refreshed_gold")
    n = old.count()
    store.refresh(second, "b")
    store.publish("refreshed_gold")
    assert old.count() == n and bag(spark.table("refreshed_gold")) == bag(store.table("gold"))
    assert refresh._split_part(refresh._part("1:2%'x", 3)) == ("1:2%'x", "3")


def many(spark, n):
    """Listings of two days with texts of their own."""
    one = F.col("id").cast("string")
    values = {
        "source": F.lit("p"), "url": F.sha2(one, 256), "title": F.sha2(F.concat(one, F.lit("t")), 256),
        "price_eur": (F.col("id") % 977 + 100).cast("double"), "area_sqm": F.lit(10.0), "rooms": F.lit(2),
        "price_per_sqm": (F.col("id") % 977 + 100) / 10.0, "neighborhood": F.concat(F.lit("n"), F.col("id") % 7),
        "district": F.lit("d"), "latitude": F.lit(40.0), "longitude": F.lit(-3.0),
        "scraped_at": F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"),
        "scrape_date": F.concat(F.lit("2024-01-0"), F.col("id") % 2 + 1),
    }
    return spark.range(n).select(*[values[c].alias(c) for c in SILVER.fieldNames()])


def stored_bytes(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_a_run_stores_no_copy_of_its_rows(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    rows = materialize(many(spark, 20_000), "rows")
    before = stored_bytes(shared)
    ListingStore(spark, str(tmp_path / "store")).refresh(rows, "a")
    assert stored_bytes(shared) - before < stored_bytes(tmp_path / "store" / "data" / "silver") / 4


def test_the_rows_of_a_run_are_shuffled_once(spark, tmp_path, monkeypatch):
    plans, whole, size = {}, DataFrameWriter.parquet, "spark.sql.files.maxPartitionBytes"
    usual, read = spark.conf.get(size), set()

    def watched(self, path, *args, **kwargs):
        if "/data/" in path:
            read.add(spark.conf.get(size))
            plans[path.split("/data/")[1].split("/")[0]] = plan(self._df, "simple")
        return whole(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    store = ListingStore(spark, str(tmp_path / "store"))
    for rows, batch in zip(runs(), "abc"):
        store.refresh(frame(spark, rows), batch)
        shuffles = {name: text.count("Exchange ") - text.count("BroadcastExchange ") for name, text in plans.items()}
        assert (shuffles["silver"], shuffles["gold"]) == (1, 0)
    # Gold's tasks sort what they read by date, so they read little.
    assert read == {"32m"} and spark.conf.get(size) == usual


@pytest.mark.parametrize("limits", [Limits(), Limits(hot_rows=20)])
def test_copies_within_runs(spark, tmp_path, limits):
    """Keys with many copies, also in buckets that are read, and rows without a key."""
    def copies(hour, n):
        rows = [listing(f"u{i % 9}", DAYS[0], 100 + (i * 7) % 50, f"2024-01-01 {hour}:00:00", f"n{i % 3}") for i in range(n)]
        return rows + [listing("hot", DAYS[0], i, f"2024-01-01 {hour}:00:00") for i in range(1, 80)] + [
            listing(None, DAYS[0], 70, f"2024-01-01 {hour}:00:00"), listing("w", DAYS[1], 1, f"2024-01-01 {hour}:00:00", None)]

    store, taken = ListingStore(spark, str(tmp_path / "store"), limits=limits), []
    for i, rows in enumerate([copies(10, 40), copies(12, 30), copies(11, 60)]):
        taken += rows
        store.refresh(frame(spark, rows), f"run-{i}")
        full = materialize(cleaning.latest_copy(frame(spark, taken)), "full")
        assert bag(store.table("silver")) == bag(full)
        assert bag(store.table("gold").drop("neighborhood_avg_price_per_sqm")) == bag(
            indexes.index_a(full).drop("neighborhood_avg_price_per_sqm"))


def test_a_bucket_without_a_change_keeps_its_files(spark, tmp_path):
    store = ListingStore(spark, str(tmp_path / "store"), buckets=1)
    first = runs()[0]
    store.refresh(frame(spark, first), "a")
    before = store._manifest()["tables"]["silver"]
    taken = store.refresh(frame(spark, [first[0], listing("u1", DAYS[1], 1, "2024-02-01 10:00:00")]), "b")
    assert (taken["added"], taken["replaced"], taken["unchanged"], taken["buckets_read"]) == (0, 1, 1, 2)
    after = store._manifest()["tables"]["silver"]
    same, new = f"scrape_date={DAYS[0]}/bucket=0", f"scrape_date={DAYS[1]}/bucket=0"
    assert after[same] == before[same] and after[new] != before[new] and len(after[new]) == 1


@pytest.mark.parametrize("n", [3, 5000])
def test_filters_are_sparks_bitmaps(spark, tmp_path, n):
    store = ListingStore(spark, str(tmp_path / "store"))
    keys = store._bucketed(many(spark, n))
    expected = store._addresses(keys).groupBy("bucket", "chunk", "scrape_date").agg(
        F.bitmap_construct_agg("bit").alias("bits"))
    assert bag(store._filters(keys).select("bucket", "chunk", "scrape_date", F.hex("bits"))) == bag(
        expected.select("bucket", "chunk", "scrape_date", F.hex("bits")))
