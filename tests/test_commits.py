"""Batches that take effect once, and versions that are switched in one step."""

import threading

import pytest
from pyspark.sql import functions as F

from tasador.layers import gold_layer
from tasador.sources import batches, readers, snapshots, writers
from test_io import record


def two_folders(tmp_path):
    return str(tmp_path / "bronze"), str(tmp_path / "rejected")


def urls(spark, good, bad):
    return (sorted(r.url for r in readers.read_bronze(spark, good).collect()),
            sorted(r.url for r in spark.read.parquet(bad).collect()))


def take(spark, good, bad, batch_id, *names):
    rows = [record(n, raw_price=None if n.startswith("bad") else "1 €") for n in names]
    return writers.ingest_records(spark, rows, good, bad, "p", "2024-01-15", batch_id)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    good, bad = two_folders(tmp_path)
    assert take(spark, good, bad, "b-1", "u1", "bad1") == {"valid": 1, "rejected": 1}
    assert take(spark, good, bad, "b-1", "u1", "bad1", "more") == {"valid": 1, "rejected": 1}
    assert take(spark, good, bad, "b-2", "u1", "bad1") == {"valid": 1, "rejected": 1}
    assert urls(spark, good, bad) == (["u1", "u1"], ["bad1", "bad1"])
    assert batches.committed(spark, good) == ["b-1", "b-2"]
    files = list((tmp_path / "bronze" / "source=p" / "date=2024-01-15").glob("*.parquet"))
    assert {f.name[:3] for f in files} == {"b-1", "b-2"}


@pytest.mark.parametrize("step", ["stage", "commit", "_move"])
def test_a_batch_that_failed_is_run_again(spark, tmp_path, monkeypatch, step):
    """A failure after the first sink, before the commit, and between commit and moves."""
    good, bad = two_folders(tmp_path)
    take(spark, good, bad, "b-0", "u0", "bad0")
    whole = getattr(batches.Batch, step)

    def failing(self, *args):
        if step == "stage" and args[0] == "bad":
            return whole(self, *args)
        raise OSError("lost")

    monkeypatch.setattr(batches.Batch, step, failing)
    with pytest.raises(OSError):
        take(spark, good, bad, "b-1", "u1", "bad1")
    monkeypatch.setattr(batches.Batch, step, whole)
    assert urls(spark, good, bad) == (["u0"], ["bad0"])
    if step == "_move":  # committed: the next ingest completes it, whichever it is
        take(spark, good, bad, "b-2", "u2", "bad2")
        assert urls(spark, good, bad) == (["u0", "u1", "u2"], ["bad0", "bad1", "bad2"])
    assert take(spark, good, bad, "b-1", "u1", "bad1") == {"valid": 1, "rejected": 1}
    found = urls(spark, good, bad)
    assert found[0].count("u1") == 1 and found[1].count("bad1") == 1


def test_moves_that_stopped_halfway(spark, tmp_path, monkeypatch):
    good, bad = two_folders(tmp_path)
    calls = []
    move = batches.Folder.move

    def once(self, *args):
        calls.append(args)
        if len(calls) > 1:
            raise OSError("lost")
        move(self, *args)

    monkeypatch.setattr(batches.Folder, "move", once)
    with pytest.raises(OSError):
        take(spark, good, bad, "b-1", "u1", "bad1")
    monkeypatch.setattr(batches.Folder, "move", move)
    batches.complete(spark, {"good": good, "bad": bad})
    assert urls(spark, good, bad) == (["u1"], ["bad1"])
    assert not list((tmp_path / "bronze" / "_staged").iterdir())


def test_one_manifest_of_two_attempts_counts(spark, tmp_path):
    good, bad = two_folders(tmp_path)
    row = spark.createDataFrame([("a", "s", "d")], "url string, source string, date string")
    first, second = (batches.Batch(spark, "same", {"good": good, "bad": bad}) for _ in range(2))
    first.stage("good", row, ("source", "date"))
    second.stage("good", row, ("source", "date"))
    assert second.commit({"valid": 1}) == {"valid": 1}
    assert first.commit({"valid": 99}) == {"valid": 1}
    assert spark.read.parquet(good).count() == 1
    with pytest.raises(ValueError):
        batches.Batch(spark, "a/b", {"good": good})


def test_no_good_record_leaves_nothing(spark, tmp_path):
    good, bad = two_folders(tmp_path)
    with pytest.raises(ValueError, match="2 rejected"):
        take(spark, good, bad, "b-1", "bad1", "bad2")
    assert batches.committed(spark, good) == [] and not (tmp_path / "rejected").exists()


def test_versions_share_unchanged_dates(spark, sf_dir, tmp_path):
    root, gold = str(tmp_path / "gold"), gold_layer(spark, sf_dir)
    day = gold.filter("scrape_date = '1998-03'")
    assert snapshots.write_version(gold, root) == 1
    folders = {p.name for p in (tmp_path / "gold" / "data").iterdir()}
    assert snapshots.write_version(day.limit(5), root) == 2
    new = [p for p in (tmp_path / "gold" / "data").iterdir() if p.name not in folders]
    assert [d.name for d in new[0].iterdir() if d.is_dir()] == ["scrape_date=1998-03"]
    assert snapshots.publish_version(spark, root, "shared_days") == 2
    table = spark.table("shared_days")
    assert table.filter("scrape_date = '1998-03'").count() == 5
    assert table.count() == gold.count() - day.count() + 5
    # An older version, then only what is used stays.
    assert snapshots.publish_version(spark, root, "shared_days", 1) == 1
    assert spark.table("shared_days").count() == gold.count()
    assert snapshots.published_version(spark, root) == 1
    snapshots.write_version(day.limit(1), root, removed=("1998-04",))
    assert snapshots.drop_versions(spark, root, "shared_days", keep=1) == [2]
    assert snapshots.versions(spark, root) == [1, 3]
    assert spark.table("shared_days").count() == gold.count()
    snapshots.publish_version(spark, root, "shared_days")
    gone = gold.filter("scrape_date = '1998-04'").count()
    assert spark.table("shared_days").count() == gold.count() - day.count() - gone + 1


def test_readers_never_miss_the_table(spark, sf_dir, tmp_path):
    """A reader that asks all the time while versions are published."""
    root = str(tmp_path / "gold")
    gold = gold_layer(spark, sf_dir).filter("scrape_date < '1995-04'").coalesce(1)
    total = gold.count()
    snapshots.write_version(gold, root)
    snapshots.write_version(gold.filter("scrape_date = '1995-01'").limit(1), root)
    snapshots.publish_version(spark, root, "steady", 1)
    seen, failed, done = set(), [], threading.Event()

    def read():
        session = spark.newSession()
        while not done.is_set():
            try:
                seen.add(session.table("steady").count())
            except Exception as error:
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for version in (2, 1, 2, 1):
        snapshots.publish_version(spark, root, "steady", version)
    done.set()
    reader.join()
    assert not failed and seen and all(n == total or n < total for n in seen) and len(seen) <= 2


def test_publishing_replaces_a_table_of_old(spark, sf_dir, tmp_path):
    path = str(tmp_path / "gold")
    day = gold_layer(spark, sf_dir).filter("scrape_date = '1998-03'")
    writers.write_gold(day, path)
    spark.range(3).write.saveAsTable("once_a_table")
    for _ in range(2):
        assert writers.publish(spark, path, "once_a_table") == day.count()
    assert len([t for t in spark.catalog.listTables() if t.name.startswith("once_a_table__")]) == 1


def test_the_newest_date_needs_no_scan(spark, sf_dir, tmp_path):
    root, gold = str(tmp_path / "gold"), gold_layer(spark, sf_dir)
    snapshots.write_version(gold, root)
    table = snapshots.table_of("dated", snapshots.publish_version(spark, root, "dated"))
    newest = snapshots.newest_date(spark, table)
    text = newest._sc._jvm.PythonSQLUtils.explainString(newest._jdf.queryExecution(), "simple")
    assert "FileScan" not in text
    assert newest.first()[0] == gold.agg(F.max("scrape_date")).first()[0]
    latest = snapshots.latest_snapshot(spark, table)
    assert {f.split("scrape_date=")[1].split("/")[0] for f in latest.inputFiles()} == {newest.first()[0]}


def test_odd_dates_are_served(spark, sf_dir, tmp_path):
    root = str(tmp_path / "gold")
    odd = gold_layer(spark, sf_dir).limit(1).withColumn("scrape_date", F.lit("1:5+x%'y z"))
    snapshots.write_version(odd, root)
    table = snapshots.table_of("odd_dates", snapshots.publish_version(spark, root, "odd_dates"))
    assert [r.scrape_date for r in snapshots.latest_snapshot(spark, table).collect()] == ["1:5+x%'y z"]
