"""The streamed ingest takes each arriving file once."""

from tasador.schemas import INCOMING
from tasador.sources.readers import read_bronze
from tasador.streaming.ingest import incoming_stream, start_ingest


def arrive(spark, path, *urls):
    rows = [("P", u, "t", None if u == "bad" else "1 €", "2 m²") + (None,) * 5 + ("2024-01-15", "") for u in urls]
    spark.createDataFrame(rows, INCOMING).coalesce(1).write.mode("append").parquet(path)


def test_runs_take_only_new_files(spark, tmp_path):
    inbox, bronze, rejected = [str(tmp_path / n) for n in ("inbox", "bronze", "rejected")]

    def run():
        start_ingest(
            incoming_stream(spark, inbox), bronze, rejected, str(tmp_path / "state"), "2024-02-01"
        ).awaitTermination()
        return sorted(r.url for r in read_bronze(spark, bronze).collect())

    arrive(spark, inbox, "u1", "bad")
    assert run() == ["u1"]
    assert run() == ["u1"]
    arrive(spark, inbox, "u2")
    assert run() == ["u1", "u2"]
    row = read_bronze(spark, bronze).filter("url = 'u2'").first()
    assert (row.source, row.date, row.scrape_date) == ("p", "2024-02-01", "2024-01-15")
    assert [r.url for r in spark.read.parquet(rejected).collect()] == ["bad"]


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    """The run's bookkeeping is lost after its writes: the batch is read once more."""
    inbox, bronze, rejected, state = [str(tmp_path / n) for n in ("in", "bronze", "rejected", "state")]
    arrive(spark, inbox, "u1", "bad")
    for _ in range(2):
        start_ingest(incoming_stream(spark, inbox), bronze, rejected, state, "2024-02-01").awaitTermination()
        commits = list((tmp_path / "state" / "commits").glob("*0*"))
        assert commits
        for file in commits:
            file.unlink()
    assert [r.url for r in read_bronze(spark, bronze).collect()] == ["u1"]
    assert [r.url for r in spark.read.parquet(rejected).collect()] == ["bad"]
