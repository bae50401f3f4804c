"""Bronze, Silver and Gold of a data folder, written once per application.

Serving queries read published layers; they do not rebuild them. The first
query that needs a layer writes it to the shared folder.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasador.operators.cleaning import clean, silver
from tasador.operators.indexes import index_a
from tasador.plans.workspace import LEAN, fresh_path, read_stored, store, with_settings
from tasador.sources.listings import raw_listings
from tasador.sources.writers import write_gold_by_place
from tasador.streaming.refresh import ListingStore

#: Ranges of the layout by place, at least, and the rows that one takes.
PLACE_FILES, PLACE_ROWS = 16, 500_000

_written: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


def _layer(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
    partition_by: tuple[str, ...] = ("scrape_date",), laid_out: bool = False,
) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        layer = build()
        with with_settings(spark, LEAN):
            path, _ = store(layer, name, partition_by, laid_out)
        _written[key] = path, read_stored(spark, path, layer.schema)
    path, scan = _written[key]
    # Another session of the application reads the same files with its own scan.
    return scan if scan.sparkSession is spark else read_stored(spark, path, scan.schema)


def bronze_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw listings. Their readers take all dates, so the files are not laid out by date
    and the rows are not shuffled for it."""
    return _layer(spark, sf_dir, "bronze", lambda: raw_listings(spark, sf_dir), partition_by=())


def silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver by date; the shuffle that removes the copies lays out the files as well."""
    return _layer(spark, sf_dir, "silver", lambda: silver(
        bronze_layer(spark, sf_dir), lay_out_by="scrape_date"
    ), laid_out=True)


def gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold by date; its rows lie as Silver's do, or as the shuffle that ranks them leaves them."""
    return _layer(spark, sf_dir, "gold", lambda: index_a(
        silver_layer(spark, sf_dir), lay_out=True
    ), laid_out=True)


def place_files(rows: int) -> int:
    return max(PLACE_FILES, -(-rows // PLACE_ROWS))


def place_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mappable Gold rows, laid out by place."""
    key = (spark.sparkContext.applicationId, sf_dir, "place")
    if key not in _written:
        path, gold = fresh_path(spark, "gold-by-place"), gold_layer(spark, sf_dir)
        # Counted from the files' footers.
        write_gold_by_place(gold, path, place_files(gold.count()))
        _written[key] = path, read_stored(spark, path, gold.schema)
    path, scan = _written[key]
    return scan if scan.sparkSession is spark else read_stored(spark, path, scan.schema)


def refreshed_store(spark: SparkSession, sf_dir: str) -> ListingStore:
    """A store after three runs: most listings; the other listings of early dates, also copies;
    the second run again."""
    key = (spark.sparkContext.applicationId, sf_dir, "refreshed")
    if key not in _written:
        path, rows = fresh_path(spark, "listings"), clean(bronze_layer(spark, sf_dir))
        late = F.coalesce((F.col("scrape_date") < "1996") & (F.col("rooms") == 1), F.lit(False))
        store = ListingStore(spark, path)
        for batch, of in (("first", ~late), ("second", late), ("second", late)):
            store.refresh(rows.filter(of), batch)
        _written[key] = path, rows
    return ListingStore(spark, _written[key][0])


def forget_layers() -> None:
    """Build the layers anew on the next use (for timing)."""
    _written.clear()
