"""Silver and Gold that are kept up to date run by run, at the cost of what changed.

``ListingStore.refresh`` takes the cleaned rows of a run and makes the tables
what a full rebuild over all runs would make them:

* ``silver``: the latest copy of every listing, in buckets per date. A run looks
  its keys up in a Bloom filter for each bucket. Buckets that hold none of the keys
  get the new rows beside what they have, unread; the others are read, merged
  and replaced. The run's rows are shuffled once, together with those that were read, and
  lie by date and bucket then. The files also note what the run did with a row, for the
  tables below, so no copy of the run or of its changes is stored.
* ``filters``: the Bloom filters, 32,768 bits for each of ``chunks``.
* ``groups``: sum and count of the price per m² for each neighbourhood and day. Sums
  are decimals, so what a changed listing adds or takes away leaves exactly what
  a sum over the rows that remain would give.
* ``values``: how many listings of a day have each index value, from which ranks
  come. Only listings of neighbourhoods that changed are scored for it, once as
  they were and once as they are.
* ``gold``: index A and ranks of the days that changed. Its rows are written as Silver's lie;
  where the days' ranks are too large to be broadcast, one shuffle ranks them and lays them out.

Every table is a set of folders for each date (and bucket), named by the manifest of the run.
A run writes new folders and then its manifest, which makes all five tables
change at once; a run that fails before leaves nothing that is read. Manifests
are numbered and created once, so of two runs at a time one fails and can be
repeated. A batch id that was taken before changes nothing.

The rows of a run are read several times, so pass stored ones that do not change. The driver holds the
manifest and the dates and buckets a run touches. Prices
per m² beyond 10 ** 27 are left out of averages.
"""

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasador.functions import scoring
from tasador.operators.cleaning import LISTING_KEY, PART_ROWS, combined, in_parts
from tasador.operators.indexes import laid_out_by_rank
from tasador.plans.joins import DEFAULT_LIMITS, Limits, lookup_join
from tasador.plans.workspace import LEAN, materialize, materialize_measured, measured_bytes, with_settings
from tasador.schemas import BIG, DBL, GOLD, INT, SILVER, STR
from tasador.sources.batches import Folder, check_batch_id
from tasador.sources.snapshots import DATE, _make_table, point_view

_RUNS, _DATA = "_runs", "data"
_CHUNK_BITS = 32768  # of one bitmap of Spark's bitmap functions
#: Bits that a key sets in its bucket's filter.
_HASHES = 4
#: Bits in a word of a bitmap.
_WORD = 64
_TOTAL = "decimal(38,10)"
#: Rows that a task reads are sorted by date to be written; as rows they are about ten times as large as in files.
_WRITING = {**LEAN, "spark.sql.files.maxPartitionBytes": "32m"}
#: What a run did with a row: not asked for one in a bucket that it read, not changed, added, replaced.
_KEPT, _SAME, _ADDED, _REPLACED = range(4)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_SCHEMAS = {
    "silver": SILVER,
    "filters": _schema(bucket=INT, chunk=INT, bits=T.BinaryType(), scrape_date=STR),
    "groups": _schema(
        neighborhood=STR, total=T.DecimalType(38, 10), priced=BIG, listings=BIG, scrape_date=STR
    ),
    "values": _schema(opportunity_index=DBL, listings=BIG, scrape_date=STR),
    "gold": GOLD,
}
#: Silver's files also tell what their run did with a row, and what a replaced one was.
_NOTES = _schema(_state=INT, _was=_schema(neighborhood=STR, price_per_sqm=DBL))
_NOTED = T.StructType([*SILVER.fields, *_NOTES.fields, T.StructField("run", STR), T.StructField("bucket", INT)])
_KEYS = {name: (DATE, "bucket") if name == "silver" else (DATE,) for name in _SCHEMAS}


class ConcurrentRun(RuntimeError):
    """Another run took effect while this one was working; run it again."""


class ListingStore:
    """Tables of listings below ``root``; ``buckets`` and ``chunks`` must stay the same."""

    def __init__(
        self, spark: SparkSession, root: str, buckets: int = 4, chunks: int = 4,
        limits: Limits = DEFAULT_LIMITS,
    ):
        self.spark, self.buckets, self.chunks, self.limits = spark, buckets, chunks, limits
        self._folder = Folder(spark, root)

    # --- Manifests ---

    def _manifest(self) -> dict:
        runs = sorted(int(n.removesuffix(".json")) for n in self._folder.names(_RUNS) if n.endswith(".json"))
        if not runs:
            return {"run": 0, "batches": {}, "tables": {name: {} for name in _SCHEMAS}}
        return json.loads(self._folder.read(f"{_RUNS}/{runs[-1]}.json"))

    def _read(self, tables: dict, name: str, dates=None, parts=None) -> DataFrame:
        """A table, of all dates or some, or some of its parts; only their folders are listed."""
        return self._scan(tables, name, _SCHEMAS[name], dates, parts)

    def _scan(self, tables: dict, name: str, schema: T.StructType, dates=None, parts=None) -> DataFrame:
        """``_read`` with other columns of the files."""
        wanted = None if dates is None else {f"{DATE}={_escaped(d)}" for d in dates}
        paths = [
            f"{self._folder.path}/{_DATA}/{name}/run={run}/{part}"
            for part, runs in sorted(tables[name].items()) for run in runs
            if (parts is None or part in parts) and (wanted is None or part.split("/")[0] in wanted)
        ]
        if not paths:
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
            return self.spark.range(0).select(*nothing)
        known = {*schema.fieldNames()}
        folders = [T.StructField("run", STR), *([T.StructField("bucket", INT)] if name == "silver" else [])]
        full = T.StructType([*schema.fields, *[f for f in folders if f.name not in known]])
        base = f"{self._folder.path}/{_DATA}/{name}"
        return self.spark.read.schema(full).option("basePath", base).parquet(*paths).select(
            *schema.fieldNames()
        )

    def table(self, name: str) -> DataFrame:
        """``silver``, ``gold``, ``groups`` or ``values`` as the last run left it."""
        return self._read(self._manifest()["tables"], name)

    def runs(self) -> int:
        return self._manifest()["run"]

    def _write(self, tables: dict, name: str, rows: DataFrame, run: str, replaced) -> None:
        """Write new folders and enter them; parts in ``replaced`` lose their old ones."""
        self._enter(tables, name, self._put(name, rows.hint("rebalance", *_KEYS[name]), run), run, replaced)

    def _put(self, name: str, rows: DataFrame, run: str) -> set[str]:
        """Write new folders of rows that lie together by the table's keys; returns the parts."""
        path = f"{_DATA}/{name}/run={run}"
        with with_settings(self.spark, _WRITING):
            rows.write.partitionBy(*_KEYS[name]).parquet(f"{self._folder.path}/{path}")
        return {f.rpartition("/")[0] for f in self._folder.files(path) if f.endswith(".parquet")} - {""}

    def _enter(self, tables: dict, name: str, parts: set[str], run: str, replaced) -> None:
        own = tables[name]
        for part in list(own):
            if replaced(part):
                del own[part]
        for part in parts:
            own[part] = [*own.get(part, []), run]

    # --- A run ---

    def refresh(self, cleaned: DataFrame, batch_id: str) -> dict[str, int]:
        """Take a run's cleaned rows (Silver's columns); returns how many listings were added,
        replaced and left as they were, and how many buckets and dates were read and rewritten."""
        before = self._manifest()
        if batch_id in before["batches"]:
            return before["batches"][check_batch_id(batch_id)]
        check_batch_id(batch_id)
        tables = {name: {p: list(r) for p, r in own.items()} for name, own in before["tables"].items()}
        run = uuid.uuid4().hex

        batch = self._bucketed(cleaned.select(*SILVER.fieldNames()))
        # One row for each date and bucket.
        sizes = materialize(batch.groupBy(DATE, "bucket").agg(F.count(F.lit(1)).alias("rows")), "run-sizes")
        dates = sorted({r[DATE] for r in sizes.select(DATE).distinct().collect()})
        held = {_part(d, b) for d, b in self._may_hold(tables, batch, dates)}
        noted, counts = self._merge(tables, batch, sizes, held, dates, run)
        days = {f"{DATE}={_escaped(d)}" for d in dates}
        if counts["added"] + counts["replaced"]:
            self._index(before["tables"], tables, noted, dates, run, lambda part: part in days)
        taken = {**counts, "buckets_read": len(held), "dates": len(dates)}
        manifest = {
            "run": before["run"] + 1, "tables": tables,
            "batches": {**before["batches"], batch_id: taken},
        }
        if not self._folder.create(f"{_RUNS}/{manifest['run']}.json", json.dumps(manifest)):
            raise ConcurrentRun(f"run {manifest['run']} took effect meanwhile")
        return taken

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64("url"), F.lit(self.buckets)).cast("int"))

    def _addresses(self, rows: DataFrame) -> DataFrame:
        """Chunk and bit of every hash of a key."""
        def place(i):
            at = F.pmod(F.xxhash64("url", F.lit(i)), F.lit(self.chunks * _CHUNK_BITS))
            return F.struct(
                F.lit(i).alias("hash"), F.floor(at / _CHUNK_BITS).cast("int").alias("chunk"),
                (at % _CHUNK_BITS).alias("bit"),
            )

        return rows.select("url", DATE, "bucket", F.inline(F.array(*[place(i) for i in range(_HASHES)])))

    def _may_hold(self, tables: dict, batch: DataFrame, dates: list[str]) -> list[tuple[str, int]]:
        """Date and bucket of those buckets that may hold a key of the batch."""
        days = {f"{DATE}={_escaped(d)}" for d in dates}
        if not days & tables["filters"].keys():
            return []
        filters = self._read(tables, "filters", dates)
        keys = ["bucket", "chunk", DATE]
        asked = lookup_join(
            self._addresses(batch), filters, keys, ["url"], "inner", self.limits
        )
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10)
        is_set = F.call_function("shiftright", byte.cast("int"), (F.col("bit") % 8).cast("int")).bitwiseAND(1)
        # The batch may have copies of a key.
        hits = F.bit_or(F.call_function("shiftleft", is_set, F.col("hash")))
        per_key = asked.groupBy("url", DATE, "bucket").agg(hits.alias("hits"))
        found = per_key.filter(F.col("hits") == (1 << _HASHES) - 1).select(DATE, "bucket").distinct()
        return [(r[DATE], r["bucket"]) for r in found.collect()]

    def _filters(self, added: DataFrame) -> DataFrame:
        """Bitmaps of keys. Words of them are combined first, by hash; whole bitmaps would
        be sorted, with four rows for each key."""
        byte = F.floor(F.col("bit") / 8)
        # Of a word's hexadecimal digits, the first are its first byte.
        shift = ((_WORD // 8 - 1 - byte % (_WORD // 8)) * 8 + F.col("bit") % 8).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
        words = self._addresses(added).withColumn("word", F.floor(F.col("bit") / _WORD).cast("int")).groupBy(
            "bucket", "chunk", DATE, "word"
        ).agg(F.bit_or(one).alias("ones"))
        width = _WORD // 4
        found = F.struct("word", F.lpad(F.hex("ones"), width, "0").alias("digits"))
        bitmaps = words.groupBy("bucket", "chunk", DATE).agg(F.sort_array(F.collect_list(found)).alias("words"))

        def after_gap(word, i):
            last = F.when(i > 0, F.get("words", i - 1)["word"]).otherwise(-1)
            return F.concat(F.repeat(F.lit("0"), (word["word"] - last - 1) * width), word["digits"])

        digits = F.rpad(F.array_join(F.transform("words", after_gap), ""), _CHUNK_BITS // 4, "0")
        return bitmaps.select("bucket", "chunk", F.unhex(digits).alias("bits"), DATE)

    def _merge(
        self, tables: dict, batch: DataFrame, sizes: DataFrame, held: set[str], dates: list[str], run: str
    ) -> tuple[DataFrame, dict[str, int]]:
        """Write Silver and its filters; returns the written rows with their notes, and how many
        listings were added, replaced and left."""
        names = SILVER.fieldNames()
        rest = [c for c in names if c not in LISTING_KEY and c != "scraped_at"]
        existing = self._bucketed(self._read(tables, "silver", parts=held))
        row = F.struct("scraped_at", *rest)
        both = existing.withColumn("_known", F.lit(True)).unionByName(batch.withColumn("_known", F.lit(False)))
        place = [DATE, "bucket"]
        parts, size = materialize_measured(
            sizes.unionByName(existing.groupBy(*place).agg(F.count(F.lit(1)).alias("rows"))).groupBy(*place).agg(
                F.ceil(F.sum("rows") / PART_ROWS).cast("int").alias("_parts")
            ), "run-parts",
        )
        # The part, which tells the bucket as well, follows from the key, so it divides no group.
        part = (F.col("_part") * self.buckets + F.col("bucket")).alias("_part")
        dealt = in_parts(both, parts, place, ["url"], size).select(*names, "_known", part)
        bucket = F.pmod("_part", F.lit(self.buckets)).alias("bucket")
        merged = combined(
            dealt, LISTING_KEY, [DATE, "_part"], [DATE, bucket, "_part", "url"],
            [F.max(row).alias("new"), F.max(F.when(F.col("_known"), row)).alias("old"),
             F.max(~F.col("_known")).alias("given")],
            self.limits.hot_rows,
        )
        state = F.when(~F.col("given"), _KEPT).when(F.col("old").isNull(), _ADDED).when(
            F.col("old").eqNullSafe(F.col("new")), _SAME
        ).otherwise(_REPLACED)
        was = F.when(F.col("_state") == _REPLACED, F.struct("old.neighborhood", "old.price_per_sqm"))
        rows = merged.withColumn("_state", state).withColumn("_was", was).select(
            *LISTING_KEY, "bucket", "new.*", *_NOTES.fieldNames()
        )
        written = self._put("silver", rows.select(*names, *_NOTES.fieldNames(), "bucket"), run)
        noted = self._scan({"silver": {part: [run] for part in written}}, "silver", _NOTED)
        # One row for each date and bucket.
        states = noted.groupBy(*place).agg(
            *[F.count_if(F.col("_state") == s).alias(n) for n, s in (
                ("added", _ADDED), ("replaced", _REPLACED), ("unchanged", _SAME))]
        ).collect()
        # Of the buckets that were read, those without a change keep their folders.
        left = {_part(r[DATE], r["bucket"]) for r in states if not r["added"] + r["replaced"]} & held
        stale = (written & held) - left
        self._enter(tables, "silver", written - left, run, lambda part: part in stale)

        filters = self._read(tables, "filters", dates).unionByName(
            self._filters(noted.filter(F.col("_state") == _ADDED))
        ).groupBy("bucket", "chunk", DATE).agg(F.bitmap_or_agg("bits").alias("bits"))
        known = {f"{DATE}={_escaped(d)}" for d in dates}
        self._write(tables, "filters", filters, run, lambda part: part in known)
        return noted, {n: sum(r[n] for r in states) for n in ("added", "replaced", "unchanged")}

    def _index(self, before: dict, tables: dict, noted: DataFrame, dates, run: str, replaced) -> None:
        """Write groups, values and Gold of the dates of a run."""
        group = ["neighborhood", DATE]
        price = F.col("price_per_sqm").try_cast(_TOTAL)
        # A product with the sign would lose digits.
        amount = F.when(F.col("sign") > 0, price).otherwise(-price)
        delta = materialize(_moves(noted.filter(F.col("_state").isin(_ADDED, _REPLACED))).groupBy(*group).agg(
            F.coalesce(F.sum(amount), F.lit(0)).cast(_TOTAL).alias("total"),
            F.sum(F.when(price.isNotNull(), F.col("sign")).otherwise(0)).alias("priced"),
            F.sum("sign").alias("listings"),
        ), "run-delta")
        old_groups = self._read(before, "groups", dates)
        sums = [F.sum(c).cast(_SCHEMAS["groups"][c].dataType).alias(c) for c in ("total", "priced", "listings")]
        groups = old_groups.unionByName(delta).groupBy(*group).agg(*sums)
        self._write(tables, "groups", groups.filter("listings > 0"), run, replaced)
        new_groups = self._read(tables, "groups", dates)

        # Averages of the groups that changed, as they were and as they are.
        both = old_groups.withColumn("sign", F.lit(-1)).unionByName(new_groups.withColumn("sign", F.lit(1)))
        near, size = materialize_measured(lookup_join(
            both.select(*group, "sign", _average().alias("neighborhood_avg_price_per_sqm"), "listings"),
            delta.select(*group, F.lit(True).alias("_changed")), group, ["sign"], "inner", self.limits,
        ).drop("_changed"), "run-averages")
        now = self._scan(tables, "silver", _NOTED, dates)
        # What an earlier run noted is past.
        own = F.when(F.col("run") == run, F.col("_state")).otherwise(_KEPT)
        moved = lookup_join(
            _moves(now.withColumn("_state", own)), near.drop("listings"), [*group, "sign"], ["url"], "inner",
            self.limits, key_counts=near.select(*group, "sign", F.col("listings").alias("n")), lookup_bytes=size,
        )
        counted = _with_index(moved).select("opportunity_index", F.col("sign").cast("long").alias("listings"), DATE)
        values = self._read(before, "values", dates).unionByName(counted)
        values = values.groupBy("opportunity_index", DATE).agg(F.sum("listings").alias("listings"))
        self._write(tables, "values", values.filter("listings <> 0"), run, replaced)

        gold = self._ranked(now.select(*SILVER.fieldNames()), new_groups, self._read(tables, "values", dates))
        self._enter(tables, "gold", self._put("gold", gold.select(*GOLD.fieldNames()), run), run, replaced)

    def _ranked(self, now: DataFrame, groups: DataFrame, values: DataFrame) -> DataFrame:
        """Gold's rows, ready to be written by day: as Silver lies where the averages and the ranks are
        broadcast, else from one shuffle that ranks them."""
        stats = groups.select(
            "neighborhood", DATE, _average().alias("neighborhood_avg_price_per_sqm"),
            F.col("listings").alias("listing_count"),
        )
        size = measured_bytes(stats)
        scored = _with_index(lookup_join(
            now, stats, ["neighborhood", DATE], ["url"], "inner", self.limits, lookup_bytes=size,
            key_counts=stats.select("neighborhood", DATE, F.col("listing_count").alias("n")),
        ))
        many, few = F.col("listing_count") > 1, self.limits.broadcast_bytes
        # A value's rank is as large as its count.
        if size > few or (size := measured_bytes(values)) > few:
            return laid_out_by_rank(scored, limits=self.limits, counts=values).filter(many)
        better = Window.partitionBy(DATE).orderBy(F.desc_nulls_last("opportunity_index")).rowsBetween(
            Window.unboundedPreceding, -1
        )
        ranks = materialize(values.withColumn(
            "rank", F.coalesce(F.sum("listings").over(better), F.lit(0)) + 1
        ).drop("listings"), "run-ranks")
        return lookup_join(
            scored.filter(many), ranks, ["opportunity_index", DATE], ["url"], "inner", self.limits, lookup_bytes=size
        )

    # --- Serving ---

    def publish(self, name: str) -> None:
        """Show Gold as the last run left it under ``name``, by replacing one view."""
        manifest = self._manifest()
        table = f"{name}__run{manifest['run']}"
        dates = {
            part: f"{self._folder.path}/{_DATA}/gold/run={runs[-1]}/{part}"
            for part, runs in manifest["tables"]["gold"].items()
        }
        if not self.spark.catalog.tableExists(table):
            _make_table(self.spark, table, GOLD, f"{self._folder.path}/{_DATA}/_none", dates)
        point_view(self.spark, name, table)


def _moves(rows: DataFrame) -> DataFrame:
    """A row of Silver as it is, with the sign 1, and as it was before its run, if it was, with -1."""
    state, columns = F.col("_state"), ("neighborhood", "price_per_sqm")
    as_it_is = F.struct(F.lit(1).alias("sign"), *columns)
    as_it_was = F.when(state == _REPLACED, F.struct(F.lit(-1).alias("sign"), *[f"_was.{c}" for c in columns])).when(
        state != _ADDED, F.struct(F.lit(-1).alias("sign"), *columns)
    )
    return rows.select(*LISTING_KEY, F.inline(F.array_compact(F.array(as_it_is, as_it_was))))


def _with_index(averaged: DataFrame) -> DataFrame:
    return averaged.withColumn("opportunity_index", scoring.discount_to_average(
        F.col("price_per_sqm"), F.col("neighborhood_avg_price_per_sqm")
    ))


def _average() -> Column:
    return F.try_divide(F.col("total").cast("double"), F.col("priced").cast("double"))


def _escaped(date: str) -> str:
    """A date as Spark names its folder."""
    odd = set('"#%\'*/:=?\\{[]^') | {chr(i) for i in range(32)} | {"\x7f"}
    return "".join(f"%{ord(c):02X}" if c in odd else c for c in date)


def _part(date: str, bucket: int) -> str:
    return f"{DATE}={_escaped(date)}/bucket={bucket}"


def _split_part(part: str) -> tuple[str, str]:
    date, bucket = part.split("/")
    return unquote(date.partition("=")[2]), bucket.partition("=")[2]


def _key(part: str) -> str:
    return "|".join(_split_part(part))
