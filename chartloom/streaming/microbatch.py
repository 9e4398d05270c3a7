"""What happens to one micro-batch.

`foreachBatch` may deliver a batch twice. Every table of the feed is a table of batches
(`sinks/batches.py`): a step that has published a batch is not repeated, one that has not
starts anew, so after any number of retries the tables hold each batch once.

A batch whose cleaning can never succeed must not stop the feed: it stays in bronze, is left
out of the later tables and entered in the ledger, and `reclean` brings it in once the
cleaning was mended. Errors of storage and of executors are no such case; they reach the
query, and the batch is delivered again.
"""

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.functions import dates
from chartloom.operators.cleaning import ENTRY_KEY, transform_charts
from chartloom.operators.shaping import keep_latest, top_k
from chartloom.registry import Lake
from chartloom.sinks.batches import BatchTable, batch_table
from chartloom.sinks.tables import new_rows, stamp_ingestion
from chartloom.sources.files import read_table

# The identity of a feed entry, and how many entries "recent" means.
MERGE_KEY = ["track_id", "chart_date", "region"]
RECENT_ROWS = 100
RECENT_COLUMNS = ["ingestion_ts", "artist", "title", "region", "chart", "rank", "streams", "chart_date"]
LATER_TABLES = ["silver.charts_streaming", "gold.top_artists_partials", "gold.top_artists_streaming", "gold.recent_submissions"]
FEED_TABLES = ["bronze.charts_streaming", *LATER_TABLES, "gold.batch_metrics", "silver.batch_ledger"]
FAILED, RECOVERED = "failed", "recovered"


class CleaningError(Exception):
    """The cleaning of a batch could not even be stated as a plan."""


@dataclass
class ChartSink:
    """Callable for `foreachBatch`: bronze, cleaning, upsert, two incremental marts, metrics.

    `clean` turns raw rows into entries; it defaults to `transform_charts` on `entry_key`.
    """

    lake: Lake
    entry_key: list[str] = field(default_factory=lambda: list(ENTRY_KEY))
    clean: Callable[[DataFrame], DataFrame] | None = None
    _tables: dict[str, BatchTable] = field(default_factory=dict)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, started = batch.sparkSession, time.perf_counter()
        self.create_tables(spark)
        rows, months, total = self.write_bronze(batch, batch_id)
        if rows == 0:
            return
        if batch_id in self._tables[LATER_TABLES[0]].live().skipped:
            self.pass_over(batch_id)  # left out before; `reclean` brings it in
        else:
            try:
                self.apply(spark, batch_id, months)
            except Exception as error:
                reason = lasting_reason(error)
                if reason is None:
                    raise
                self.enter(spark, batch_id, reason, FAILED)
                self.pass_over(batch_id)
        self.write_metrics(spark, batch_id, rows, total, (time.perf_counter() - started) * 1000)
        for table in self._tables.values():
            table.fold()

    def create_tables(self, spark: SparkSession) -> None:
        if not self._tables:
            self._tables = {key: batch_table(spark, self.lake, key) for key in FEED_TABLES}
            for table in self._tables.values():
                table.create()

    def apply(self, spark: SparkSession, batch_id: int, months: list[str]) -> None:
        """Everything that follows bronze."""
        fresh, touched = self.merge_silver(months, batch_id)
        self.update_totals(fresh, touched, batch_id)
        self.update_recent(fresh, batch_id)

    def write_bronze(self, batch: DataFrame, batch_id: int) -> tuple[int, list[str], int]:
        """Store the batch; returns its row count, the months its dates fall in, and all rows so far.

        They are taken by the write itself. The months are a short list, bounded by the calendar.
        """
        table = self._tables["bronze.charts_streaming"]
        live = table.live()
        if live.has(batch_id):
            return self.stored(batch_id)
        stamped = stamp_ingestion(batch.drop("timestamp")).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        month = dates.month_start(dates.parse_date("date")).cast("string")
        seen = table.add(
            stamped, batch_id, counters={"months": F.collect_set(month)},
            note=lambda s: {"batch": batch_id, "rows": s["rows"], "months": sorted(s["months"]), "total": live.note.get("total", 0) + s["rows"]})
        return seen["rows"], sorted(seen["months"]), live.note.get("total", 0) + seen["rows"]

    def stored(self, batch_id: int) -> tuple[int, list[str], int]:
        """The same about a batch that bronze has already: from the table's note if it is the newest one, else counted."""
        table = self._tables["bronze.charts_streaming"]
        note = table.live().note
        if note.get("batch") == batch_id:
            return note["rows"], note["months"], note["total"]
        month = dates.month_start(dates.parse_date("date")).cast("string")
        own = table.of_batch(batch_id).agg(F.count(F.lit(1)).alias("rows"), F.collect_set(month).alias("months")).first()
        total = table.read().where(F.col("batch_id") <= batch_id).count()
        return own["rows"], sorted(own["months"]), total

    def cleaned(self, batch_id: int) -> DataFrame:
        """The plan that cleans a stored batch, which is read from bronze, so that the source is scanned once."""
        raw = self._tables["bronze.charts_streaming"].of_batch(batch_id).drop("batch_id")
        try:
            entries = self.clean(raw) if self.clean else transform_charts(raw, self.entry_key)
            return entries.withColumn("month_start", dates.month_start("chart_date"))
        except OSError:
            raise
        except Exception as error:
            raise CleaningError(f"{type(error).__name__}: {error}") from error

    def merge_silver(self, months: list[str], batch_id: int) -> tuple[DataFrame, list[str]]:
        """Insert the batch's new entries; returns them as read back from the table, and their months.

        Only the target's months that occur in the batch take part in the match.
        """
        table = self._tables["silver.charts_streaming"]
        if not table.live().has(batch_id):
            cleaned = self.cleaned(batch_id)
            target = table.read(months)
            rest = [c for c in sorted(cleaned.columns) if c not in MERGE_KEY]
            inserted = new_rows(cleaned, target, MERGE_KEY, [F.col(c).asc_nulls_last() for c in rest])
            columns = [f.name for f in table.schema.fields]
            inserted = inserted.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*columns)
            touched = table.add(inserted, batch_id, sized=True)["keys"]
        else:
            touched = [r[0] for r in table.of_batch(batch_id, months).select(F.col("month_start").cast("string")).distinct().collect()]
        return table.of_batch(batch_id, touched), touched

    def update_totals(self, fresh: DataFrame, months: list[str], batch_id: int) -> None:
        """Add the batch's artist totals, then refresh the months it touched.

        Each batch contributes one row per artist and month it inserted; the leaderboard of
        a month is the sum of those rows, so no batch rescans the entries of earlier ones.
        """
        partials, totals = self._tables["gold.top_artists_partials"], self._tables["gold.top_artists_streaming"]
        if not partials.live().has(batch_id):
            own = artist_month_totals(fresh).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            partials.add(own.select(*[f.name for f in partials.schema.fields]), batch_id)
        if not totals.live().has(batch_id):
            refreshed = sum_partials(partials.read(months))
            totals.add(refreshed.select(*[f.name for f in totals.schema.fields]), batch_id, replace_keys=True)

    def update_recent(self, fresh: DataFrame, batch_id: int) -> None:
        """Newest entries after this batch, from those before it and the batch's own."""
        table = self._tables["gold.recent_submissions"]
        if not table.live().has(batch_id):
            candidates = top_k(fresh, RECENT_ROWS, recent_order()).select(*RECENT_COLUMNS)
            candidates = candidates.unionByName(table.newest().select(*RECENT_COLUMNS))
            recent = top_k(candidates, RECENT_ROWS, recent_order())
            named = max(batch_id, table.live().batch)  # a batch that comes late makes the newest list anew
            table.add(recent.withColumn("batch_id", F.lit(named).cast("bigint")), batch_id)

    def write_metrics(self, spark: SparkSession, batch_id: int, rows: int, total: int, elapsed_ms: float) -> None:
        """One record per batch."""
        table = self._tables["gold.batch_metrics"]
        if not table.live().has(batch_id):
            rate = rows / elapsed_ms * 1000 if elapsed_ms > 0 else 0.0
            values = [batch_id, rows, round(elapsed_ms, 1), round(rate, 1), total, time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime())]
            table.add(_record(spark, schemas.BATCH_METRICS_SCHEMA, values), batch_id)

    # --- batches that were left out ------------------------------------------------

    def enter(self, spark: SparkSession, batch_id: int, reason: str, state: str) -> None:
        """A line in the ledger; the latest one of a batch says how it stands."""
        table = self._tables["silver.batch_ledger"]
        entry = table.live().version
        values = [batch_id, "cleaning", reason[:2000], state, entry]
        record = _record(spark, schemas.BATCH_LEDGER_SCHEMA, [*values, None]).withColumn("ts", F.current_timestamp())
        table.add(record, entry)

    def pass_over(self, batch_id: int) -> None:
        for key in LATER_TABLES:
            if not self._tables[key].live().has(batch_id):
                self._tables[key].skip(batch_id)

    def reclean(self, spark: SparkSession, batch_ids: Iterable[int] | None = None) -> list[int]:
        """Bring in batches that were left out, all or those named, from bronze; returns those that are in now.

        May be repeated, also after it was interrupted: steps that were published are not done again.
        """
        self.create_tables(spark)
        waiting = [r.batch_id for r in failed_batches(spark, self.lake).select("batch_id").orderBy("batch_id").collect()]
        back = []
        for batch_id in waiting if batch_ids is None else sorted(set(batch_ids) & set(waiting)):
            try:
                self.apply(spark, batch_id, self.stored(batch_id)[1])
            except Exception as error:
                reason = lasting_reason(error)
                if reason is None:
                    raise
                self.enter(spark, batch_id, reason, FAILED)
                continue
            self.enter(spark, batch_id, "", RECOVERED)
            back.append(batch_id)
        for table in self._tables.values():
            table.fold()
        return back


def _record(spark: SparkSession, schema, values: list) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, schema.fields)])


# What Spark's errors about rows and plans are called; they come again with every attempt.
ROW_ERRORS = frozenset(
    f"org.apache.spark.Spark{kind}Exception"
    for kind in ("Arithmetic", "ArrayIndexOutOfBounds", "DateTime", "IllegalArgument", "NoSuchElement", "NumberFormat", "Runtime",
                 "UnsupportedOperation", "Upgrade")
) | {"org.apache.spark.api.python.PythonException", "org.apache.spark.sql.AnalysisException"}


def lasting_reason(error: Exception) -> str | None:
    """Why another attempt would fail in the same way; None if storage or an executor may be the cause, or nobody knows."""
    if isinstance(error, CleaningError):
        return str(error)
    names, cause, told = [], getattr(error, "_origin", None), None
    while cause is not None and len(names) < 50:
        name = cause.getClass().getName()
        names.append(name)
        if name in ROW_ERRORS:
            told = told or f"{name.rpartition('.')[2]}: {cause.getMessage()}"
        cause = cause.getCause()
    if any("IOException" in n or n.startswith(("java.io.", "java.net.", "java.nio.")) for n in names):
        return None
    return told or (f"{type(error).__name__}: {error}" if isinstance(error, AnalysisException) else None)


def ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    """How every batch that ever failed stands now."""
    return keep_latest(read_table(spark, lake, "silver.batch_ledger"), ["batch_id"], [F.col("entry").desc()])


def failed_batches(spark: SparkSession, lake: Lake) -> DataFrame:
    return ledger(spark, lake).where(F.col("state") == FAILED)


def recent_order():
    return [F.col("ingestion_ts").desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in ("chart_date", "region", "chart", "rank", "artist", "title", "streams")
    ]


def artist_month_totals(entries: DataFrame) -> DataFrame:
    """Streams and entries per artist and month, over entries that have streams."""
    return (
        entries.where(F.col("streams").isNotNull())
        .groupBy("artist", dates.month_start("chart_date").alias("month_start"))
        .agg(F.sum("streams").alias("monthly_streams"), F.count(F.lit(1)).alias("chart_entries"))
    )


def sum_partials(partials: DataFrame) -> DataFrame:
    return partials.groupBy("artist", "month_start").agg(
        F.sum("monthly_streams").alias("monthly_streams"),
        F.sum("chart_entries").alias("chart_entries"),
    )


def totals_as_of(partials: DataFrame, batch_id: int) -> DataFrame:
    """The streaming leaderboard as it was after batch `batch_id`."""
    return sum_partials(partials.where(F.col("batch_id") <= batch_id))


def recompute_totals(silver: DataFrame) -> DataFrame:
    """The same leaderboard computed from all entries, ordered by streams."""
    return artist_month_totals(silver).orderBy(F.col("monthly_streams").desc())


def recent_entries(silver: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """The newest entries computed from the whole table."""
    return top_k(silver, rows, recent_order()).select(*RECENT_COLUMNS)


def latest_snapshot(table: DataFrame) -> DataFrame:
    """The rows of the highest batch id of a snapshot table."""
    newest = table.agg(F.max("batch_id").alias("newest")).first().newest
    return table.where(F.col("batch_id") == F.lit(newest)) if newest is not None else table.limit(0)
