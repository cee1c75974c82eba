"""Layer runs: bronze to silver to gold, by increments that lose no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.functions.series import spread_join
from barflow.operators import clean, indicators, quality
from barflow.operators.reports import failure_log, ingestion_log, latest_rows
from barflow.operators.upsert import BEGINNING, new_rows, newer_than
from barflow.session import staged
from barflow.sources import tables, zones
from barflow.sources.zones import PERIOD

BRONZE_KEY = ("symbol", "date", "source")
BAR_KEY = ("symbol", "date")
LOG_KEY = ("batch_id", "symbol")
#: Days before a symbol's newest clean bar in which a bar may still arrive; older ones go to ``late``.
REFETCH_DAYS = 7


def _look_back(bronze: DataFrame, stored: DataFrame) -> DataFrame:
    """The newest stored bar of each symbol in the columns of bronze."""
    newest = latest_rows(stored.select("symbol", "date", *clean.PRICES, "adj_close", "volume", "batch_id"))
    return newest.select(
        *[c if c in newest.columns else F.lit(None).cast(bronze.schema[c].dataType).alias(c)
          for c in bronze.columns]
    )


def silver_increment(bronze: DataFrame, stored: DataFrame) -> DataFrame:
    """Clean bars newer than the stored ones.

    The newest stored bar of each symbol goes in front of the new rows, so that the first return and
    the forward fill know what came before; it is cut off again afterwards.
    """
    new = newer_than(bronze, stored)
    return newer_than(clean.silver(_look_back(bronze, stored).unionByName(new)), stored)


def _from_start(rows: DataFrame, starts: DataFrame, before: bool = False) -> DataFrame:
    """Rows from their symbol's start on; or those before it, with all rows of symbols without a start."""
    joined = spread_join(rows, starts, ["symbol"], "left" if before else "inner")
    wanted = F.col("start").isNull() | (F.col("date") < F.col("start")) if before else F.col("date") >= F.col("start")
    return joined.filter(wanted).select(*rows.columns)


def _store_new(spark: SparkSession, rows: DataFrame, path: str, keys) -> None:
    """Insert-ignore into a small unpartitioned table."""
    there = tables.layer_exists(spark, path)
    fresh = staged(new_rows(spark.read.parquet(path), rows, keys) if there else rows, "log-new")
    fresh.write.mode("append" if there else "errorifexists").parquet(path)


def _log(spark: SparkSession, delivered: DataFrame, inserted: DataFrame, path: str) -> None:
    """A row for each batch and symbol with the rows really inserted; 0 is logged once, so a retry adds nothing."""
    entries = staged(ingestion_log(inserted).unionByName(
        ingestion_log(delivered).join(ingestion_log(inserted), list(LOG_KEY), "left_anti").withColumns({
            "rows_ingested": F.lit(0).cast("long"), "start_date": F.lit(None).cast("date"),
            "end_date": F.lit(None).cast("date")})), "log")
    there = tables.layer_exists(spark, path)
    if there:
        empty = new_rows(spark.read.parquet(path), entries.filter("rows_ingested = 0"), LOG_KEY)
        entries = staged(entries.filter("rows_ingested > 0").unionByName(empty), "log-new")
    entries.write.mode("append" if there else "errorifexists").parquet(path)


def ingest(spark: SparkSession, batch: DataFrame, root: str, refetch_days: int = REFETCH_DAYS) -> None:
    """A landing batch into bronze: the log counts insertions, rows past the re-fetch window are noted as late.

    A failed write is logged with its error for every symbol of the batch, and raised.
    """
    bronze, log = f"{root}/bronze", f"{root}/ingestion_log"
    try:
        if tables.layer_exists(spark, f"{root}/silver"):
            marks = zones.newest(spark, f"{root}/silver")
            old = staged(spread_join(batch, marks, ["symbol"], "inner").filter(
                F.date_diff("last_date", "date") >= refetch_days).select(*batch.columns), "old-bars")
            known = tables.touched(spark, bronze, old).select(*BRONZE_KEY)
            late = clean.dedup_first(old, BRONZE_KEY).join(known, list(BRONZE_KEY), "left_anti")
            _store_new(spark, late.select(*batch.columns), f"{root}/late", BRONZE_KEY)
        inserted = tables.append_new(spark, bronze, batch, BRONZE_KEY)
    except Exception as error:
        failure_log(batch, F.col("batch_id"), str(error)[:1000]).write.mode("append").parquet(log)
        raise
    _log(spark, batch, inserted, log)


def _starts(spark: SparkSession, root: str, changed: DataFrame, refetch_days: int) -> DataFrame:
    """Per symbol the first day to compute anew: that of its first bar in the window that silver has not.

    Only sections of bronze that changed since the last run can have such bars. A symbol that silver does not know
    is computed as a whole.
    """
    marks = zones.newest(spark, f"{root}/silver")
    recent = spread_join(zones.rows_in(spark, f"{root}/bronze", changed), marks, ["symbol"], "left").filter(
        F.col("last_date").isNull() | (F.date_diff("last_date", "date") < refetch_days))
    missing = recent.join(zones.rows_in(spark, f"{root}/silver", changed).select(*BAR_KEY), list(BAR_KEY), "left_anti")
    if tables.layer_exists(spark, f"{root}/quarantine"):
        missing = missing.join(spark.read.parquet(f"{root}/quarantine").select(*BAR_KEY), list(BAR_KEY), "left_anti")
    first = F.min(F.when(F.col("last_date").isNotNull(), F.col("date")).otherwise(F.lit(BEGINNING).cast("date")))
    return missing.groupBy("symbol").agg(first.alias("start"))


def _update_silver(spark: SparkSession, root: str, starts: DataFrame, stamp: Column) -> None:
    """Clean bars of the changed symbols from their start on; the newest stored bar before it goes in front."""
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    raw = _from_start(zones.rows_in(spark, bronze, zones.from_date(zones.read(spark, bronze), starts)), starts)
    before = zones.rows_in(spark, silver, zones.newest_before(zones.read(spark, silver), starts))
    rows = staged(_look_back(raw, _from_start(before, starts, before=True)).unionByName(raw), "changed-bars")
    fresh = _from_start(clean.silver(rows), starts).withColumn("processed_at", stamp)
    tables.upsert(spark, silver, fresh, BAR_KEY, keep=("batch_id",))
    _store_new(spark, _from_start(clean.quarantine(rows), starts), f"{root}/quarantine", BAR_KEY)


def _update_gold(spark: SparkSession, root: str, starts: DataFrame, stamp: Column) -> None:
    """Features of the changed symbols from their start on, and targets of stored rows that are known now.

    The prefix values continue from stored rows, so of each symbol only the periods are read that hold the rows the
    frames reach; a symbol with too few stored rows is read as a whole.
    """
    silver, gold = f"{root}/silver", f"{root}/gold"
    needed = indicators.HORIZON + 1 + indicators.HISTORY
    held = staged(zones.last_before(zones.read(spark, gold), starts, needed), "held-sections")
    stored = _from_start(zones.rows_in(spark, gold, held), starts, before=True)
    enough = held.groupBy("symbol").agg(
        F.sum(F.when(F.col("last_date") < F.col("start"), F.col("n")).otherwise(0)).alias("sure"), F.min(PERIOD).alias("since"),
    ).filter(F.col("sure") >= needed).select("symbol", "since")
    wanted = zones.read(spark, silver).join(starts.select("symbol"), "symbol").join(enough, "symbol", "left").filter(
        F.col("since").isNull() | (F.col(PERIOD) >= F.col("since")))
    bars = zones.rows_in(spark, silver, wanted)
    made = staged(indicators.continue_gold(bars, stored).withColumn("computed_at", stamp), "gold-fresh")
    # Stored features stay as they are and known targets are filled in; from a changed day on all is new.
    tables.upsert(spark, gold, _from_start(made, starts, before=True), BAR_KEY, keep=indicators.GOLD_FEATURES)
    tables.upsert(spark, gold, _from_start(made, starts), BAR_KEY)


def run(spark: SparkSession, landing: DataFrame, root: str, run_at: str | None = None,
        refetch_days: int = REFETCH_DAYS) -> None:
    """One layer run: new landing rows into bronze, then silver and gold from the first changed day on.

    Every row of bronze is afterwards in ``silver``, ``quarantine`` (no clean bar can be made of it) or
    ``late`` (older than the re-fetch window when it came). Repeating a run changes only the stamps
    ``processed_at`` and ``computed_at`` of rows it writes again. ``quality_checks`` has the checks of each run.

    The zone maps say which symbols and periods of bronze have changed since the last run that was completed,
    and where the bars and features lie that these need; nothing else of the layers is read. A run that breaks off
    leaves its sections noted as changed, so the next one takes them up again.
    """
    stamp = F.to_timestamp(F.lit(run_at)) if run_at else F.current_timestamp()
    bronze, silver, gold = (f"{root}/{layer}" for layer in ("bronze", "silver", "gold"))
    ingest(spark, staged(landing, "landing"), root, refetch_days)
    seen = staged(zones.read(spark, bronze), "bronze-zones")
    if not tables.layer_exists(spark, silver):
        raw = tables.read_layer(spark, bronze)
        tables.write_layer(clean.silver(raw).withColumn("processed_at", stamp), silver)
        _store_new(spark, clean.quarantine(raw), f"{root}/quarantine", BAR_KEY)
        starts = None
    else:
        sections = staged(zones.changed(spark, seen, f"{root}/seen.silver"), "changed-sections")
        starts = staged(_starts(spark, root, sections, refetch_days), "starts")
        _update_silver(spark, root, starts, stamp)
    zones.note(spark, seen, f"{root}/seen.silver")
    if not tables.layer_exists(spark, gold):
        tables.write_layer(indicators.gold(tables.read_layer(spark, silver)).withColumn("computed_at", stamp), gold)
    else:
        _update_gold(spark, root, _unfinished(spark, root, starts), stamp)
    zones.note(spark, zones.read(spark, silver), f"{root}/seen.gold")
    day = (run_at or "")[:10] or str(spark.range(1).select(F.current_date()).first()[0])
    _store_new(spark, quality.checks_of(zones.counts(spark, silver), day), f"{root}/quality_checks", ("symbol", "check_date", "check_name"))


def _unfinished(spark: SparkSession, root: str, starts: DataFrame | None) -> DataFrame:
    """The starts of this run, and the whole series of symbols that a run left in silver only when it broke off."""
    behind = zones.changed(spark, zones.read(spark, f"{root}/silver"), f"{root}/seen.gold").select("symbol").distinct()
    whole = behind.select("symbol", F.lit(BEGINNING).cast("date").alias("start"))
    if starts is None:
        return staged(whole, "gold-starts")
    return staged(starts.unionByName(whole.join(starts, "symbol", "left_anti")), "gold-starts")


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """Rows in quarantine now: those of which a later run made a clean bar are out."""
    held = spark.read.parquet(f"{root}/quarantine")
    return held.join(tables.read_layer(spark, f"{root}/silver").select(*BAR_KEY), list(BAR_KEY), "left_anti")


def backfill(spark: SparkSession, batch: DataFrame, root: str, run_at: str | None = None) -> None:
    """Rebuild the symbols of a batch in all layers: the batch is their whole history from now on."""
    stamp = F.to_timestamp(F.lit(run_at)) if run_at else F.current_timestamp()
    batch = staged(clean.dedup_first(batch, BRONZE_KEY), "backfill")
    tables.reload(spark, f"{root}/bronze", batch, BRONZE_KEY)
    bars = staged(clean.silver(batch).withColumn("processed_at", stamp), "backfill-silver")
    tables.reload(spark, f"{root}/silver", bars)
    tables.reload(spark, f"{root}/gold", indicators.gold(bars).withColumn("computed_at", stamp))
    for source, seen in (("bronze", "seen.silver"), ("silver", "seen.gold")):
        mine = zones.read(spark, f"{root}/{source}").join(batch.select("symbol").distinct(), "symbol", "left_semi")
        zones.note(spark, mine, f"{root}/{seen}", whole_symbols=True)
    ingestion_log(batch).write.mode("append").parquet(f"{root}/ingestion_log")
