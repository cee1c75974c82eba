"""Landing files: explicit schema in, normalised bars out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.schemas import BARS
from barflow.session import staged

# Provider column names and ours.
PROVIDER_COLUMNS = {
    "Date": "date", "Open": "open", "High": "high", "Low": "low", "Close": "close",
    "Adj Close": "adj_close", "Volume": "volume",
}
REFETCH_DAYS = 7


def read_bars(
    spark: SparkSession, path: str, fmt: str = "parquet", start: str | None = None,
    end: str | None = None, symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Bars from landing files (parquet, csv or json) with inclusive optional date bounds."""
    reader = spark.read.schema(BARS)
    if fmt == "csv":
        reader = reader.option("header", True)
    return prices_between(reader.format(fmt).load(path), start, end, symbols)


def read_delivery(spark: SparkSession, path: str, fmt: str) -> tuple[DataFrame, DataFrame]:
    """Bars of csv or json files, and the rejected records: those with a field that is not of its type.

    A rejected record has its text in ``record`` and null in the fields that could not be read.
    """
    rows = (
        spark.read.schema(f"{BARS}, record string").option("columnNameOfCorruptRecord", "record")
        .option("header", fmt == "csv").format(fmt).load(path)
    )
    rows = staged(rows, "delivery")  # the record is only known to a reader of all fields
    return rows.filter("record IS NULL").drop("record"), rows.filter("record IS NOT NULL")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def prices_between(
    bars: DataFrame, start: str | None = None, end: str | None = None,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Bars of some symbols between two dates, both inclusive and optional."""
    if symbols is not None:
        bars = bars.filter(F.col("symbol").isin(list(symbols)))
    if start is not None:
        bars = bars.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        bars = bars.filter(F.col("date") <= F.lit(end).cast("date"))
    return bars


def refetch_window(bars: DataFrame, run_date: str, days: int = REFETCH_DAYS) -> DataFrame:
    """Bars of the last ``days`` days before the run date."""
    run = F.lit(run_date).cast("date")
    return bars.filter((F.col("date") >= F.date_sub(run, days)) & (F.col("date") < run))


def normalise_columns(df: DataFrame) -> DataFrame:
    """Provider column names to ours, the day as a date, rows without any price dropped."""
    renamed = df.withColumnsRenamed(PROVIDER_COLUMNS).withColumn("date", F.to_date("date"))
    return renamed.dropna("all", subset=["open", "high", "low", "close"])


def wide_to_long(wide: DataFrame, symbols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per symbol and day from columns named ``<symbol>_<field>``.

    Symbols without their columns are skipped, and so are days on which a symbol has no value.
    """
    present = [s for s in symbols if all(f"{s}_{f}" in wide.columns for f in fields)]
    if not present:
        raise ValueError("none of the symbols has columns in the wide frame")
    entries = [
        F.struct(F.lit(s).alias("symbol"), *[F.col(f"`{s}_{f}`").alias(f) for f in fields])
        for s in present
    ]
    return (
        wide.select("date", F.explode(F.array(*entries)).alias("e"))
        .select("e.symbol", "date", *[f"e.{f}" for f in fields])
        .dropna("all", subset=list(fields))
    )
