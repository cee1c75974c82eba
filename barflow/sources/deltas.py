"""Changes of a layer kept beside it: an upsert or a reload writes its own rows, and readers merge them.

The layer's folder holds the base; ``<layer>.deltas`` holds changed rows by period, each with the version of its
write, the names of the key, and whether the row is deleted. Of a key the newest version counts, before the base.
A write is one append, so it is there as a whole or not at all. Compaction writes the merged rows of the changed
periods into the base and removes the deltas; broken off between the two, it leaves deltas that say what the
base says already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.session import staged

PERIOD = "period"
VERSION, DELETED, KEYS = "_version", "_deleted", "_keys"
#: Deltas are compacted once they have this share of the rows of their periods, or this many versions.
SHARE, VERSIONS = 0.2, 20


def deltas_path(layer: str) -> str:
    return f"{layer.rstrip('/')}.deltas"


def readable(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path; None where nothing was written, or only an empty table by periods."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _state(changes: DataFrame) -> tuple[int, list[str]]:
    """Newest version and key of the deltas."""
    row = changes.agg(F.max(F.struct(VERSION, KEYS)).alias("m")).first()["m"]
    return row[VERSION], row[KEYS].split(",")


def _newest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest change of each key; a filter on the period reaches the scan."""
    rest = [c for c in changes.columns if c not in (*keys, PERIOD)]
    return changes.groupBy(*keys, PERIOD).agg(F.max_by(F.struct(*rest), VERSION).alias("_row")).select(*keys, PERIOD, "_row.*")


def current(spark: SparkSession, layer: str) -> DataFrame:
    """The rows of a layer with ``period``: its base without the changed keys, and their newest state.

    Changes are few against the base, so Spark broadcasts their keys where their size allows it, and the base is
    neither shuffled nor sorted then.
    """
    base, changes = spark.read.parquet(layer), readable(spark, deltas_path(layer))
    if changes is None:
        return base
    keys = [*_state(changes)[1], PERIOD]
    newest = _newest(changes, keys[:-1])
    kept = base.join(newest.select(*keys), keys, "left_anti").select(*base.columns)
    return kept.unionByName(newest.filter(~F.col(DELETED)).select(*base.columns))


def write(spark: SparkSession, layer: str, rows: DataFrame, keys: Sequence[str], gone: DataFrame | None = None) -> None:
    """One more version: rows to insert or replace, and keys (with their period) to delete."""
    changes = readable(spark, deltas_path(layer))
    version = 1 if changes is None else _state(changes)[0] + 1
    marked = rows.withColumn(PERIOD, F.year("date")).withColumn(DELETED, F.lit(False))
    if gone is not None:
        marked = marked.unionByName(gone.select(*keys).withColumn(PERIOD, F.year("date")).withColumn(DELETED, F.lit(True)), allowMissingColumns=True)
    marked.withColumns({VERSION: F.lit(version), KEYS: F.lit(",".join(keys))}).hint("rebalance", F.col(PERIOD)).sortWithinPartitions(
        PERIOD, *keys).write.mode("append").partitionBy(PERIOD).parquet(deltas_path(layer))


def due(spark: SparkSession, layer: str, zones: DataFrame, share: float = SHARE, versions: int = VERSIONS) -> bool:
    """Whether the deltas have grown enough to be compacted; ``zones`` has ``period`` and row counts ``n``."""
    changes = readable(spark, deltas_path(layer))
    if changes is None:
        return False
    counts = changes.groupBy(PERIOD).agg(F.count(F.lit(1)).alias("changed"), F.max(VERSION).alias("version"))
    whole = zones.groupBy(PERIOD).agg(F.sum("n").alias("n"))
    row = counts.join(whole, PERIOD, "left").agg(F.sum("changed").alias("changed"), F.sum("n").alias("n"), F.max("version").alias("version")).first()
    return row["version"] >= versions or row["changed"] >= share * (row["n"] or 0)


def compact(spark: SparkSession, layer: str) -> None:
    """Write the merged rows of the changed periods into the base, and remove the deltas. No row changes."""
    changes = readable(spark, deltas_path(layer))
    if changes is None:
        return
    periods = sorted(r[0] for r in changes.select(PERIOD).distinct().collect())
    rows = staged(current(spark, layer).filter(F.col(PERIOD).isin(periods)), "compacted")
    rows.hint("rebalance", F.col(PERIOD)).sortWithinPartitions(PERIOD, "symbol", "date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(layer)
    for empty in set(periods) - {r[0] for r in rows.select(PERIOD).distinct().collect()}:
        delete(spark, f"{layer}/{PERIOD}={empty}")
    delete(spark, deltas_path(layer))
