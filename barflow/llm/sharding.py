"""Shards of documents of near equal bytes by histogram sort. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.session import staged, work_dir

#: Hash digits of a key: 60 bits each of the text and of the id.
KEY_BITS = 60
#: Bits resolved by one counting pass: at most 4,096 counts for each unresolved splitter.
STEP_BITS = 12
#: Bytes that each row costs besides its text.
ROW_BYTES = 16
#: A splitter may miss its target by this share of a shard to leave a group of equal texts whole.
TOLERANCE_PERCENT = 1


def hash60(column: Column) -> Column:
    return F.conv(F.substring(F.sha2(column, 256), 1, 15), 16, 10).cast("long")


def size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + F.lit(ROW_BYTES)).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """Each row whole, as ``document``, with its size and sort key: equal texts are neighbours, ordered by their ids' hashes."""
    return docs.select(
        F.struct("*").alias("document"),
        size(F.col("text")).alias("size"),
        hash60(F.coalesce(F.col("text"), F.lit(""))).alias("k1"),
        hash60(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("k2"))


def sized(docs: DataFrame) -> DataFrame:
    """Id, size and sort key of each row, which is all that the splitters need."""
    return keyed(docs).select("document.doc_id", "size", "k1", "k2")


def _histogram(rows: DataFrame, level: str, done: int, bins: set[int], within: set[int]) -> list:
    """Exact bytes in the next finer bins of ``level``, inside the given coarser bins (and keys k1)."""
    at = rows if level == "k1" else rows.filter(F.col("k1").isin(sorted(within)))
    if done:
        at = at.filter(F.shiftright(level, KEY_BITS - done).isin(sorted(bins)))
    group = [F.shiftright(level, KEY_BITS - done - STEP_BITS).alias("bin")]
    if level == "k2":
        group.append(F.col("k1"))
    return at.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min(level).alias("low"), F.max(level).alias("high")).collect()


def splitters(rows: DataFrame, n_shards: int, tolerance_percent: int = TOLERANCE_PERCENT) -> list[tuple[int, int, int]]:
    """The first places (k1, k2, number) of shards 1 to n - 1; rows with equal keys are numbered from 0.

    Each pass counts exact bytes in up to 4,096 bins inside the bins that still hold a splitter's target, so
    it narrows every splitter by 12 bits; a few passes over the narrow key columns end it. A bin with one text
    left is a group of copies: the splitter takes its nearer end if that is within the tolerance, and otherwise
    goes on through the ids' hashes to the row end nearest to the target. Rows with both keys equal have equal
    texts, so the number of the row at which they are cut follows from their count.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    found: dict[int, tuple[int, int, int]] = {}
    # target number -> bytes before its bin, and the bin it lies in, by level
    open_: dict[int, dict] = {k: {"before": 0, "level": "k1", "done": 0, "bin": 0, "k1": None}
                              for k in range(1, n_shards)}
    if not total:
        return [(1 << KEY_BITS, 0, 0)] * (n_shards - 1)
    while open_:
        for level, done in sorted({(s["level"], s["done"]) for s in open_.values()}):
            mine = {k: s for k, s in open_.items() if (s["level"], s["done"]) == (level, done)}
            counted = _histogram(rows, level, done, {s["bin"] for s in mine.values()}, {s["k1"] for s in mine.values()})
            inside: dict[tuple, list] = {}
            for r in sorted(counted, key=lambda r: r["low"]):
                inside.setdefault((r["k1"] if level == "k2" else None, r["low"] >> (KEY_BITS - done)), []).append(r)
            for k, s in mine.items():
                before = s["before"]
                for r in inside[(s["k1"], s["bin"])]:
                    if k * total < n_shards * (before + r["bytes"]):
                        break
                    before += r["bytes"]
                edge = lambda key: (key, 0, 0) if level == "k1" else (s["k1"], key, 0)
                left, right = k * total - n_shards * before, n_shards * (before + r["bytes"]) - k * total
                if left <= 0:
                    found[k] = edge(r["low"])
                elif r["low"] < r["high"]:
                    s |= {"before": before, "done": done + STEP_BITS, "bin": r["low"] >> (KEY_BITS - done - STEP_BITS)}
                elif level == "k1" and 100 * min(left, right) <= tolerance_percent * total:
                    found[k] = edge(r["low"] if left <= right else r["low"] + 1)
                elif level == "k2":
                    row = n_shards * r["bytes"] // r["n"]
                    found[k] = (s["k1"], r["low"], max(0, -(-(2 * left - row) // (2 * row))))
                else:
                    s |= {"before": before, "level": "k2", "done": 0, "bin": 0, "k1": r["low"]}
            open_ = {k: s for k, s in open_.items() if k not in found}
    return [found[k] for k in range(1, n_shards)]


def _with_numbers(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``keyed(docs)`` and the keys alone, both with ``number``: 0, or a row's place among the rows of equal keys.

    Only repeated rows need one. They are staged, as their places must not change between two readings; a task
    numbers those that lie together, and adds what lies before them.
    """
    both = ["k1", "k2"]
    zero = F.lit(0).cast("long").alias("number")
    repeated = staged(keys.groupBy(*both).count().filter("count > 1").select(*both), "repeated-keys")
    if repeated.isEmpty():
        return keyed(docs).select("*", zero), keys.select(*both, zero)
    rows = staged(keyed(docs).join(repeated, both, "left_semi").withColumn("at", F.monotonically_increasing_id()), "repeated-rows")
    parts = rows.withColumn("part", F.shiftright("at", 33))
    before = parts.groupBy(*both, "part").count().selectExpr(
        *both, "part", "sum(count) OVER (PARTITION BY k1, k2 ORDER BY part) - count AS before")
    numbered = parts.selectExpr("*", "row_number() OVER (PARTITION BY k1, k2, part ORDER BY at) - 1 AS inside").join(
        before, [*both, "part"]).withColumn("number", F.col("before") + F.col("inside"))
    numbered = staged(numbered.select("document", "size", *both, "number"), "numbered-rows")
    plain = keyed(docs).join(repeated, both, "left_anti").select("*", zero)
    return (plain.select("document", "size", *both, "number").unionAll(numbered),
            keys.join(repeated, both, "left_anti").select(*both, zero).unionAll(numbered.select(*both, "number")))


def shard_documents(docs: DataFrame, n_shards: int, tolerance_percent: int = TOLERANCE_PERCENT,
                    piece_rows: int = 250_000, piece_bytes: int = 64 << 20) -> DataFrame:
    """``shard, slot, document``: every row of ``docs`` with all its columns, placed in its shard.

    Shards are key ranges of near equal bytes: each end lies within one row, or within the tolerance where
    that leaves equal texts together. A hot group of copies is split where it exceeds that, also one of rows
    repeated with their id. Null texts have no bytes and group with empty ones; null ids sort by the hash of an
    empty id. An empty table gives no rows.

    Narrow keys are staged for the splitters and for the rows before each piece. The documents themselves are
    read after that and move once, in pieces of a shard small enough for a task; a slot is the piece's offset
    plus the place in the piece.
    """
    keys = staged(sized(docs).select("size", "k1", "k2"), "shard-keys")
    ends = splitters(keys, n_shards, tolerance_percent)
    bounds = F.array(*[F.struct(*[F.lit(x).cast("long").alias(c) for x, c in zip(end, "abc")]) for end in ends])
    here = F.struct(F.col("k1").alias("a"), F.col("k2").alias("b"), F.col("number").alias("c"))
    shard = F.size(F.filter(bounds, lambda s: s <= here)) if ends else F.lit(0)
    n_rows, n_bytes = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    n_pieces = max(4, -(-n_rows // (n_shards * piece_rows)), -(-n_bytes // (n_shards * piece_bytes)))
    rows, places = _with_numbers(docs, keys)

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("shard", shard.cast("int")).withColumn(
            "piece", F.pmod(F.col("k2") + F.col("number"), F.lit(n_pieces)).cast("int"))

    offsets = placed(places).groupBy("shard", "piece").count().selectExpr(
        "shard", "piece", "sum(count) OVER (PARTITION BY shard ORDER BY piece) - count AS offset")
    inside = placed(rows).selectExpr(
        "shard", "piece", "document", "row_number() OVER (PARTITION BY shard, piece ORDER BY k1, k2, number) - 1 AS place")
    return inside.join(offsets, ["shard", "piece"]).selectExpr("shard", "offset + place AS slot", "document")


def write_shards(docs: DataFrame, n_shards: int, path: str, tolerance_percent: int = TOLERANCE_PERCENT) -> DataFrame:
    """``shard_documents`` written to ``path``, a folder for each shard, and read back from there."""
    shards = shard_documents(docs, n_shards, tolerance_percent)
    shards.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(shards.schema).parquet(path)


def shard_by_bytes(docs: DataFrame, n_shards: int, tolerance_percent: int = TOLERANCE_PERCENT) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of the documents in written shards, law ``bytes``.

    Size and checksum are those of the text that lies in the shard.
    """
    shards = write_shards(docs, n_shards, work_dir(docs.sparkSession, "shards"), tolerance_percent)
    text = F.coalesce(F.col("document.text"), F.lit(""))
    return shards.select(
        "document.doc_id", size(text).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
