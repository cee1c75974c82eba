"""Exact deduplication by content-defined chunk recipes. Built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from barflow.llm.common import attach_totals, salts
from barflow.session import staged

#: A chunk ends at the first sentence mark or line end after LEAST characters, at MOST characters otherwise.
LEAST, MOST = 256, 4096


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text cut at places that its content decides; joined again, the chunks are the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{{least},{most}}}?[.!?\\n]|(?s).{{1,{most}}}"), F.lit(0))


def hashed(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def _recipes(docs: DataFrame, identify: Callable[[Column], Column]) -> DataFrame:
    """Per document its ordered chunk identifiers; every identifier is checked to stand for one chunk text.

    An identifier is the chunk's 64-bit hash and, for the texts that share a hash, their rank among these.
    Chunk texts are moved once, without repeats of one task; documents are not moved.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = texts.select(F.explode(chunks(F.col("text"))).alias("chunk")).select(
        identify(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = staged(known.groupBy("h").count().filter("count > 1").select("h"), "shared-hashes")
    rows = texts.select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), chunks(F.col("text")).alias("chunks"))
    if shared.isEmpty():
        return rows.select(
            "doc_id", "text_sha256", F.transform("chunks", identify).alias("hashes"),
            F.array().cast("array<int>").alias("ranks"))
    # Count the texts before each one that share its hash: a few rows, as hashes hardly ever meet.
    among = staged(known.join(shared, "h"), "shared-chunks")
    other = among.select("h", F.col("chunk").alias("other"))
    ranked = among.join(other, "h").groupBy("h", "chunk").agg(
        F.sum((F.col("other") < F.col("chunk")).cast("int")).cast("int").alias("rank"))
    plain = rows.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", "text_sha256", F.posexplode_outer("chunks").alias("pos", "chunk"))
    marked = staged(plain.withColumn("h", identify(F.col("chunk"))).join(ranked, ["h", "chunk"], "left"), "marked")
    steps = F.array_sort(F.collect_list(F.when(F.col("h").isNotNull() & F.col("pos").isNotNull(), F.struct(
        "pos", "h", F.coalesce("rank", F.lit(0)).alias("rank")))))
    return marked.groupBy("row", "doc_id", "text_sha256").agg(steps.alias("steps")).select(
        "doc_id", "text_sha256", F.col("steps.h").alias("hashes"), F.col("steps.rank").alias("ranks"))


def exact_dedup(docs: DataFrame, identify: Callable[[Column], Column] = hashed) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks``.

    Texts are equal when their ordered chunk identifiers are. Of equal texts the largest ``doc_id`` stays.
    Null texts count as empty and are equal to empty texts. A null ``doc_id`` is smaller than any other; a
    group of such rows only has a null ``keep_id`` and keeps them. Rows repeated with the same id are one
    document: all of them carry the same answer. Extra columns are ignored; an empty table gives no rows.

    Groups are salted, so a group with a third of all rows is counted and answered by many tasks.
    """
    rows = staged(_recipes(docs, identify), "recipes")
    answered = attach_totals(
        rows, ["hashes", "ranks"], F.struct("doc_id"), salts(rows.count()),
        {"keep_id": F.max("doc_id"), "group_size": F.count(F.lit(1))},
        {"keep_id": F.max("keep_id"), "group_size": F.sum("group_size")})
    return answered.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256", F.size("hashes").cast("long").alias("n_chunks"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; of rows repeated with id and text, one stays.

    Which of these is not determined where their other columns differ (of columns that can be ordered, it is the
    row with the least values).
    """
    found = staged(exact_dedup(docs), "copies")
    with_hash = docs.withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_gone")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_gone"))
    left = with_hash.join(gone, same, "left_anti")
    twice = staged(found.filter("kept").groupBy("doc_id", "text_sha256").count().filter("count > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_gone")), "repeated")
    if twice.isEmpty():
        return left.select(*docs.columns)
    single = left.join(twice, same, "left_anti").select(*docs.columns)
    # The least row of each task, then of all: maps have no order, so they travel along and do not count.
    ordered = [f.name for f in docs.schema.fields if f.name not in ("doc_id", "text") and not _unordered(f.dataType)]
    repeated = left.join(twice, same, "left_semi").groupBy("doc_id", "_sha").agg(F.min_by(
        F.struct(*docs.columns), F.struct(F.lit(0), *[F.col(f"`{c}`") for c in ordered])).alias("row"))
    return single.unionByName(repeated.select("row.*"))


def _unordered(kind: DataType) -> bool:
    """Whether values of a type cannot be compared: maps, variants, and what holds one."""
    return any(word in kind.simpleString() for word in ("map<", "variant", "void"))
