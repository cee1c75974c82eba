"""Exact top-k search by inner product: global score histograms are refined until they give each kth value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barflow.session import staged, work_dir

#: Components are scaled by this and rounded down.
SCALE = 1024
#: Vector bytes of a block of rows; bytes of the vectors and histograms of the queries that are searched at a time.
BLOCK_BYTES, GROUP_BYTES = 2 << 20, 128 << 20
#: Bins of a histogram, and scores held at a time.
BINS, TILE = 2048, 1 << 20
#: Scores are saturated to the ends of a long.
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Components and squared lengths are held below this, far beyond any score.
HUGE = 1e300

_SCHEMA = pa.schema([("block", pa.int64()), ("width", pa.int32()), ("wide", pa.bool_()), ("n", pa.int64()), ("longest", pa.float64()),
                     ("ids", pa.binary()), ("vectors", pa.binary()), ("is_query", pa.binary())])
_BLOCK = "block bigint, width int, wide boolean, n bigint, longest double, ids binary, vectors binary, is_query binary"
_HIT = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 x) of rows of doubles; whole numbers of 32 bits, or doubles if one needs more."""
    with np.errstate(over="ignore"):
        out = np.clip(np.floor(vectors.astype(np.float64) * SCALE), -HUGE, HUGE)
    return out if out.size and np.abs(out).max() >= 2.0 ** 31 else out.astype(np.int32)


def _packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors that take part, packed by their length; a row of the result has the rows of one block."""
    number = TaskContext.get().partitionId() << 24
    for batch in batches:
        lists, ids = batch.column("embedding"), batch.column("vec_id").cast(pa.int64())
        values = np.asarray(lists.flatten().cast(pa.float64()).fill_null(np.nan))
        sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), -1)).astype(np.int64)
        begin = np.concatenate(([0], np.cumsum(np.maximum(sizes, 0))))[:-1]
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
        whole = (sizes >= 0) & (bad[begin + np.maximum(sizes, 0)] == bad[begin]) & np.asarray(ids.is_valid())
        id_of, query = np.asarray(ids.fill_null(0)), np.asarray(batch.column("is_query").fill_null(False))
        for width in np.unique(sizes[whole]).tolist():
            at = np.flatnonzero(whole & (sizes == width))
            step = max(1, BLOCK_BYTES // (8 * max(width, 1)))
            for a in range(0, len(at), step):
                mine = at[a: a + step]
                matrix = scaled(values[begin[mine][:, None] + np.arange(width)].reshape(len(mine), width))
                with np.errstate(over="ignore"):
                    longest = min(float((matrix.astype(np.float64) ** 2).sum(axis=1).max()), HUGE)
                yield pa.RecordBatch.from_pylist([{
                    "block": number, "width": width, "wide": matrix.dtype == np.float64, "n": len(mine), "longest": longest,
                    "ids": id_of[mine].tobytes(), "vectors": np.ascontiguousarray(matrix).tobytes(),
                    "is_query": query[mine].tobytes()}], schema=_SCHEMA)
                number += 1


class Block:
    """Rows of a packed block: ``ids``, ``is_query``, ``matrix``, and ``rows``, their numbers in the whole table."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.is_query = np.frombuffer(row["is_query"], bool)
        self.matrix = np.frombuffer(row["vectors"], np.float64 if row["wide"] else np.int32).reshape(len(self.ids), row["width"])
        self.rows = (np.int64(row["block"]) << np.int64(20)) + np.arange(len(self.ids))


class Queries:
    """A group of queries of one length, each with the range of scores in which its kth value lies.

    The range of an open query is the ``span`` values from ``low`` on, in bins of ``step``, and ``need`` says which
    score, counted from the top of the range, is the kth of all. A settled query has its kth value in ``low``.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, matrix: np.ndarray, k: int, longest: float, candidates: int):
        self.ids, self.rows, self.matrix, self.k = ids, rows, matrix, k
        bound = int(longest * 1.000001) + 1  # no score is larger in size (Cauchy-Schwarz)
        self.exact = bound < 1 << 53  # doubles hold every sum
        bound = min(bound, MOST)
        few = candidates <= k  # all of them are answers
        self.low = [LEAST if few else -bound] * len(ids)
        self.span = [2 * bound + 1] * len(ids)
        self.need = [k] * len(ids)
        self.open = [not few] * len(ids)

    def refine(self, found: dict[int, tuple[int, int]]) -> None:
        """Go on in the bin that holds the kth value: (bin, scores above that bin) of each open query."""
        for i, (at, above) in found.items():
            step = self.step(i)
            self.low[i] += at * step
            self.need[i] -= above
            self.span[i] = min(step, self.span[i] - at * step)
            self.open[i] = self.span[i] > 1

    def step(self, i: int) -> int:
        return -(-self.span[i] // BINS)

    def scores(self, at: np.ndarray, block: Block) -> np.ndarray:
        """Exact scores of some queries (rows) with a block's vectors (columns)."""
        mine, other = self.matrix[at], block.matrix
        if self.exact:
            return (mine.astype(np.float64) @ other.T.astype(np.float64)).astype(np.int64)
        # Sums that doubles do not hold: whole numbers of any size, for such vectors alone.
        one, two = ([[int(x) for x in r] for r in m.tolist()] for m in (mine, other))
        full = [[min(max(sum(map(int.__mul__, a, b)), LEAST), MOST) for b in two] for a in one]
        return np.array(full, np.int64).reshape(len(one), len(two))

    def tiles(self, batches: Iterator[pa.RecordBatch], at: np.ndarray) -> Iterator[tuple[np.ndarray, Block, np.ndarray]]:
        """Scores of some queries with all rows, some at a time."""
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                step = max(1, TILE // max(1, len(block.ids)))
                for a in range(0, len(at), step):
                    yield at[a: a + step], block, self.scores(at[a: a + step], block)

    def others(self, part: np.ndarray, block: Block, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (query in the tile, vector) of hits, without a query's own row."""
        one, two = np.nonzero(hit)
        keep = self.rows[part[one]] != block.rows[two]
        return one[keep], two[keep]


def _histograms(sent):
    """Counts by bin of the scores inside each open query's range.

    A task leaves out the bins below its own kth value: the kth value of all rows is no lower, so their counts
    are not needed. That bounds what is shuffled by k, or by BINS if that is less, for each query and task.
    """

    def run(batches):
        group: Queries = sent.value
        at = np.flatnonzero(group.open)
        low, need = (np.array(x, np.int64)[at] for x in (group.low, group.need))
        step, last = (np.array(x, np.uint64) for x in zip(*[(group.step(i), group.span[i] - 1) for i in at]))
        counts = np.zeros((len(at), BINS), np.int64)
        least = np.zeros(len(at), np.int64)  # bin of the task's own kth value
        place = np.zeros(len(group.ids), np.int64)
        place[at] = np.arange(len(at))
        for part, block, scores in group.tiles(batches, at):
            mine = place[part]
            one, two = group.others(part, block, scores >= (low[mine] + least[mine] * step[mine].view(np.int64))[:, None])
            query = mine[one]
            over = (scores[one, two] - low[query]).view(np.uint64)
            inside = over <= last[query]
            cell = one[inside] * BINS + (over[inside] // step[query[inside]]).astype(np.int64)
            if len(cell):
                counts[mine] += np.bincount(cell, minlength=len(mine) * BINS).reshape(len(mine), BINS)
                upto = np.cumsum(counts[mine, ::-1], axis=1) >= need[mine][:, None]
                least[mine] = np.where(upto[:, -1], BINS - 1 - np.argmax(upto, axis=1), 0)
        counts[np.arange(BINS)[None, :] < least[:, None]] = 0
        query, bins = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at[query]), pa.array(bins), pa.array(counts[query, bins])],
                                         names=["query", "bin", "n"])

    return run


def _hits(sent):
    """The rows that score more than the kth value, and of those that score it the task's first k by id."""

    def run(batches):
        group: Queries = sent.value
        low = np.array(group.low, np.int64)
        ties: dict[int, np.ndarray] = {}
        for part, block, scores in group.tiles(batches, np.arange(len(group.ids))):
            one, two = group.others(part, block, scores >= low[part][:, None])
            query, ids, value = part[one], block.ids[two], scores[one, two]
            more = value > low[query]
            if more.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[more]) for x in (query, ids, value)], schema=_HIT)
            query, ids = query[~more], ids[~more]
            begin = np.flatnonzero(np.diff(np.concatenate(([-1], query)))).tolist()
            for a, b in zip(begin, [*begin[1:], len(query)]):
                i = int(query[a])
                ties[i] = np.sort(np.concatenate((ties.get(i, ids[:0]), ids[a:b])))[: group.k]
        for i, ids in ties.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), i)), pa.array(ids), pa.array(np.full(len(ids), low[i]))], schema=_HIT)

    return run


def _kth_bins(counts: DataFrame, group: Queries) -> dict[int, tuple[int, int]]:
    """For each open query the bin of its kth value and the scores above that bin: one row a query of the group."""
    at = [i for i, o in enumerate(group.open) if o]
    need = counts.sparkSession.createDataFrame(
        pa.table({"query": pa.array(at, pa.int64()), "need": pa.array([group.need[i] for i in at], pa.int64())}))
    down = Window.partitionBy("query").orderBy(F.desc("bin"))
    summed = counts.groupBy("query", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down))
    rows = summed.join(F.broadcast(need), "query").filter("upto >= need AND upto - n < need").select(
        "query", "bin", (F.col("upto") - F.col("n")).alias("above")).collect()
    return {r["query"]: (r["bin"], r["above"]) for r in rows}


def _search(spark: SparkSession, blocks: DataFrame, group: Queries) -> DataFrame:
    """The answers to one group of queries. Each pass reads the blocks once and sends the group to the tasks."""
    while any(group.open):
        sent = spark.sparkContext.broadcast(group)  # bounded by GROUP_BYTES
        group.refine(_kth_bins(blocks.mapInArrow(_histograms(sent), "query bigint, bin bigint, n bigint"), group))
        sent.unpersist()
    sent = spark.sparkContext.broadcast(group)
    hits = staged(blocks.mapInArrow(_hits(sent), "query bigint, vec_id bigint, score bigint"), "top-k-hits")
    sent.unpersist()
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    names = spark.createDataFrame(pa.table({"query": pa.array(range(len(group.ids)), pa.int64()), "query_id": pa.array(group.ids)}))
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= group.k).join(
        F.broadcast(names), "query").select("query_id", "rank", "vec_id", "score")


def _queries_of(batches):
    """The queries of each block, packed as blocks are."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            at = np.flatnonzero(block.is_query)
            if len(at):
                yield pa.RecordBatch.from_pylist([{
                    "ids": block.ids[at].tobytes(), "rows": block.rows[at].tobytes(), "wide": row["wide"],
                    "vectors": block.matrix[at].tobytes()}])


def _groups(blocks: DataFrame, group_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Queries in groups of about ``group_bytes``: the driver reads partition after partition and holds one group."""
    asked = staged(blocks.mapInArrow(_queries_of, "ids binary, rows binary, wide boolean, vectors binary"), "queries")
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    for row in asked.toLocalIterator():
        ids, rows = (np.frombuffer(row[c], np.int64) for c in ("ids", "rows"))
        held.append((ids, rows, np.frombuffer(row["vectors"], np.float64 if row["wide"] else np.int32).reshape(len(ids), -1)))
        size += held[-1][2].nbytes + 8 * BINS * len(ids)
        if size >= group_bytes:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows that score highest for each query; all, if there are fewer.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` marks the rows that are queries as well. The score
    is the inner product of the components floor(1024 x); a row is no candidate for itself. Ties go to the
    smaller id. Vectors that are null, or hold a null or a component that is no finite number, take no part, nor
    does a row without an id. Vectors of different lengths are not compared; those of length 0 score 0. Every
    row is a query or candidate of its own, repeated ids included: a repeated query has one list of ranks a row.
    Scores beyond a long are saturated to its ends. Extra columns are ignored; an empty table gives no rows.

    Vectors are packed once and do not move after that. Queries are searched in groups of ``group_bytes``, so
    what is sent to the tasks does not grow with the table. A pass scores everything and counts the scores by bin
    of each query's open range; the bin that holds the kth value is the next range (2,048 times narrower), until
    it is one value wide. Then the rows at or above it are filtered, and ties cut by id, first in the tasks and
    then over all of them. Scores are not kept between passes.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("is_query"))
    blocks = staged(rows.mapInArrow(_packed_rows, _BLOCK), "vectors")
    widths = blocks.groupBy("width").agg(F.sum("n").alias("n"), F.max("longest").alias("longest")).orderBy("width")
    path = work_dir(spark, "top-k")
    spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint").write.parquet(path)
    for of in widths.toLocalIterator():
        same = blocks.filter(F.col("width") == of["width"])
        for ids, places, matrix in _groups(same, group_bytes):
            group = Queries(ids, places, matrix, k, of["longest"], of["n"] - 1)
            _search(spark, same, group).write.mode("append").parquet(path)
    return spark.read.schema("query_id bigint, rank int, vec_id bigint, score bigint").parquet(path)
