"""The trie of conversation prefixes, its subtree totals passed upwards by time-forward processing."""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.common import attach_totals, lookup, salts
from barflow.session import staged

#: Turns whose digests are chained in one go; longer conversations chain the digests of such buckets.
BUCKET = 64
#: Depths of a segment: a shard never spans two.
SEGMENT = 1024
#: A node with more conversations than this is a shard root of its own, and its children begin shards.
HEAVY = 10_000
#: Messages that a priority queue holds in memory.
HELD = 200_000

ROOT = hashlib.sha256(b"").digest()[:16]


# ---------------------------------------------------------------- turns in order

def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each conversation within a sorted partition."""
    part, conv, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        at = []
        for c in batch.column("conv_id").to_pylist():
            seen = seen + 1 if c == conv else 0
            conv = c
            at.append(seen)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64()), pa.array([part] * len(at), pa.int32())],
                                         names=[*batch.schema.names, "at", "part"])


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, digest, size``: each turn's place in its conversation, digest of role and text, code points.

    Turns are ordered by ``turn`` (null first), ties by the digest. Rows are sorted by ranges of conversation and
    turn, so the turns of one conversation may lie in many tasks; these number their own, and add what the
    tasks before them hold of the conversation, which is known for the conversations at a range's ends only.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    narrow = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.substring(F.unhex(F.sha2(named, 256)), 1, 16).alias("digest"), F.length(text).cast("bigint").alias("size"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    rows = staged(narrow.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _numbered, "conv_id bigint, turn bigint, digest binary, size bigint, at bigint, part int"), "turns")
    held = rows.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    ends = held.select(F.explode(F.array("low", "high")).alias("conv_id")).distinct()  # two a task at most
    counts = rows.join(F.broadcast(ends), "conv_id").groupBy("conv_id", "part").count()
    before = counts.withColumn("before", F.sum("count").over(
        Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).filter("before > 0")
    return rows.join(F.broadcast(before.select("conv_id", "part", "before")), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "digest", "size")


def with_openings(turns: DataFrame, base: Column, n_head: Column) -> DataFrame:
    """Conversations rebuilt: the first turns of another one, then the own turns behind as many.

    ``base`` and ``n_head`` give, from ``conv_id``, the conversation that lends its first turns, and how many.
    All of them are taken if it has fewer, none if there is no such conversation. The result has a row for each
    rebuilt turn, and one with ``at`` -1 for each conversation, so that one without turns is kept as well; ``length``
    is the number of turns of the row's conversation.
    """
    counts = staged(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversations")
    n = salts(turns.count())
    lent = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    wanted = counts.select("conv_id", "n", base.alias("base"), n_head.cast("bigint").alias("h"))
    known = staged(lookup(wanted, lent, ["base"], F.col("conv_id"), n, "left").withColumn(
        "taken", F.least("h", F.coalesce("n_base", F.lit(0)))).select(
        "conv_id", "base", "h", "taken", F.expr("taken + greatest(n - h, 0)").alias("length")), "openings")
    out = ["conv_id", "at", "digest", "size", "length"]
    most = known.agg(F.max("taken")).first()[0] or 0
    heads = turns.filter(F.col("at") < most).withColumnRenamed("conv_id", "base")
    gaps = known.filter("taken > 0").select("conv_id", "base", "length", F.explode(F.expr("sequence(0, taken - 1)")).alias("at"))
    begun = lookup(gaps, heads, ["base", "at"], F.col("conv_id"), n).select(*out)
    own = lookup(turns, known.select("conv_id", "h", "taken", "length"), ["conv_id"], F.col("at"), n).filter("at >= h").withColumn(
        "at", F.expr("at - h + taken")).select(*out)
    top = known.select("conv_id", F.lit(-1).cast("bigint").alias("at"), F.lit(None).cast("binary").alias("digest"),
                       F.lit(0).cast("bigint").alias("size"), "length")
    return begun.unionByName(own).unionByName(top)


# ---------------------------------------------------------------- digests of prefixes

def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the digests of each bucket of a conversation, in a sorted partition."""
    last, chain = None, b""
    for batch in batches:
        chained = []
        for conv, bucket, digest in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "bucket", "digest"))):
            if (conv, bucket) != last:
                last, chain = (conv, bucket), b""
            chain = hashlib.sha256(chain + digest).digest()[:16]
            chained.append(chain)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chained, pa.binary())], names=[*batch.schema.names, "chain"])


def prefix_digests(turns: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``turns`` (conv_id, at, digest and further columns) with ``id``, a digest of all turns up to and with each one.

    Equal sequences of turns, and no others, get equal ids. The turns of a bucket are chained one by one; what lies
    before a bucket is the prefix digest in the sequence of whole buckets, which is ``bucket`` times shorter. So
    a long conversation is never in one task.
    """
    names = [c for c in turns.columns if c not in ("conv_id", "at", "digest")]
    cut = turns.withColumn("bucket", F.floor(F.col("at") / bucket).cast("bigint"))
    rows = staged(cut.repartition("conv_id", "bucket").sortWithinPartitions("conv_id", "at").select(
        "conv_id", "bucket", "at", "digest", *names).mapInArrow(_chained, ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in cut.select("conv_id", "bucket", "at", "digest", *names).schema)
        + ", chain binary"), "chains")
    full = rows.filter(F.col("at") % bucket == bucket - 1)
    if full.isEmpty():
        joined, begin, close = rows, F.lit(ROOT), F.lit(None).cast("binary")
    else:
        whole = staged(prefix_digests(full.select("conv_id", F.col("bucket").alias("at"), F.col("chain").alias("digest")), bucket), "buckets")
        known = whole.select("conv_id", (F.col("at") + 1).alias("bucket"), F.col("id").alias("begin"))
        closing = whole.select("conv_id", F.col("at").alias("bucket"), F.col("id").alias("close"))
        joined = rows.join(known, ["conv_id", "bucket"], "left").join(closing, ["conv_id", "bucket"], "left")
        begin, close = F.coalesce("begin", F.lit(ROOT)), F.when(F.col("at") % bucket == bucket - 1, F.col("close"))
    sealed = F.substring(F.unhex(F.sha2(F.concat(begin, F.col("chain")), 256)), 1, 16)
    return joined.select("conv_id", "at", "digest", *names, F.coalesce(close, sealed).alias("id"))


# ---------------------------------------------------------------- time-forward processing

class SpillingQueue:
    """A priority queue of tuples. Beyond ``held`` of them, sorted runs go to an unnamed file of the task's own.

    The file has no name and belongs to one task: if its executor is lost, the task is run again and fills a new one.
    """

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.runs, self.file = held, [], [], None
        self.heads: list[tuple] = []  # (next message of a run, number of the run)

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.held:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        run = sorted(self.heap)
        places = []
        for a in range(0, len(run), 1024):
            places.append(self.file.tell())
            pickle.dump(run[a: a + 1024], self.file)
        self.heap = []
        self.runs.append((iter(places), []))
        self._next(len(self.runs) - 1)

    def _next(self, number: int) -> None:
        places, block = self.runs[number]
        if not block:
            place = next(places, None)
            if place is None:
                return
            self.file.seek(place)
            block.extend(reversed(pickle.load(self.file)))
        heapq.heappush(self.heads, (block.pop(), number))

    def least(self) -> tuple | None:
        """The first message, which stays in the queue."""
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            message, number = heapq.heappop(self.heads)
            self._next(number)
            return message
        return heapq.heappop(self.heap)


_TOTALS = "depth bigint, conv_id bigint, n_children bigint, n_leaves bigint, saved bigint"


def _time_forward(held: int):
    """Subtree totals of nodes that come in reverse level order; each node's totals are a message to its parent.

    A message is due when its parent's turn comes: it is keyed by the parent's level (deepest first) and name, as the
    nodes are. ``goes_up`` says whether the parent is here as well.
    """

    def run(batches):
        queue = SpillingQueue(held)
        names = ("depth", "conv_id", "parent_conv_id", "goes_up", "n_children", "n_leaves", "saved")
        for batch in batches:
            out = []
            for depth, conv, parent, goes_up, children, leaves, saved in zip(*(batch.column(c).to_pylist() for c in names)):
                while (message := queue.least()) is not None and message[:2] <= (-depth, conv):
                    _, _, n, more, kept = queue.pop()
                    children, leaves, saved = children + n, leaves + more, saved + kept
                out.append((depth, conv, children, leaves, saved))
                if goes_up:
                    queue.push((1 - depth, parent, 1, leaves, saved))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*out)] if out else [pa.array([], pa.int64())] * 5,
                names=["depth", "conv_id", "n_children", "n_leaves", "saved"])

    return run


def _processed(nodes: DataFrame, held: int) -> DataFrame:
    """Nodes of whole shards, each in one partition, sorted in reverse level order and run through."""
    return nodes.sortWithinPartitions(F.desc("depth"), "conv_id").mapInArrow(_time_forward(held), _TOTALS)


def _added(nodes: DataFrame, more: DataFrame) -> DataFrame:
    """Nodes with totals that came from other shards (columns depth, conv_id, and what to add)."""
    summed = more.groupBy("depth", "conv_id").agg(
        F.sum("n_children").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
    known = nodes.join(summed, ["depth", "conv_id"], "left")
    return known.withColumns({name: F.col(name) + F.coalesce(x, F.lit(0)) for name, x in (
        ("n_children", "c"), ("n_leaves", "l"), ("saved", "s"))}).drop("c", "l", "s")


def subtree_totals(nodes: DataFrame, held: int = HELD) -> DataFrame:
    """``depth, conv_id, n_children, n_leaves, saved`` of every node, the last two summed over its subtree.

    A node is named by its depth and ``conv_id``; it has ``parent_conv_id``, its own ``leaf`` (1 or 0) and ``saved``,
    and the name of its shard's root (``top_depth, top_conv_id``). Shards are connected, and a shard's root is its
    only node whose parent lies outside.

    Each shard is sorted in reverse level order and passes totals to parents through a spilling priority queue. The
    roots' totals go to the shards above. Those that nothing hangs from are answered then; the others form a tree
    of shard roots with the sums of their shards, which is passed through a queue in the same way, and its totals
    enter the shards that roots hang from once more.
    """
    base = nodes.select("depth", "conv_id", "parent_conv_id", "top_depth", "top_conv_id", F.lit(0).cast("bigint").alias("n_children"),
                        F.col("leaf").cast("bigint").alias("n_leaves"), F.col("saved").cast("bigint").alias("saved"),
                        F.expr("NOT (depth = top_depth AND conv_id = top_conv_id)").alias("goes_up"))
    base = staged(base, "trie-nodes")
    first = staged(_processed(base.repartition("top_depth", "top_conv_id"), held), "shard-totals")
    roots = base.filter("NOT goes_up").select("depth", "conv_id", "parent_conv_id")
    n = salts(roots.count())
    # The shard in which each root's parent lies: few shards have any, and heavy ones have very many.
    below = roots.filter("depth > 0").select("depth", "conv_id", (F.col("depth") - 1).alias("up_depth"), F.col("parent_conv_id").alias("up_conv"))
    places = base.select(F.col("depth").alias("up_depth"), F.col("conv_id").alias("up_conv"), "top_depth", "top_conv_id")
    hung = staged(lookup(below, places, ["up_depth", "up_conv"], F.col("conv_id"), n), "hanging-roots")
    carrying = staged(hung.select("top_depth", "top_conv_id").distinct(), "carrying-shards")
    # Across the roots of the shards that carry others: a tree again. Shards that carry none have final totals.
    same = ["depth", "conv_id"]
    carriers = carrying.select(F.col("top_depth").alias("depth"), F.col("top_conv_id").alias("conv_id"))
    leaves = hung.join(carriers, same, "left_anti")
    upper = first.join(carriers, same).select(*same, "n_leaves", "saved").join(
        hung.select(*same, F.col("top_conv_id").alias("parent_conv_id"), F.col("top_depth").alias("parent_depth")), same, "left")
    given = lambda rows: rows.join(first, same).groupBy("top_depth", "top_conv_id").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")).select(
        F.col("top_depth").alias("depth"), F.col("top_conv_id").alias("conv_id"), "n_leaves", "saved", F.lit(0).alias("n_children"))
    tree = _added(upper.withColumn("n_children", F.lit(0).cast("bigint")), given(leaves))
    across = staged(tree.repartition(1).sortWithinPartitions(F.desc("depth"), "conv_id").mapInArrow(
        _across(held), "depth bigint, conv_id bigint, n_leaves bigint, saved bigint"), "root-totals")
    final = staged(across.unionByName(first.join(leaves.select(*same), same).select(*across.columns)), "final-roots")
    # Once more inside the shards that carry others, with the totals of what hangs from their nodes.
    sent = hung.join(final, same).select(F.col("up_depth").alias("depth"), F.col("up_conv").alias("conv_id"), "n_leaves", "saved",
                                         F.lit(1).alias("n_children"))
    shard = ["top_depth", "top_conv_id"]
    again = _added(base.join(carrying, shard, "left_semi"), sent)
    carried = _processed(again.repartition(*shard), held)
    done = first.join(base.join(carrying, shard, "left_anti").select(*same), same, "left_semi")
    return done.unionByName(carried)


def _across(held: int):
    """Subtree totals of the shard roots: as in a shard, but a root's parent may lie any number of levels up."""

    def run(batches):
        queue = SpillingQueue(held)
        names = ("depth", "conv_id", "parent_depth", "parent_conv_id", "n_leaves", "saved")
        for batch in batches:
            out = []
            for depth, conv, up, parent, leaves, saved in zip(*(batch.column(c).to_pylist() for c in names)):
                while (message := queue.least()) is not None and message[:2] <= (-depth, conv):
                    _, _, more, kept = queue.pop()
                    leaves, saved = leaves + more, saved + kept
                out.append((depth, conv, leaves, saved))
                if parent is not None:
                    queue.push((-up, parent, leaves, saved))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*out)] if out else [pa.array([], pa.int64())] * 4,
                names=["depth", "conv_id", "n_leaves", "saved"])

    return run


# ---------------------------------------------------------------- the trie

def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's conversation ids, joined by commas, in a sorted partition; ids are read one by one."""
    node = state = None
    for batch in batches:
        out = []
        for depth, rep, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "rep", "conv_id"))):
            if (depth, rep) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (depth, rep), hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
        yield _digests(out)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                                      names=["depth", "conv_id", "ends_sha256"])


def prefix_trie(turns: DataFrame, bucket: int = BUCKET, segment: int = SEGMENT, heavy: int = HEAVY, held: int = HELD) -> DataFrame:
    """One row for each distinct sequence of a conversation's first turns, the empty one (the root) included.

    ``turns`` has a row for each turn (``conv_id, at, digest, size, length``, places from 0) and one with ``at`` -1 for
    each conversation. The result has ``depth`` (turns of the sequence), ``conv_id`` (the least of the conversations that
    begin with it), ``parent_conv_id`` (of the node without the last turn; null for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes of its subtree, itself included), ``saved_tokens`` (over its subtree,
    the size of a node's last turn times the conversations beyond the first) and ``ends_sha256`` (of the ids of the
    conversations that end there, ascending, joined by commas). No conversations give no rows. Rows without a
    ``conv_id`` belong to no conversation; repeated turns are turns of their own; extra columns are ignored.

    A conversation's path from the root holds fewer and fewer conversations. So in each segment of ``segment``
    depths it is heavy first (more than ``heavy`` conversations: the node is a shard of its own), then light: the
    first light node is the root of the shard of all below it. A shard has ``segment * heavy`` nodes at most, and
    the roots of shards that carry others are fewer than a node in ``heavy`` or ``segment`` rows.

    A node's digest of conversation ids is one sequential hash by its definition, so one task reads the ids (eight
    bytes each, streamed) of a node at which very many conversations end. Everything else is split.
    """
    whole = prefix_digests(turns.filter("at >= 0"), bucket)
    top = turns.filter("at < 0").select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("id"), "size", "length")
    rows = staged(whole.select("conv_id", (F.col("at") + 1).alias("depth"), "id", "size", "length").unionByName(top), "prefixes")
    n = salts(rows.count())
    placed = attach_totals(
        rows, ["depth", "id"], F.col("conv_id"), n,
        {"rep": F.min("conv_id"), "n_convs": F.count(F.lit(1)), "longest": F.max("length")},
        {"rep": F.min("rep"), "n_convs": F.sum("n_convs"), "longest": F.max("longest")})
    placed = staged(placed.select("conv_id", "depth", "size", "length", "rep", "n_convs", "longest"), "placed")
    ends = placed.filter("depth = length").repartition("depth", "rep").sortWithinPartitions("depth", "rep", "conv_id").mapInArrow(
        _end_digests, "depth bigint, conv_id bigint, ends_sha256 string")
    # The last node of a segment also comes before the first one of the next, to be its parent.
    sections = placed.withColumn("segment", F.explode(F.expr(
        f"IF(depth % {segment} = {segment - 1} AND depth < length, array(depth DIV {segment}, depth DIV {segment} + 1), array(depth DIV {segment}))")))
    path = Window.partitionBy("conv_id", "segment").orderBy("depth")
    light = F.expr(f"n_convs <= {heavy} AND depth DIV {segment} = segment")
    sections = sections.withColumns({
        "parent_conv_id": F.lag("rep").over(path),
        "first_light": F.first(F.when(light, F.struct("depth", "rep")), ignorenulls=True).over(
            path.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    nodes = sections.filter(f"depth DIV {segment} = segment AND conv_id = rep").select(
        "depth", "conv_id", "parent_conv_id", "n_convs", (F.col("depth") == F.col("longest")).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        F.coalesce("first_light.depth", "depth").alias("top_depth"), F.coalesce("first_light.rep", "conv_id").alias("top_conv_id"))
    nodes = staged(nodes, "trie")
    totals = subtree_totals(nodes, held)
    return nodes.select("depth", "conv_id", "parent_conv_id", "n_convs").join(totals, ["depth", "conv_id"]).join(
        ends, ["depth", "conv_id"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
