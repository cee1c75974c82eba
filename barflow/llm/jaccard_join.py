"""Near-duplicate classes: a Jaccard join of word shingles by token-combination prefixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import (
    ANSWER, ASK, ASKED, BLOCK_BYTES, Words, ask, attach_totals, block_number, chunks_of, count_bucket, in_blocks, lookup, mixed, salts, slices, totals_of,
    unpacked_docs, windows,
)
from barflow.llm.components import components
from barflow.session import staged

#: Words of a shingle, and the similarity in percent from which documents link.
SHINGLE, PERCENT = 5, 80
#: Shingles in more documents than this are indexed in combinations of two, the others alone.
RARE = 16
#: Frequent shingles of a set of 2 ** level to 2 ** (level + 1) are dealt to 2 ** level / CLASS classes (one at least).
CLASS = 16
#: Text bytes for each bucket of shingle counts, and the bytes of a shingle's hash that travel there.
BUCKET_BYTES, KEY_BYTES = 8 << 20, 4
#: Rows of each side of a signature that are compared in one go.
PAIR_ROWS = 2000

_SLIM = "doc_id bigint, class binary, n_shingles bigint"
_MARKED = "node bigint, size bigint, n_own bigint, short array<bigint>, long array<bigint>, tokens array<bigint>"


def shingle_sets(texts: list[str | None], n: int = SHINGLE) -> tuple[list[np.ndarray], list[bytes]]:
    """Sorted distinct shingle hashes of each text, and a digest of its words (empty: no words)."""
    sets, classes = [], []
    for a, b in chunks_of(texts):
        words = Words(texts[a:b])
        h, _ = windows(words.hashes, words.bounds, n)
        counts = words.counts()
        ends = np.cumsum(np.maximum(counts - n + 1, 0))
        for i, count in enumerate(counts.tolist()):
            if count >= n:
                sets.append(np.unique(h[ends[i] - (count - n + 1): ends[i]]))
            elif count:
                whole, _ = windows(words.hashes[words.bounds[i]: words.bounds[i + 1]], np.array([0, count]), count)
                sets.append(whole)
            else:
                sets.append(np.empty(0, np.uint64))
            classes.append(hashlib.blake2b(b" ".join(words.blobs[i].split()), digest_size=16).digest() if count else b"")
    return sets, classes


def _slim(batches):
    for batch in slices(batches):
        sets, classes = shingle_sets(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(classes, pa.binary()), pa.array(map(len, sets), pa.int64())],
            names=["doc_id", "class", "n_shingles"])


def _chosen(docs: pa.Table, rows: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    """Of a block, the classes that one of its documents stands for (by their node), and their shingle sets."""
    wanted = {(d, c): node for d, c, node in zip(*(rows.column(x).to_pylist() for x in ("doc_id", "class", "node")))}
    known = {d for d, _ in wanted}
    ids, texts = docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()
    at = [i for i, d in enumerate(ids) if d in known]
    sets, classes = shingle_sets([texts[i] for i in at])
    out: dict[int, np.ndarray] = {}
    for i, one, c in zip(at, sets, classes):
        node = wanted.get((ids[i], c))
        if node is not None:
            out.setdefault(node, one)
    return list(out), list(out.values())


def _shingles_of_block(n_buckets: int):
    def run(packed: pa.Table, chosen: pa.Table) -> pa.Table:
        docs = unpacked_docs(packed)
        _, sets = _chosen(docs, chosen)
        if not sets:
            return ASKED.empty_table()
        keys, counts = np.unique(np.concatenate(sets), return_counts=True)
        return ask(docs.column("block")[0].as_py(), keys, counts, np.zeros(0, np.uint8), n_buckets, KEY_BYTES)

    return run


def _allowed(size: int, percent: int) -> tuple[int, int]:
    """How many shingles may miss from the smaller (or an equal), and from the larger, of two that link."""
    return size - -(-2 * percent * size // (100 + percent)), size - -(-percent * size // 100)


def _signatures(tokens: np.ndarray, df: np.ndarray, level: int, allowed: int) -> np.ndarray:
    """Signatures of the prefix from which ``allowed`` tokens can be taken without losing a signature.

    Tokens come rarest first. A rare token is a signature; a class of frequent ones has a signature for each
    two, so the first token of a class adds nothing and the prefix is one longer for it. Tokens of one document
    only count for the prefix, but need no signature. A set of one token links with equal sets only, so that
    token is its signature however frequent it is.
    """
    n_classes = max(1, (1 << level) // CLASS)
    frequent = (df > RARE) & (len(tokens) > 1)
    of = (tokens % np.uint64(n_classes)).astype(np.int64)
    adds = np.ones(len(tokens), np.int64)
    at = np.flatnonzero(frequent)
    if len(at):
        adds[at[np.unique(of[at], return_index=True)[1]]] = 0
    end = int(np.searchsorted(np.cumsum(adds), allowed + 1)) + 1
    tag = np.array([(level + 1) * 0x9FB21C651E98DF25 % (1 << 64)], np.uint64)
    single = tokens[:end][(df[:end] > 1) & ~frequent[:end]]
    out = [mixed(single + tag)]
    at = at[at < end]
    if len(at) > 1:
        order = at[np.lexsort((tokens[at], of[at]))]
        group = of[order]
        for step in range(1, len(order)):  # to the end of the largest class
            same = group[step:] == group[:-step]
            if not same.any():
                break
            one, two = tokens[order[:-step][same]], tokens[order[step:][same]]
            out.append(mixed(mixed(one) * np.uint64(3) + two + tag))
    return np.concatenate(out)


def _mark(node: int, tokens: np.ndarray, df: np.ndarray, percent: int) -> tuple | None:
    """Signatures with which a document meets larger (or equal) ones, and further ones to meet smaller ones."""
    size, own = len(tokens), int((df == 1).sum())
    smaller, larger = _allowed(size, percent)
    if own > larger:
        return None
    order = np.lexsort((tokens, df))
    tokens, df = tokens[order], df[order]
    level = size.bit_length() - 1
    short = _signatures(tokens, df, level, smaller)
    levels = {level, (-(-percent * size // 100)).bit_length() - 1}
    long = np.concatenate([_signatures(tokens, df, x, larger) for x in levels])
    short = np.unique(short)
    return (node, size, own, short.view(np.int64), np.setdiff1d(long, short).view(np.int64),
            np.sort(tokens[df > 1]).view(np.int64))


def _mark_block(percent: int):
    def run(packed: pa.Table, told: pa.Table) -> pa.Table:
        docs = unpacked_docs(packed)
        names = ("node", "size", "n_own", "short", "long", "tokens")
        answers = told.filter(pa.compute.is_valid(told.column("totals")))
        ids, sets = _chosen(docs, told.filter(pa.compute.is_null(told.column("totals")))) if docs.num_rows else ([], [])
        rows = []
        if sets:
            keys, df = np.unique(np.concatenate(sets)), totals_of(answers)
            rows = [m for d, s in zip(ids, sets) if (m := _mark(d, s, df[np.searchsorted(keys, s)], percent))]
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 3
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    return run


def _may_link(percent: int) -> str:
    """Sizes, and the shingles that no other document has, allow a link."""
    most = "least(a_size - a_own, b_size - b_own)"
    return (f"100 * least(a_size, b_size) >= {percent} * greatest(a_size, b_size) AND "
            f"100 * {most} >= {percent} * (a_size + b_size - {most})")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, from their shingles; a node in very many pairs is dealt to salted pieces."""
    n = salts(pairs.count())
    for side, other in (("a", "b"), ("b", "a")):
        mine = sets.select(F.col("node").alias(side), F.col("size").alias(f"{side}_size"), F.col("tokens").alias(f"{side}_tokens"))
        pairs = lookup(pairs, mine, [side], F.col(other), n)
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return pairs.filter(100 * shared >= percent * (F.col("a_size") + F.col("b_size") - shared)).select("a", "b")


def _links(marked: DataFrame, percent: int) -> DataFrame:
    """Links that connect whatever the full join connects.

    First every node is compared with the most typical one (fewest shingles of its own) of each signature
    it has, which joins a group of copies through a few centres, in a number of pairs that grows with the
    group and not with its square. Then pairs with a common signature are compared if the first links left
    them apart: within a signature, the nodes outside its largest component against the others. A signature's
    rows are dealt to salted pieces wherever they meet something, and its pairs to blocks of PAIR_ROWS a side.
    """
    mark = lambda c, short: marked.select(
        F.explode(c).alias("sig"), "node", "size", F.col("n_own").alias("own"), F.lit(short).alias("short"))
    rows = staged(mark("short", True).unionAll(mark("long", False)), "signatures")
    n = salts(rows.count())
    centre = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("own", "node", "size")).alias("c")).filter(
        "n > 1").select("sig", F.col("c.node").alias("b"), F.col("c.size").alias("b_size"), F.col("c.own").alias("b_own"))
    tried = staged(lookup(rows.withColumnsRenamed({"node": "a", "size": "a_size", "own": "a_own"}), centre, ["sig"], F.col("a"), n).filter(
        "a != b").filter(_may_link(percent)).select("a", "b").distinct(), "star-pairs")
    first = staged(_verified(tried, marked, percent), "star-links")
    joined = staged(components(first), "star-components")
    placed = rows.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = placed.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(
        "low != high").select("sig")
    open_ = staged(lookup(placed, apart, ["sig"], F.col("node"), n), "open-signatures")
    main = open_.groupBy("sig", "component").count().groupBy("sig").agg(
        F.max(F.struct("count", "component")).alias("m"), F.sum("count").alias("rows")).select(
        "sig", F.col("m.component").alias("main"), F.ceil((F.col("rows") - F.col("m.count")) / PAIR_ROWS).alias("a_blocks"),
        F.ceil(F.col("rows") / PAIR_ROWS).alias("b_blocks"))
    sided = lookup(open_, main, ["sig"], F.col("node"), n).withColumn("outside", F.expr("component != main"))
    block = lambda c: F.expr(f"pmod(xxhash64(node), {c}_blocks)")
    every = lambda c: F.explode(F.expr(f"sequence(0, {c}_blocks - 1)"))
    as_ = lambda rows, side: rows.select("sig", "a_block", "b_block", *[F.col(c).alias(f"{side}_{c}") for c in (
        "node", "size", "own", "short", "component", "outside")])
    one = as_(sided.filter("outside").withColumn("a_block", block("a")).withColumn("b_block", every("b")), "a")
    two = as_(sided.withColumn("b_block", block("b")).withColumn("a_block", every("a")), "b")
    rest = one.join(two, ["sig", "a_block", "b_block"]).filter(
        "a_component != b_component AND (NOT b_outside OR a_node < b_node)").filter(
        "CASE WHEN a_size < b_size THEN a_short WHEN a_size > b_size THEN b_short ELSE a_short AND b_short END").filter(
        _may_link(percent)).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
    done = tried.unionAll(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = staged(rest.join(done, ["a", "b"], "left_anti"), "open-pairs")
    return first.unionAll(_verified(rest, marked, percent))


def _shared_ids(slim: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For ids that stand for several texts: their nodes, and links between these (an id is one document)."""
    several = staged(slim.groupBy("doc_id").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter(
        "low != high AND doc_id IS NOT NULL").select("doc_id"), "shared-ids")
    nodes = staged(slim.join(several, "doc_id").select("doc_id", "class").distinct().join(
        classes.select("class", "node"), "class").select("doc_id", "node"), "shared-nodes")
    least = nodes.groupBy("doc_id").agg(F.min("node").alias("b"))
    return nodes, nodes.join(least, "doc_id").filter("node != b").select(F.col("node").alias("a"), "b")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document, for links at ``percent`` Jaccard similarity or more.

    Words are what the six ASCII white-space characters part, A-Z in lower case. A set holds the distinct
    shingles of five words, or the whole sequence of fewer; without words it is empty and links with nothing.
    ``component_id`` is the least id reachable by links. Null and empty texts have empty sets. Rows repeated
    with id and text get one answer each; rows that share an id and differ in their text are one document with
    several sets, each of which links. Rows without an id take part through equal texts that have one; else
    their component is null. Ids must be whole numbers. Extra columns are ignored; an empty table gives no rows.

    Documents of equal words are one class, with a node of its own, compared once. Shingles are counted over all
    classes, so that prefixes hold the rarest; prefixes are long enough that two classes that link share a signature:
    a rare shingle, or two frequent ones. Candidates are verified on 64-bit hashes of all shingles that more than
    one class has. Nothing is capped: see ``_links`` for hot groups.
    """
    slim = staged(docs.select("doc_id", "text").mapInArrow(_slim, _SLIM), "shingle-classes")
    filled = slim.filter("n_shingles > 0")
    classes = staged(filled.groupBy("class").agg(F.min("doc_id").alias("doc_id")).withColumn(
        "node", F.monotonically_increasing_id()), "classes")
    blocks, total = in_blocks(docs)
    n_blocks, n_buckets = max(1, -(-total // BLOCK_BYTES)), max(1, -(-total // bucket_bytes))
    chosen = classes.filter("doc_id IS NOT NULL").withColumn(
        "block", block_number("doc_id", F.lit(None).cast("string"), n_blocks))
    by_block = blocks.groupBy("block")
    counted = by_block.cogroup(chosen.groupBy("block")).applyInArrow(_shingles_of_block(n_buckets), ASK).groupBy(
        "bucket").applyInArrow(count_bucket(KEY_BYTES), ANSWER)
    told = counted.selectExpr(
        "block", "bucket", "totals", "CAST(NULL AS bigint) AS doc_id", "CAST(NULL AS binary) AS class", "CAST(NULL AS bigint) AS node"
    ).unionAll(chosen.selectExpr("block", "0 AS bucket", "CAST(NULL AS binary) AS totals", "doc_id", "class", "node"))
    marked = staged(by_block.cogroup(told.groupBy("block")).applyInArrow(_mark_block(percent), _MARKED), "signed")
    shared, same = _shared_ids(slim, classes)
    joined = components(_links(marked, percent).unionAll(same))
    n = salts(slim.count())
    placed = classes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    answer = staged(attach_totals(placed, ["component"], F.col("node"), n, {"component_id": F.min("doc_id")}, {
        "component_id": F.min("component_id")}).select("class", "node", "component_id"), "class-components")
    linked = lookup(filled, answer.select("class", "component_id"), ["class"], F.col("doc_id"), n)
    # An id with words in one row and none in another has the component of its words.
    of_id = shared.join(answer, "node").groupBy("doc_id").agg(F.min("component_id").alias("known"))
    alone = slim.filter("n_shingles = 0").join(of_id, "doc_id", "left").withColumn("component_id", F.coalesce("known", "doc_id"))
    return linked.select("doc_id", "n_shingles", "component_id").unionAll(alone.select("doc_id", "n_shingles", "component_id"))


def drop_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of each group of linked documents the one with the least id, with all its columns.

    Documents without words, and rows without an id, stay. Rows repeated with the id that stays, stay.
    """
    gone = staged(jaccard_components(docs, percent).filter("doc_id != component_id").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
