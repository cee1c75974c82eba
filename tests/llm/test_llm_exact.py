import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barflow.llm.exact_dedup import chunks, drop_copies, exact_dedup
from barflow.llm.sharding import shard_by_bytes, shard_documents, sized, splitters, write_shards

LONG = "One sentence here. And\nanother one, with é and \U0001F600! " * 300
ROWS = [(1, "a. b"), (5, "a. b"), (3, "a.  b"), (2, None), (9, ""), (None, "a. b"), (None, "only"), (7, LONG), (8, LONG),
        (11, LONG + "."), (12, LONG[:-1]), (4, "x" * 9000), (6, "x" * 9001), (10, "x" * 9000)]


def expected(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = []
    for d, t in rows:
        ids = groups[t or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((d, keep, len(ids), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_exact_dedup_is_grouping_by_text(docs):
    assert found(exact_dedup(docs(ROWS))) == expected(ROWS)


def test_texts_that_share_a_hash_are_told_apart(docs):
    rows = ROWS + [(20 + i, f"{'y' * (i % 5)}. z{i % 3}" * 200) for i in range(12)]
    assert found(exact_dedup(docs(rows), lambda c: F.pmod(F.xxhash64(c), F.lit(2)))) == expected(rows)


def test_chunks_join_to_the_text(spark, docs):
    df = docs(ROWS).filter("text IS NOT NULL").select("text", chunks(F.col("text")).alias("c"))
    for r in df.collect():
        assert "".join(r.c) == r.text and all(r.c)
    one, two = (spark.createDataFrame([(t,)], "text string").select(chunks(F.col("text"))).first()[0]
                for t in (LONG, "Inserted at the front. " + LONG))
    assert len(set(one) & set(two)) >= len(set(one)) - 2  # cuts come back into step


def test_drop_copies_keeps_columns_and_one_of_repeated_rows(docs):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "b"), (None, "b")]
    kept = drop_copies(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(2, "a"), (4, ""), (None, "b")]


def test_empty_table(docs):
    assert exact_dedup(docs([])).count() == 0 and drop_copies(docs([])).count() == 0
    assert shard_by_bytes(docs([]), 4).count() == 0


def by_the_rule(keys, n):
    """Shards of (k1, k2, size) rows: see the docstring of splitters."""
    total = sum(s for *_, s in keys)
    order = sorted(keys)
    ends = []
    for k in range(1, n):
        groups, at = {}, 0
        for k1, k2, s in order:
            g = groups.setdefault(k1, [at, at])
            at += s
            g[1] = at
        at, cut = 0, None
        for i, (k1, k2, s) in enumerate(order):
            lo, hi = groups[k1]
            if n * lo < k * total < n * hi and 100 * min(k * total - n * lo, n * hi - k * total) <= total:
                right = k * total - n * lo <= n * hi - k * total
            else:
                right = 2 * k * total <= n * (2 * at + s)
            if right and cut is None:
                cut = i
            at += s
        ends.append(len(order) if cut is None else cut)
    return [sum(i >= e for e in ends) for i in range(len(order))], order


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_shards_have_near_equal_bytes(docs, words, n):
    rows = [(i, " ".join(words(20 + i % 50, i))) for i in range(150)]
    rows += [(200 + i, "hot group " * 30) for i in range(120)] + [(None, "z"), (400, None), (401, "")]
    df = docs(rows)
    out = shard_by_bytes(df, n).collect()
    text = {d: t for d, t in rows}
    assert len(out) == len(rows)
    for r in out:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in out:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < n
    total, most = sum(sizes.values()), max(r.size for r in out)
    assert all(abs(s - total / n) <= 2 * most + 0.02 * total / n for s in sizes.values())
    keys = [(r.k1, r.k2, r["size"], r.doc_id) for r in sized(df).collect()]
    want, order = by_the_rule([k[:3] for k in keys], n)
    id_of = {(a, b, s): d for a, b, s, d in keys}
    assert {r.doc_id: r.shard for r in out} == {id_of[k]: s for k, s in zip(order, want)}


def test_repeated_rows_are_cut_like_others(spark, docs):
    """One text without ids, and rows repeated with their id: shards keep near equal bytes, slots have no gaps."""
    assert len(splitters(sized(docs([(1, "same")] * 50 + [(2, "other")])), 4)) == 3
    assert sorted(r.n for r in shard_by_bytes(docs([(1, "same")] * 50), 4).groupBy("shard").agg(
        F.count("*").alias("n")).collect()) == [12, 12, 13, 13]
    rows = [(None, "one text")] * 4000 + [(i, f"text {i}") for i in range(400)] + [(7000, "x" * 50)] * 300
    out = shard_by_bytes(docs(rows), 40).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in out:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(out) == len(rows) and sorted(sizes) == list(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share = sum(sizes.values()) / 40
    assert all(abs(s - share) <= 2 * 66 + 0.02 * share for s in sizes.values())


def test_shards_hold_the_documents_with_all_columns(docs, words, tmp_path):
    rows = [(i, " ".join(words(20 + i % 50, i)), "de") for i in range(80)]
    rows += [(200 + i, "hot group " * 30, "fr") for i in range(60)] + [(None, "z"), (400, None), (401, ""), (7, "again")]
    df = docs(rows).withColumnsRenamed({"block": "shard", "label": "slot", "n_chars": "size", "score": "k1"})
    shards = write_shards(df, 7, str(tmp_path / "shards"))
    plain = lambda found: sorted(map(tuple, found.collect()), key=str)
    assert shards.select("document.*").columns == df.columns
    assert plain(shards.select("document.*")) == plain(df)
    assert len(list((tmp_path / "shards").glob("shard=*"))) == 7
    read = {(r.shard, r.slot): r.document.text for r in shards.collect()}
    out = {(r.shard, r.slot): r for r in shard_by_bytes(df, 7).collect()}
    assert len(read) == len(rows) and read.keys() == out.keys()
    for at, text in read.items():
        raw = (text or "").encode()
        assert (out[at]["size"], out[at].text_crc32) == (len(raw) + 16, zlib.crc32(raw))


def test_pieces_are_bounded_by_bytes(docs, words):
    df = docs([(i, " ".join(words(100, i))) for i in range(200)])
    out = shard_documents(df, 2, piece_bytes=2_000).collect()
    for shard in (0, 1):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    assert sorted(r.document.doc_id for r in out) == list(range(200))


def test_drop_copies_beside_a_map(spark):
    rows = [(1, "a", {"k": 1}), (1, "a", {"k": 1}), (2, "a", {"k": 2}), (3, None, None), (4, "", {"x": 9})]
    kept = drop_copies(spark.createDataFrame(rows, "doc_id bigint, text string, tags map<string,int>"))
    assert sorted((r.doc_id, r.tags) for r in kept.collect()) == [(2, {"k": 2}), (4, {"x": 9})]
    rows = [(9, "b", {"k": 1}), (9, "b", {"k": 1})]
    kept = drop_copies(spark.createDataFrame(rows, "doc_id bigint, text string, tags map<string,int>"))
    assert [tuple(r) for r in kept.collect()] == [(9, "b", {"k": 1})]
