"""The conversation prefix trie against a brute-force version, with small shards, buckets and queues."""

import hashlib
import random
import zlib

import pytest

from barflow.llm import queries
from barflow.llm.prefix_trie import SpillingQueue, prefix_trie, turns_in_order, with_openings

CONV = "conv_id bigint, turn bigint, role string, text string, at int, depth string, rep binary"


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "x", b"y") for r in rows], CONV).repartition(parts)


def _trie(spark, rows, **sizes):
    turns = turns_in_order(_frame(spark, rows))
    rebuilt = with_openings(turns, *queries.opening_rule())
    return {(r["depth"], r["conv_id"]): tuple(r)[2:] for r in prefix_trie(rebuilt, **sizes).collect()}


def _brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            by.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role, text)))
    original = {c: [t for _, t in sorted(x)] for c, x in by.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = original.get(base, [])[:h] + own[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for seq in sorted(members, key=len, reverse=True):
        below = [s for s in members if len(s) == len(seq) + 1 and s[:-1] == seq]
        under = [s for s in members if s[:len(seq)] == seq]
        ends = sorted(c for c in members[seq] if len(rebuilt[c]) == len(seq))
        inner = {s[:-1] for s in under if s}
        out[len(seq), min(members[seq])] = (
            min(members[seq[:-1]]) if seq else None, len(members[seq]), len(below), sum(s not in inner for s in under),
            sum((len(members[s]) - 1) * len(s[-1][1]) for s in under if s),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def _conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 450), n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn, "user" if turn % 2 else None, rng.choice(["a", "bé", "ccc", ""]) if turn < longest - 3 else f"{c}"))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"bucket": 3, "segment": 4, "heavy": 3, "held": 5}, {"bucket": 2, "segment": 2, "heavy": 1, "held": 1},
                                   {"bucket": 64, "segment": 3, "heavy": 1000, "held": 2}])
def test_totals_equal_brute_force_however_the_trie_is_cut(spark, sizes):
    rows = _conversations(3, 40, 14)
    assert _trie(spark, rows, **sizes) == _brute(rows)


def test_one_long_conversation_and_equal_ones(spark):
    long = [(7, t, "r", str(t % 3)) for t in range(150)]
    same = [(c, t, "r", "x") for c in range(300, 330) for t in range(2)]
    rows = long + same
    assert _trie(spark, rows, bucket=4, segment=8, heavy=2, held=10) == _brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "u", "lost"), (5, None, "u", "first"), (5, 1, None, None), (5, 1, None, None), (5, 2, "ab", "c"), (6, 2, "a", "bc"),
            (105, 0, "u", "own"), (200, 0, "u", "x"), (-3, 4, "u", "y" * 5000), (-3, 4, "u", "z")]
    assert _trie(spark, rows) == _brute(rows)


def test_no_conversations_have_no_trie(spark):
    assert _trie(spark, []) == {}
    assert _trie(spark, [(None, 1, "u", "t")]) == {}


def test_queue_gives_messages_in_order_beyond_its_memory():
    rng = random.Random(1)
    queue, kept, out = SpillingQueue(held=7), [], []
    for _ in range(5000):
        if rng.random() < 0.6 or not kept:
            message = (rng.randrange(1000), rng.randrange(9))
            queue.push(message)
            kept.append(message)
        else:
            kept.sort()
            assert queue.least() == kept[0]
            out.append(queue.pop())
            assert out[-1] == kept.pop(0)
    assert queue.runs
    assert [queue.pop() for _ in kept] == sorted(kept) and queue.least() is None


def test_query_equals_brute_force(spark, tmp_path):
    rows = _conversations(9, 30, 8)
    _frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    found = queries.QUERIES["op11_time_forward_trie"](spark, str(tmp_path)).collect()
    assert {(r["depth"], r["conv_id"]): tuple(r)[2:] for r in found} == _brute(rows)
