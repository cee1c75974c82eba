"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import pytest

from barflow.llm import queries
from barflow.llm.repeated_runs import Words, find_runs, repeated_words, runs_of


def _brute(words, least_words=6, least_periods=4):
    n, seen = len(words), {}
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least_words, least_periods * q):
                seen.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in seen.items()), key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def _text(rng):
    n, k = rng.choice([0, 1, 5, 12, 40, 90]), rng.choice([1, 2, 3, 9])
    words = [rng.choice(["a", "b", "é", "dd", "A", " ", "x　y", "f", "g"][:k]) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 8:
            a, p = rng.randrange(n - 4), rng.randrange(1, 7)
            words = [w if i < a else words[min(a + (i - a) % p, n - 1)] for i, w in enumerate(words)]
    return "".join(w + rng.choice([" ", "\n", "\t ", "\x0b", "\x0c\r"]) for w in words)


@pytest.mark.parametrize("least", [(6, 4), (2, 2), (4, 3)])
def test_runs_and_collapsed_texts_equal_brute_force(least):
    rng = random.Random(11)
    for _ in range(150):
        texts = [_text(rng).encode() for _ in range(rng.randrange(1, 7))]
        words = Words(texts)
        found = runs_of(words.ids, words.bounds, *least)
        joined = words.joined(~repeated_words(words.bounds, *found))
        for i, text in enumerate(texts):
            mine = [tuple(int(c[j]) for c in found[1:]) for j in range(len(found[0])) if found[0][j] == i]
            assert mine == _brute(text.split(), *least)
            assert joined[i] == _collapsed(text.split(), mine)


def test_odd_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a " * 50_000), (5, "w " * 6), (5, "w " * 6), (None, "x y " * 4), (6, "x y " * 3 + "x"),
            (7, " ".join(map(str, range(3000))) + " q" * 9)]
    found = {(r["doc_id"], r["n_words"]): ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in find_runs(docs(rows)).collect()}
    assert found[1, 0] == found[2, 0] == found[3, 0] == ([], "")
    assert found[4, 50_000] == ([(0, 50_000, 1)], "a")
    assert found[5, 6] == ([(0, 6, 1)], "w")
    assert found[None, 8] == ([(0, 8, 2)], "x y")
    assert found[6, 7] == ([], "x y x y x y x")
    assert found[7, 3009][0] == [(3000, 9, 1)]
    assert find_runs(docs(rows)).count() == len(rows)
    assert find_runs(docs([])).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, _text(rng)) for i in range(300)] + [(None, "a b " * 9), (77_000, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in queries.QUERIES["op12_branching_tandem_runs"](spark, str(tmp_path)).collect()}
    planted = 0
    for doc, text in rows:
        words = (text or "").encode().split()
        if doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0 and words:
            g, n = zlib.crc32(str(doc).encode()) // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        runs = _brute(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
        r = found[doc]
        assert (r["n_runs"], (r["start"], r["length"], r["period"])) == (len(runs), best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(_collapsed(words, runs)).hexdigest()
    assert planted > 10
