import math
import random
import re
from collections import Counter

import pytest

from barflow.llm import decontaminate as leaks
from barflow.llm.decontaminate import Index, contaminated, drop_contaminated, question_and_answer

ITEMS = "item_id bigint, text string, doc_id bigint"


def tokens(text):
    return [w.lower() for w in re.findall(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+", text or "")]


def made_items(words, n=60):
    rng = random.Random(4)
    out = []
    for i in range(n):
        w = words(rng.randrange(9, 50), 1000 + i, 900)
        stop = rng.randrange(3, len(w))
        out.append((i, " ".join(w[:stop]).capitalize() + "? " + " ".join(w[stop:]) + "."))
    return out


def weights(items):
    sequences = [tokens(" ".join(question_and_answer(t))) for _, t in items]
    df = Counter(w for s in sequences for w in set(s))
    mean = sum(map(len, sequences)) / len(sequences)
    out = []
    for s in sequences:
        one = {}
        for w, c in Counter(s).items():
            idf = math.log1p((len(sequences) - df[w] + 0.5) / (df[w] + 0.5))
            one[w] = idf * c * (leaks.K1 + 1) / (c + leaks.K1 * (1 - leaks.B + leaks.B * len(s) / mean))
        total = sum(one.values())
        out.append({w: v / total for w, v in one.items()})
    return out, [next(x for x in (64 << k for k in range(40)) if x >= 1.25 * len(s)) for s in sequences]


def brute(rows, items):
    """Every passage against every item."""
    share, strides = weights(items)
    grams = lambda w, n: {tuple(w[i: i + n]) for i in range(len(w) - n + 1)}
    out = {}
    for d, text in rows:
        w = tokens(text)
        for (item, t), weight, stride in zip(items, share, strides):
            for start in range(0, len(w), stride):
                inside = w[start: start + 2 * stride]
                bag = set(inside)
                score = sum(v for x, v in weight.items() if x in bag)
                if score < leaks.SHARE:
                    continue
                q, a = map(tokens, question_and_answer(t))
                n = min(5, len(q))
                qs = len(grams(q, n) & grams(inside, n)) / len(grams(q, n)) if q else 1.0
                as_ = len(set(a) & bag) / len(set(a)) if a else 1.0
                if qs >= leaks.QUESTION and as_ >= leaks.ANSWER:
                    out[d, item] = max(out.get((d, item), (0,)), (score, qs, as_))
    return out


def leaky(words, items):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        w = words(rng.randrange(1, 400), 3000 + i, 900)
        if i % 3 == 0:
            t = rng.choice(items)[1]
            at = rng.randrange(len(w))
            if i % 2:
                t = t.upper().replace("?", " -- ")
            if i % 5 == 0:
                cut = t.split()
                t = " ".join(cut[: int(len(cut) * rng.uniform(0.4, 1))])
            w[at:at] = [t]
        rows.append((i, " ".join(w)))
    return rows


def test_all_leaks_above_the_thresholds_are_found(spark, docs, words):
    items = made_items(words)
    rows = leaky(words, items) + [(500, None), (501, ""), (502, items[7][1]), (503, ("x " * 5000) + items[9][1] + " y" * 5000)]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    want = brute(rows, items)
    out = {(r.doc_id, r.item_id): tuple(r)[2:] for r in contaminated(docs(rows), benchmark).collect()}
    assert set(out) == set(want) and (502, 7) in out and (503, 9) in out and len(out) > 15
    for key, scores in want.items():
        assert out[key] == pytest.approx(scores)
    kept = drop_contaminated(docs(rows), benchmark)
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in rows if d not in {k for k, _ in want})


def test_a_large_benchmark_is_asked_in_several_indexes(spark, docs, words):
    items = made_items(words)
    rows = [(i, t) for i, t in items[:20]] + [(100, " ".join(words(300, 5, 900)))]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    out = contaminated(docs(rows), benchmark, index_bytes=2000).collect()
    assert {(i, i) for i in range(20)} <= {(r.doc_id, r.item_id) for r in out} and all(r.doc_id != 100 for r in out)


def test_wand_skips_nothing(words):
    items = made_items(words, 100)
    index = Index(items)
    share, _ = weights(items)
    for i, (_, text) in enumerate(leaky(words, items)[:40]):
        bag = set(tokens(text))
        want = {k for k, w in enumerate(share) if sum(v for x, v in w.items() if x in bag) >= 0.4}
        hashes = set(leaks._words([text]).hashes.tolist())
        terms = [t for t, h in enumerate(index.terms.tolist()) if h in hashes]
        got = {k for b in range(index.n_blocks) for k, _ in index.search(terms, b, 0.4)}
        assert got == want


def test_odd_tables(spark, docs):
    benchmark = spark.createDataFrame(
        [(None, "Who was it that came here? It was she.", 1), (2, None, 1), (3, "", 1), (4, "...", 1), (5, "one", 1), (5, "one", 1)], ITEMS)
    rows = [(1, "WHO was it, that came HERE it was she"), (1, "WHO was it, that came HERE it was she"), (None, "one"), (2, "two")]
    out = sorted(((r.doc_id, r.item_id) for r in contaminated(docs(rows), benchmark).collect()), key=str)
    assert out == sorted([(1, None), (1, None), (None, 5), (None, 5)], key=str)
    empty = spark.createDataFrame([], ITEMS)
    assert contaminated(docs(rows), empty).count() == 0 and contaminated(docs([]), benchmark).count() == 0
    assert drop_contaminated(docs(rows), empty).count() == 4
    assert question_and_answer("a b c") == ("a b", "c") and question_and_answer("A. B? C d.") == ("A. B?", "C d.")


def test_figures_do_not_depend_on_the_number_of_indexes(spark, docs, words):
    items = made_items(words)
    rows = leaky(words, items)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    found = lambda n: sorted(map(tuple, contaminated(docs(rows), benchmark, index_bytes=n).collect()))
    one = found(1 << 20)
    assert len(one) > 15 and found(2000) == one
    assert {r[:2] for r in one} == set(brute(rows, items))


def test_items_of_all_lengths_and_without_a_question(spark, docs, words):
    items = made_items(words, 20) + [(100, " ".join(words(300, 77, 900)) + "? " + " ".join(words(20, 78, 900)) + "."),
                                     (101, "?! Forty two is the answer to it all."), (102, "Alone?")]
    rows = leaky(words, items) + [(600 + i, t) for i, t in items] + [(800, "so forty two is the answer to it all they say")]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    want = brute(rows, items)
    assert {(800, 101), (701, 101), (700, 100)} <= set(want)
    for index_bytes in (1 << 20, 3000):
        out = {(r.doc_id, r.item_id): tuple(r)[2:] for r in contaminated(docs(rows), benchmark, index_bytes).collect()}
        assert set(out) == set(want)
        kept = drop_contaminated(docs(rows + [(None, None), (None, items[0][1])]), benchmark, index_bytes).collect()
        assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(d for d, _ in rows if d not in {k for k, _ in want})
        assert sum(r.doc_id is None for r in kept) == 1
