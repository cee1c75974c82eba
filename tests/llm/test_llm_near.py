import random
import re

import numpy as np
import pytest

from barflow.llm import jaccard_join
from barflow.llm.common import mixed
from barflow.llm.components import components
from barflow.llm.jaccard_join import _mark, drop_near_copies, jaccard_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, percent=80):
    """Components by comparing all pairs."""
    sets = []
    for d, t in rows:
        w = WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
        sets.append({tuple(w[i: i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, (d, _), s in zip(range(len(rows)), rows, sets)), key=str)


def edited(words, rng, n, fresh):
    out = list(words)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice(fresh)
        elif kind == 1:
            out.insert(at, rng.choice(fresh))
        else:
            del out[at]
    return out


@pytest.mark.parametrize("seed, length, copies", [(1, 40, 90), (2, 160, 120), (3, 700, 40)])
def test_components_are_those_of_all_pairs(docs, words, seed, length, copies):
    rng = random.Random(seed)
    fresh = [f"new{i}" for i in range(12)]  # few, so that edits are shared too
    texts = []
    common = words(30, 99)
    for t in range(3):
        base = words(length, seed * 10 + t)
        for k in range(copies if t == 0 else 12):
            made = edited(base, rng, rng.randrange(0, max(2, length // 18)), fresh)
            if k % 4 == 0:
                made = made + common
            if k % 5 == 0:
                made = made[: int(len(made) * rng.uniform(0.7, 1))]
            texts.append(" ".join(made))
    texts += [" ".join(words(rng.randrange(1, 60), 500 + i)) for i in range(60)]
    texts += [" ".join(common)] * 3 + ["a b", "A  b", "a", "", None, " \n", "Same five words are here", "same Five words are here"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    out = jaccard_components(docs(rows), bucket_bytes=1 << 14)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


def test_rows_without_id_and_repeated_rows(docs):
    text = "one two three four five six seven"
    rows = [(None, text), (4, text), (4, text), (9, text + "."), (None, "alone it stands"), (2, None)]
    out = sorted((tuple(r) for r in jaccard_components(docs(rows)).collect()), key=str)
    assert out == sorted([(None, 3, 4), (4, 3, 4), (4, 3, 4), (9, 3, 9), (None, 1, None), (2, 0, 2)], key=str)
    assert jaccard_components(docs([])).count() == 0


def test_one_of_each_group_stays(docs):
    base = [f"w{i}" for i in range(60)]
    rows = [(5, " ".join(base)), (3, " ".join(base[1:])), (8, "other words"), (9, None), (7, " ".join(base) + " more")]
    kept = drop_near_copies(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 8, 9]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(200, 260)] + [(260, 259), (5, 6), (6, 5), (4, 4)]
    out = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(out[i] == 100 for i in range(100, 181)) and all(out[i] == 7 for i in range(200, 261))
    assert out[7] == 7 and out[5] == out[6] == 5 and len(out) == 81 + 62 + 2
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_blocks_do_not_depend_on_the_type_of_ids(docs):
    from barflow.llm.common import in_blocks

    df = docs([(i, f"text {i} " * 9) for i in range(60)])
    dealt = lambda frame: sorted((r.block, i) for r in in_blocks(frame, 500)[0].collect() for i in r.doc_id)
    wide = dealt(df)
    assert len({b for b, _ in wide}) > 3 and dealt(df.withColumn("doc_id", df.doc_id.cast("int"))) == wide


def test_one_id_with_several_texts_loses_no_link(docs, words):
    a, b = (" ".join(words(60, k)) for k in (1, 2))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (9, None), (9, b + " z"), (10, ""), (11, a)]
    out = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_components(docs(rows)).collect()}
    assert {d: c for (d, _), c in out.items()} == {1: 1, 2: 1, 3: 1, 9: 1, 10: 10, 11: 1}
    assert out[9, 0] == 1
    swapped = [(5, a), (5, b), (2, a + " x"), (3, b + " y")]
    assert {r.component_id for r in jaccard_components(docs(swapped)).collect()} == {2}


def test_short_sets_meet_in_combinations_of_frequent_shingles():
    tokens, df = np.arange(1, 13, dtype=np.uint64) * np.uint64(977), np.full(12, 100_000)
    single = {int(x) for level in range(5) for x in mixed(tokens + np.array([(level + 1) * 0x9FB21C651E98DF25 % (1 << 64)], np.uint64))}
    _, _, _, short, long, _ = _mark(1, tokens, df, 80)
    signatures = {x % (1 << 64) for x in [*short.tolist(), *long.tolist()]}
    assert signatures and not signatures & single


def test_short_texts_that_share_frequent_shingles_are_not_all_paired(spark, docs, monkeypatch):
    """5,000 texts of a dozen words: ten common openings, ends of their own. Links are right and few pairs are verified."""
    rng = random.Random(3)
    opening = [" ".join(f"o{k}w{i}" for i in range(9)) for k in range(10)]
    rows = [(i, f"{opening[i % 10]} {rng.randrange(10**9)} {rng.randrange(10**9)} {rng.randrange(10**9)}") for i in range(5000)]
    rows += [(6000 + i, opening[0]) for i in range(30)]
    pairs = []
    whole = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda p, *rest: pairs.append(p.count()) or whole(p, *rest))
    out = {r.doc_id: r.component_id for r in jaccard_components(docs(rows)).collect()}
    assert all(out[i] == i for i in range(5000)) and all(out[6000 + i] == 6000 for i in range(30))
    assert sum(pairs) < 50_000
